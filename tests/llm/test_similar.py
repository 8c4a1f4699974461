from __future__ import annotations

import random
import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkfeat.llm import similar
from sparkfeat.llm.similar import drop_similar
from tests.llm.test_simhash import LOWER


def plain_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def plain_kept(docs, least=0.8):
    """Smallest id of each group, by comparing all pairs."""
    sets = {i: plain_set(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(docs), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) >= least * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i for i in docs if find(i) == i}


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed):
    """Texts with copies around the limit, a crowded family, chains, short texts and one common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(20)]
    texts = []
    for n in (3, 4, 5, 6, 8, 12, 30, 60, 120, 300):
        for _ in range(4):
            base = [word() for _ in range(n)]
            texts += [base, base, [w.upper() for w in base]]
            texts += [edited(rng, base, max(1, n * k // 100)) for k in (1, 2, 3, 4) if n > 5]
    base = [word() for _ in range(100)]
    texts += [edited(rng, base, rng.randint(0, 3)) for _ in range(90)]
    chain = [word() for _ in range(150)]
    for _ in range(50):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += [passage + [word() for _ in range(rng.choice([2, 4, 8, 40]))] for _ in range(80)]
    rng.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("frequent", [2, 10**9])
def test_similar_against_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(similar, "SAMPLED", 2)
    monkeypatch.setattr(similar, "FREQUENT", frequent)
    docs = corpus(frequent)
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in drop_similar(df).collect()} == plain_kept(docs)


def test_pages_of_one_boilerplate_do_not_meet(spark, monkeypatch):
    """Alike in 296 of 416 shingles and so below the limit: the places of the common ones alone rule all pairs out."""
    rng = random.Random(9)
    passage = " ".join(f"b{i}" for i in range(300))
    docs = {i: passage + " " + " ".join(f"o{rng.randrange(10**9)}" for _ in range(60)) for i in range(400)}
    docs |= {1000 + i: docs[i] + " again" for i in range(3)}
    met = []
    original = similar._candidates
    monkeypatch.setattr(similar, "_candidates", lambda rows, *hot: met.append(rows.count()) or original(rows, *hot))
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in drop_similar(df).collect()} == plain_kept(docs) == set(range(400))
    assert sum(met) < 2 * len(docs)


@pytest.mark.parametrize("own", [34, 37, 38, 40, 42])
def test_boilerplate_close_to_the_limit(spark, own):
    rng = random.Random(own)
    passage = " ".join(f"b{i}" for i in range(300))
    docs = {i: " ".join(f"o{rng.randrange(10**9)}" for _ in range(own + i % 3)) + " " + passage for i in range(70)}
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in drop_similar(df).collect()} == plain_kept(docs)


def test_stage_drops_near_copies_beyond_two_bits(spark):
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, df, sf).collect()}
    assert got == plain_kept({r.doc_id: r.text for r in df.collect()})
    assert not {145, 177} & got  # 7 and 11 bits from documents 6 and 1


def test_one_row_of_each_similar_group_stays(awkward, none):
    kept = drop_similar(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 8]
    assert drop_similar(none).count() == 0
    unnamed = awkward.filter(F.col("doc_id").isNull()).unionByName(awkward.filter(F.col("doc_id").isNull()))
    assert drop_similar(unnamed).count() == 2


def test_links_of_simhash_are_part_of_the_result(spark, monkeypatch):
    """Without the search by shared shingles, SimHash still finds the copies that differ little; no link is unconfirmed."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    docs = {0: " ".join(base), 1: " ".join([*base, "more"]), 2: " ".join(base).upper(), 3: " ".join(f"o{i}" for i in range(400)), 4: "", 5: " "}
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    monkeypatch.setattr(similar, "similar_links", lambda texts, shingle, share, known: known)
    assert {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, df, "").collect()} == plain_kept(docs) == {0, 3, 4}


def test_far_members_of_a_family_seldom_meet(spark, monkeypatch):
    """Most edits of one text that are far from it and from each other are no candidates: too many shingles are their own."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    docs = {i: " ".join(edited(rng, base, 12)) for i in range(200)}
    monkeypatch.setattr(similar, "FREQUENT", 10**9)
    met = []
    original = similar._candidates

    def counted(rows, *hot):
        out = original(rows, *hot)
        met.append(out.count())
        return out

    monkeypatch.setattr(similar, "_candidates", counted)
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in drop_similar(df).collect()} == plain_kept(docs)
    assert sum(met) < len(docs) ** 2 / 8  # of 19,900 pairs


def test_copies_too_far_from_each_other_do_not_meet(spark, monkeypatch):
    """Copies of one length with one own edit are linked, those with three are far from all: few of these pairs are joined."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    docs = {i: " ".join(edited(rng, base, 1 if i % 2 else 3)) for i in range(240)}
    met = []
    original = similar._candidates
    monkeypatch.setattr(similar, "_candidates", lambda rows, *hot: met.append(rows.count()) or original(rows, *hot))
    df = spark.createDataFrame(sorted(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in drop_similar(df).collect()} == plain_kept(docs)
    assert met[-1] < 5000  # 14,400 pairs have one edit and three, 7,140 three and three


def test_sketches_never_rule_out_similar_texts():
    rng = random.Random(6)
    for n in (5, 40, 150, 2000):
        for edits in (0, 1, n // 40):
            base = [f"b{i}" for i in range(n)]
            a, b = (similar.shingle_set(" ".join(edited(rng, base, edits)), 5) for _ in range(2))
            x, y = similar.sketch(a), similar.sketch(b)
            assert len(x) == similar.WORDS
            missing = sum(int(p & ~q).bit_count() for p, q in zip(x.view("uint64"), y.view("uint64")))
            assert missing <= len(a) - len(np.intersect1d(a, b))


def test_places_are_bounded_by_both_sizes(spark):
    """Sets of 146 are similar with 130 in common, so neither has its first common shingle after 16 others."""
    side = lambda size, at, fp: F.struct(F.lit(fp).alias("fp"), F.lit((size << 32) + at).alias("place"), F.lit(33).alias("met"))
    pairs = [((146, 16), (146, 20)), ((146, 16), (146, 16)), ((120, 1), (146, 20)), ((120, 2), (146, 20))]
    got = spark.range(1).select(*[similar._met(side(*a, 1), side(*b, 2), Fraction(4, 5), 1).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    assert list(got.first()) == [False, True, True, False]
