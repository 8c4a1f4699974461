"""Passage search, licence scan and language identification."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sparkfeat.llm import langid, wu_manber
from sparkfeat.llm.langid import train_languages
from sparkfeat.llm.license_scan import TEMPLATES, bigrams, scan_licenses, size_bounds
from sparkfeat.llm.wu_manber import Patterns, find_passages, hit_words, merge_spans, words_of


def plain_hits(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        own = words_of(item)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == own[i : i + n]:
                    hit.update(range(p, p + n))
                    found.add(name)
    return len(words), len(hit), sorted(n for n in found if n is not None)


@pytest.mark.parametrize("window", [1, 2, 3, 10])
def test_search_against_plain(window, monkeypatch):
    monkeypatch.setattr(wu_manber, "LANE", 5)
    monkeypatch.setattr(wu_manber, "PART_WORDS", 300)
    monkeypatch.setattr(wu_manber, "PART_CANDIDATES", 7)
    rng = random.Random(window)
    make = lambda n: " ".join(rng.choice("a b c dd É 1".split()) for _ in range(n))
    items = [(str(k), make(rng.randint(0, 14))) for k in range(12)] + [("9", "a b"), (None, "c c a"), ("x", None)]
    texts = [make(rng.randint(0, 60)) for _ in range(40)] + [None, "", "A-B!c"]
    texts += [make(5) + " " + i[1] for i in items if i[1]]
    found = list(Patterns(items, window).find(texts))
    for text, (n, spans, names) in zip(texts, found):
        assert (n, sum(e - s for s, e in zip(spans[::2], spans[1::2])), names) == plain_hits(text, items, window)


def test_spans_merge():
    assert merge_spans([0, 3, 8, 9], [2, 5, 9, 12]) == [0, 5, 8, 12]
    assert merge_spans([], []) == []


def test_passes_over_blocks_agree(spark, awkward, none):
    bench = spark.createDataFrame(
        [(1, "cat sat on the mat and the dog sat on the log"), (2, "der hund"), (3, None), (4, ""), (None, "w1 w2"), (2, "der hund")],
        "item_id long, text string",
    )
    once = find_passages(awkward, bench)
    twice = find_passages(awkward, bench, block_bytes=20)
    assert once.columns == [*awkward.columns, "found"] == twice.columns
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.n, r.found.spans, r.found.items)
    rows = [sorted((key(r) for r in f.withColumn("n", hit_words(f["found"])).collect())) for f in (once, twice)]
    assert rows[0] == rows[1]
    by_id = {r[1]: r for r in rows[0]}
    assert by_id[5][3:] == (12, [1, 13], ["1"])  # blocks of 10 words: from the second word to the last
    assert by_id[6][5] == ["2"] and by_id[4][3] > 0 and by_id[4][5] == []
    assert find_passages(none, bench).count() == 0
    assert find_passages(awkward, bench.limit(0)).filter("size(found.items) > 0 or size(found.spans) > 0").count() == 0
    with pytest.raises(ValueError):
        find_passages(awkward, bench, out="CODE")


def test_size_bounds_lose_no_match():
    for n in (1, 2, 5, 40):
        lo, hi = size_bounds(n, 0.8)
        fits = [a for a in range(1, 200) if 2 * min(a, n) / (a + n) >= 0.8]
        assert (lo, hi) == (fits[0], fits[-1])


def test_licences_of_awkward_rows(awkward, none, spark):
    assert scan_licenses(awkward).filter("size(licenses) > 0").count() == 0
    assert scan_licenses(none).count() == 0
    assert scan_licenses(awkward, {}).count() == awkward.count()
    with pytest.raises(ValueError):
        scan_licenses(awkward, out="Label")


def test_licences_in_every_unit(spark):
    mit = TEMPLATES["MIT text"]
    half = mit.split()
    rows = [
        (1, "Prose first.\nReleased under the MIT license\nmore"),
        (2, "intro\n\n" + " ".join(half[:40]) + "\n" + " ".join(half[40:]) + "\n\nend"),
        (3, " ".join(half[: len(half) // 2])),
        (4, "All rights reserved. " * 500),
        (5, mit.upper()),
    ]
    got = {r.doc_id: [(m.license, m.unit, m.position) for m in r.licenses] for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [("MIT", "line", 1)]
    assert ("MIT text", "paragraph", 1) in got[2]
    assert got[3] == [] and got[5] == [("MIT text", "line", 0)]
    # Repeats do not count: three different bigrams against two, of which two are shared.
    assert bigrams(TEMPLATES["reserved"]) == ["all rights", "rights reserved"]
    assert got[4] == [("reserved", "line", 0)]


def language_rows(n=60):
    rng = random.Random(5)
    vocab = {"en": "the and of with hand thing that".split(), "de": "der und nicht schön mit auf ein".split(), "fr": "le été dans une avec pas où".split()}
    return [(i, " ".join(rng.choice(vocab[k]) for _ in range(30)), k) for i, k in enumerate(sorted(vocab) * n)]


def test_languages(spark, awkward, none):
    df = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    model = train_languages(df.filter("doc_id % 5 <> 1"))
    got = df.select("lang", model.predict(df["text"]).alias("p")).select("lang", "p.*").toDF("want", "lang", "score", "rejected").collect()
    assert all(r.want == r.lang for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    odd = {(r.doc_id, r.text): r.p for r in awkward.select("doc_id", "text", model.predict(awkward["text"]).alias("p")).collect()}
    assert odd[(1, None)].lang == odd[(2, "")].lang == "und"
    assert odd[(8, "1 2 3 !!! $$$ ### @@")].lang == "und" and odd[(8, "1 2 3 !!! $$$ ### @@")].score == 0
    assert odd[(6, [t for i, t in odd if i == 6][0])].lang == "de"
    empty = train_languages(none)
    assert {r.p.lang for r in awkward.select(empty.predict(awkward["text"]).alias("p")).collect()} == {"und"}


def test_far_texts_are_rejected(spark):
    df = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    model = train_languages(df)
    far = spark.createDataFrame([("日本語 漢字 中国 東京 大阪",), ("zzqx xqzz qqxz",)], "text string")
    assert all(r.p.rejected for r in far.select(model.predict(far["text"]).alias("p")).collect())


def test_long_text_is_counted_in_pieces(monkeypatch):
    grams = langid.Grams()
    text = "Der schöne Hund, 12 Katzen und  das Haus. " * 40
    whole, _ = grams.counts([text])
    monkeypatch.setattr(langid, "PIECE", 17)
    pieces, lettered = grams.counts([text])
    assert np.array_equal(whole, pieces) and lettered[0]


def test_held_out_languages(spark):
    from sparkfeat.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert len(rows) > 300 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
