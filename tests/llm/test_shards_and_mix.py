"""Sharding, mixing, and every query that has an SQL twin."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfeat.llm.mixing import full_shares, largest_sample, mix_sources, rake, topic_of
from sparkfeat.llm.queries import ORACLES, QUERIES
from sparkfeat.llm.sharding import assign_shards, hash_code
from tests.compare import connect, differences
from tests.llm.conftest import docs_frame


def plain_shards(codes, limit, depth=0):
    """Label per row of (code, bytes) by splitting on one bit after the other."""
    if sum(b for _, b in codes) <= limit or len({c for c, _ in codes}) == 1:
        return {c: format(codes[0][0], "060b")[:depth] for c, _ in codes} if codes else {}
    out = {}
    for bit in (0, 1):
        part = [(c, b) for c, b in codes if c >> (59 - depth) & 1 == bit]
        if part:
            out |= plain_shards(part, limit, depth + 1)
    return out


@pytest.mark.parametrize("limit", [1, 40, 700, 10**9])
def test_shards_against_splitting_bit_by_bit(spark, limit):
    rng = random.Random(limit)
    rows = [(i if i % 7 else None, "x" * int(rng.paretovariate(0.7) * 3) + str(i), "en", "a") for i in range(300)]
    df = docs_frame(spark, rows)
    coded = df.select(hash_code(F.col("doc_id"), F.col("text")).alias("c"), F.octet_length("text").alias("b")).collect()
    want = plain_shards([(r.c, r.b) for r in coded], limit)
    got = assign_shards(df, limit).select(hash_code(F.col("doc_id"), F.col("text")).alias("c"), "shard.*").collect()
    assert {r.c: r.label for r in got} == want
    sizes, rows_in = {}, {}
    for r in coded:
        sizes[want[r.c]] = sizes.get(want[r.c], 0) + r.b
        rows_in[want[r.c]] = rows_in.get(want[r.c], 0) + 1
    assert all((r.size, r.n) == (sizes[r.label], rows_in[r.label]) for r in got)
    assert all(r.size <= limit or r.n == 1 for r in got)


def test_rows_of_one_code_are_dealt(spark):
    """A third of all rows are the same; their code cannot be split, so they are dealt by number."""
    rows = [(1, "same text", "en", "a")] * 50 + [(i, f"text {i}", "en", "a") for i in range(2, 100)]
    df = docs_frame(spark, rows).repartition(5)
    got = assign_shards(df, 100).select("doc_id", "shard.*").collect()
    assert len(got) == 148 and all(r.size <= 100 for r in got)
    counts = {}
    for r in got:
        counts[r.label] = counts.get(r.label, 0) + 1
    assert all(counts[r.label] == r.n for r in got)
    assert sorted({r.n for r in got if r.doc_id == 1}) == [6, 11]


def test_shards_of_awkward_rows(awkward, none):
    got = assign_shards(awkward, 30, out="shard")
    assert got.columns == [*awkward.columns, "shard"]
    assert got.count() == awkward.count() and got.filter("shard.label is null").count() == 0
    assert got.filter("shard.size > 30 and shard.n > 1").count() == 0
    assert assign_shards(none, 30).count() == 0
    with pytest.raises(ValueError):
        assign_shards(awkward, 30, out="CODE")
    with pytest.raises(ValueError):
        assign_shards(awkward, 0)


def raked(weights, targets, keep, sweeps):
    a, b, c = rake(weights, targets, keep, sweeps)
    return np.minimum(1, keep * a[:, None, None] * b[None, :, None] * c[None, None, :])


def test_raking_meets_all_marginals():
    rng = np.random.default_rng(1)
    weights = rng.uniform(1, 3, (4, 3, 5))
    weights[3, :, :] = 0
    targets = [np.array([0.3, 0.26, 0.24, 0.2]), np.array([0.3, 0.3, 0.4]), np.full(5, 0.2)]
    fitted = weights * raked(weights, targets, 0.3, 200)
    assert fitted.sum() == pytest.approx(0.3 * weights.sum())
    share = fitted / fitted.sum()
    assert np.allclose(share.sum((1, 2)), np.array([0.3, 0.26, 0.24, 0]) / 0.8)  # what has no weight is shared out
    assert np.allclose(share.sum((0, 2)), targets[1]) and np.allclose(share.sum((0, 1)), targets[2])


def test_a_rare_category_does_not_hold_the_others_down():
    weights = np.full((2, 2, 2), 1000.0)
    weights[1] = 0.01
    p = raked(weights, [np.array([0.8, 0.2]), np.array([0.5, 0.5]), np.array([0.5, 0.5])], 0.5, 50)
    assert np.allclose(p[1], 1.0) and np.allclose(p[0], 0.5, atol=1e-3)


def test_the_largest_sample():
    """Nothing goes where the marginals fit; else so much that the targets lack the slack and no more."""
    weights = np.array([[30.0, 20.0], [30.0, 20.0]])
    fits = [np.array([0.5, 0.5]), np.array([0.6, 0.4])]
    assert largest_sample(weights, fits) == 1.0
    rng = np.random.default_rng(4)
    for _ in range(20):
        weights = rng.uniform(0, 1, (4, 3)) ** 3
        targets = [rng.dirichlet(np.ones(4)), rng.dirichlet(np.ones(3))]
        keep = largest_sample(weights, targets, 0.05)
        lacking = lambda k: max(
            1 - np.minimum(t * k * weights.sum(), weights.sum(axis=1 - d)).sum() / (k * weights.sum()) for d, t in enumerate(targets)
        )
        assert lacking(keep) <= 0.05 + 1e-9 and (keep == 1 or lacking(keep) == pytest.approx(0.05))


def test_a_fitting_corpus_is_kept_whole_and_other_languages_stay(spark):
    rows = [(i, "one two three", ["en", "de", None, "xx"][i % 4], "a") for i in range(80)]
    targets = {"source": {"a": 1.0}, "lang": {"en": 0.25, "de": 0.25}}
    out = mix_sources(docs_frame(spark, rows), targets, {"source": F.col("source"), "lang": F.col("lang")})
    assert out.filter("mix.kept").count() == 80


def test_shares():
    assert full_shares({"a": 0.25}) == {"a": 0.25, "other": 0.75}
    for bad in ({"a": -0.1}, {"a": 0.7, "b": 0.7}):
        with pytest.raises(ValueError):
            full_shares(bad)


def test_sample_has_the_target_shares(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(5, 15), rng.choice(["en", "en", "en", "de"]), "big" if i % 3 else "small") for i in range(6000)]
    df = docs_frame(spark, rows)
    targets = {"source": {"big": 0.4, "small": 0.6}, "lang": {"en": 0.5, "de": 0.5}}
    out = mix_sources(df, targets, {"source": F.col("source"), "lang": F.col("lang")}, keep=0.3)
    kept = out.filter("mix.kept").select("source", "lang", F.col("mix.tokens").alias("t")).toPandas()
    shares = lambda c: (kept.groupby(c)["t"].sum() / kept["t"].sum()).to_dict()
    assert shares("source")["small"] == pytest.approx(0.6, abs=0.03)
    assert shares("lang")["de"] == pytest.approx(0.5, abs=0.03)
    total = df.agg(F.sum(F.regexp_count("text", F.lit("w")))).first()[0]
    assert kept["t"].sum() == pytest.approx(0.3 * total, rel=0.05)


def test_mix_of_awkward_rows(awkward, none, spark):
    targets = {"source": {"a": 0.5, "b": 0.5}, "topic": {"prose": 0.6, "tables": 0.1}}
    dims = {"source": F.col("source"), "topic": topic_of(F.col("text"))}
    out = mix_sources(awkward, targets, dims)
    rows = out.collect()
    assert out.columns == [*awkward.columns, "mix"] and len(rows) == awkward.count()
    assert all(0 <= r.mix.probability <= 1 for r in rows)
    assert all(r.mix.probability == 0 and not r.mix.kept for r in rows if r.source not in ("a", "b"))
    assert [r.mix.tokens for r in rows if r.doc_id == 1] == [0]
    twice = [r.mix for r in rows if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert mix_sources(none, targets, dims).count() == 0
    blank = docs_frame(spark, [(1, None, "en", "a"), (2, "", "en", "b")])
    assert mix_sources(blank, targets, dims).filter("mix.kept").count() == 0
    with pytest.raises(ValueError):
        mix_sources(awkward, targets, dims, out="Size")
    with pytest.raises(ValueError):
        mix_sources(awkward, targets, dims, keep=0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []
