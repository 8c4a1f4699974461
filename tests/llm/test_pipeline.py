from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import STAGES
from tests.llm.test_quality import prose
from tests.llm.test_search import plain_hits
from tests.llm.test_shards_and_mix import plain_shards
from tests.llm.test_similar import plain_kept

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and the rows after each stage."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(steps):
    assert [n for n, _ in STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == before.columns and after.count() <= before.count()
    assert steps[-1].columns == [*steps[0].columns, "shard"]


def test_quality_keeps_good_and_drops_bad(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(texts(steps[1]))
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.99 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_near_duplicates_against_all_pairs(steps):
    assert set(texts(steps[2])) == plain_kept(texts(steps[1]))


def test_decontamination_against_plain(spark, steps):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i for i, t in texts(steps[2]).items() if plain_hits(t, items, 10)[1] == 0}
    assert set(texts(steps[3])) == want


def test_mixing_takes_a_sample_and_sharding_keeps_all(steps):
    before, mixed, sharded = (set(texts(s)) for s in steps[3:6])
    assert set() < mixed < before and sharded == mixed
    from sparkfeat.llm.queries import SHARD_BYTES
    from sparkfeat.llm.sharding import hash_code

    coded = steps[5].select("shard", hash_code(F.col("doc_id"), F.col("text")).alias("c"), F.octet_length("text").alias("b")).collect()
    want = plain_shards([(r.c, r.b) for r in coded], SHARD_BYTES)
    assert {r.c: r.shard for r in coded} == want


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1].collect()))


def test_stages_on_awkward_and_no_rows(spark, awkward, none, tmp_path):
    import random

    rng = random.Random(1)
    spark.createDataFrame([(1, prose(rng, 40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(4, 1), (8, 0), (None, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for frame in (awkward, none):
        for name, stage in STAGES:
            got = stage(spark, frame, str(tmp_path))
            assert set(frame.columns) <= set(got.columns), name
            assert got.count() <= frame.count(), name
