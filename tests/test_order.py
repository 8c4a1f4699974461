"""Medians, AUC, folds and gaps against brute force, hot groups and small blocks included."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from sparkfeat.operators import ranks, sequence
from sparkfeat.operators.evaluate import (
    best_row,
    kfold,
    mean_importance,
    roc_auc,
    stratified_folds,
    stratified_split,
    top_importance_rows,
)
from sparkfeat.operators.ranks import group_median
from sparkfeat.operators.sequence import gap_mean_max, gap_std, partition_count

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key; values repeat; some are missing."""
    rng = np.random.default_rng(3)
    key = np.where(rng.random(N) < 0.34, 0, rng.integers(1, 60, N))
    pdf = pd.DataFrame({"id": np.arange(N), "k": key, "v": rng.integers(-300, 300, N).astype(float)})
    pdf.loc[rng.random(N) < 0.1, "v"] = np.nan
    pdf["s"] = np.round(rng.normal(size=N), 1) + 0.0
    pdf["y"] = (rng.random(N) < 1 / (1 + np.exp(-pdf.s))).astype(int)
    # a key with missing values only, and one with a single row
    extra = pd.DataFrame({"id": [N, N + 1], "k": [777, 888], "v": [np.nan, 4.0], "s": [0.0, 0.0], "y": [1, 1]})
    pdf = pd.concat([pdf, extra], ignore_index=True)
    from sparkfeat.sources.tables import nan_to_null

    return pdf, nan_to_null(spark.createDataFrame(pdf)).cache()


def test_median(skewed):
    pdf, df = skewed
    got = group_median(df, ["k"], "v", "m").toPandas().set_index("k").m.sort_index()
    want = pdf.groupby("k").v.median().dropna()
    pd.testing.assert_series_equal(got, want, check_names=False, check_dtype=False)


@pytest.mark.parametrize("buckets", [1, 2, 13, 500])
def test_median_does_not_depend_on_buckets(skewed, monkeypatch, buckets):
    pdf, df = skewed
    monkeypatch.setattr(ranks.with_quantile_bucket, "__defaults__", (buckets,)) if buckets > 1 else None
    got = group_median(df, ["k"], "s", "m").toPandas().set_index("k").m.sort_index()
    np.testing.assert_allclose(got, pdf.groupby("k").s.median())


def brute_auc(y, s):
    pos, neg = s[y == 1].to_numpy(), s[y == 0].to_numpy()
    if not len(pos) or not len(neg):
        return None
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc(skewed):
    pdf, df = skewed
    assert roc_auc(df, "y", "s").first()["auc"] == pytest.approx(brute_auc(pdf.y, pdf.s), abs=1e-12)
    got = {r["k"]: r["auc"] for r in roc_auc(df, "y", "s", ["k"]).collect()}
    for k, part in pdf.groupby("k"):
        want = brute_auc(part.y, part.s)
        assert got[k] is None if want is None else got[k] == pytest.approx(want, abs=1e-12)


def test_auc_of_ties_is_half(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (0, 1.0), (1, 1.0)], "y int, s double")
    assert roc_auc(df, "y", "s").first()["auc"] == 0.5


def test_auc_agrees_with_spark_evaluator(spark, skewed):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, df = skewed
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert roc_auc(df, "y", "s").first()["auc"] == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_folds_are_stratified_and_stable(skewed):
    _, df = skewed
    folded = stratified_folds(df.select("id", "y"), "id", "y", 5, 9).toPandas()
    sizes = folded.groupby(["y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1)).max() <= 1
    again = stratified_folds(df.select("id", "y").repartition(7), "id", "y", 5, 9).toPandas()
    pd.testing.assert_frame_equal(
        folded.sort_values("id").reset_index(drop=True), again.sort_values("id").reset_index(drop=True)
    )
    other = stratified_folds(df.select("id", "y"), "id", "y", 5, 10).toPandas()
    both = folded.merge(other, on="id", suffixes=("", "_other"))
    # another seed is another partition, not the same one with its folds renamed
    assert both.groupby("fold").fold_other.nunique().min() > 1


def test_split_takes_the_share_of_each_label(skewed):
    pdf, df = skewed
    got = stratified_split(df.select("id", "y"), "id", "y", 0.33).toPandas().groupby("y").is_test.sum()
    want = np.ceil(pdf.groupby("y").size() * 0.33)
    assert (got == want).all()


def test_kfold_handles_any_key(spark):
    keys = [(0,), (-5,), (2**62,), (10**15 + 7,)]
    folds = [r[0] for r in spark.createDataFrame(keys, "k bigint").select(kfold("k", 5, 3)).collect()]
    assert all(0 <= f < 5 for f in folds)


def brute_gaps(pdf):
    s = pdf.sort_values(["k", "v"])
    gap = s.groupby("k").v.diff()
    return s, gap


@pytest.mark.parametrize("ranges", [1, 4, 23])
def test_gaps(spark, skewed, ranges):
    pdf, df = skewed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        check_gaps(pdf, df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def check_gaps(pdf, df):
    s, gap = brute_gaps(pdf)
    filled = gap.fillna(gap.mean())
    want = filled.groupby(s.k).std()
    got = gap_std(df, "k", "v", "sd").toPandas().set_index("k").sd.sort_index()
    np.testing.assert_allclose(got.astype(float), want, rtol=1e-8, atol=1e-7)

    whole = gap.fillna(gap.mean()).astype("int64").groupby(s.k).agg(["mean", "max"])
    got = gap_mean_max(df, "k", "v", "mean", "max").toPandas().set_index("k").sort_index()
    np.testing.assert_allclose(got["mean"].astype(float), whole["mean"])
    np.testing.assert_allclose(got["max"].astype(float), whole["max"])


def test_a_hot_key_of_far_apart_values_is_spread(spark, monkeypatch):
    """A million values of one key, far apart: no range holds much more than its part of them."""
    kept = []
    original = sequence.stored
    monkeypatch.setattr(sequence, "stored", lambda df: kept.append(original(df)) or kept[-1])
    df = spark.range(1_000_000).select(F.lit(7).alias("k"), (F.col("id") * 1_000_003 + F.col("id") % 13).alias("v"))
    got = gap_mean_max(df, "k", "v", "mean", "max").first()
    sizes = [r["count"] for r in kept[0].groupBy("part").count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) > 1 and max(sizes) < 2 * 1_000_000 / len(sizes)
    assert got["max"] == 1_000_004 and got["mean"] == pytest.approx(1_000_003, abs=1)


def test_equal_numbers_are_a_gap_of_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 4), (2, 1)], "k int, v int")
    # gaps 0 and 1, mean 0.5; the first rows take the mean
    got = {r["k"]: r["sd"] for r in gap_std(df, "k", "v", "sd").collect()}
    assert got[1] == pytest.approx(0.5)
    assert got[2] is None


def test_partition_count(skewed):
    pdf, df = skewed
    got = partition_count(df, "k", "v", "n").toPandas().set_index("k").n.sort_index()
    assert (got == pdf.groupby("k").v.count()).all()


def test_importance(spark):
    rows = [(f"f{i:02d}", float(i % 7), fold) for i in range(20) for fold in (1, 2)]
    df = spark.createDataFrame(rows, "feature string, importance double, fold int")
    best = [r["feature"] for r in mean_importance(df, 3).collect()]
    assert best == ["f06", "f13", "f05"]
    assert top_importance_rows(df, 3).count() == 6


def test_best_row_prefers_the_first_on_ties(spark):
    df = spark.createDataFrame([(2, 0.9), (1, 0.9), (0, 0.1)], "candidate int, Score_Weighted double")
    assert best_row(df, "candidate").first()["candidate"] == 1
