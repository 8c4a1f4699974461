"""Folds, splits, ROC AUC, score tables and importance ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.functions.scalars import ratio
from sparkfeat.operators.lookup import keep_listed
from sparkfeat.operators.ranks import fold_hash, stratified_rank, with_quantile_bucket


def kfold(key: str, k: int, seed: int = 0) -> Column:
    """Fold number from a hash of the key: no shuffle, and stable for a key and seed."""
    return (fold_hash(key, seed) % k).cast("int")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Folds in which every label has the same share, to within one row."""
    ranked = stratified_rank(df, key, label, seed, "__rank", "__size")
    return ranked.withColumn(out, (F.col("__rank") % k).cast("int")).drop("__rank", "__size")


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float, seed: int = 0, out: str = "is_test"
) -> DataFrame:
    """Mark a test part that holds ``ceil(test_share * rows)`` rows of every label."""
    ranked = stratified_rank(df, key, label, seed, "__rank", "__size")
    test = F.col("__rank") < F.ceil(F.col("__size") * F.lit(test_share))
    return ranked.select(*[col(c) for c in df.columns], test.cast("int").alias(out))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), out: str = "auc", count: str | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counting half, over all rows or per group.

    ``count`` names a column that says how many rows a row stands for.

    Rows collapse to distinct scores, scores are sorted per score bucket, and bucket
    totals supply the negatives of the lower buckets. A group with one class is NULL.
    """
    by = list(by)
    y = col(label).cast("int")
    n = F.lit(1) if count is None else col(count)
    rows = df.filter(y.isNotNull() & col(score).isNotNull())
    scores = rows.groupBy(*[col(c) for c in by], col(score).alias("s")).agg(
        F.sum(y * n).cast("double").alias("pos"), F.sum((1 - y) * n).cast("double").alias("neg")
    )
    scores = with_quantile_bucket(rows.select(col(score).alias("s")), scores, "s", "b")
    lower = Window.partitionBy(*by, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("pos") * (F.coalesce(F.sum("neg").over(lower), F.lit(0.0)) + F.col("neg") / 2)
    buckets = (
        scores.withColumn("wins", wins)
        .groupBy(*by, "b")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # at most BUCKETS rows per group are left here
    earlier = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    totals = buckets.withColumn("wins", F.col("wins") + F.col("pos") * F.coalesce(F.sum("neg").over(earlier), F.lit(0.0)))
    return totals.groupBy(*by).agg(ratio(F.sum("wins"), F.sum("pos") * F.sum("neg")).alias(out))


def score_table(
    predictions: DataFrame, key: str, label: str, candidate: str, repeat: str, fold: str, prediction: str
) -> DataFrame:
    """Score every candidate from its repeated cross-validation predictions.

    ``Score`` is the AUC of predictions averaged over repeats per row, ``Score_Std`` the
    population deviation of the fold AUCs, ``Score_Weighted`` the score less a tenth of
    the deviation.
    """
    folds = roc_auc(predictions, label, prediction, [candidate, repeat, fold], "__auc")
    spread = folds.groupBy(candidate).agg(F.stddev_pop("__auc").alias("Score_Std"))
    averaged = predictions.groupBy(col(candidate), col(key)).agg(
        F.avg(col(prediction)).alias("__mean"), F.max(col(label)).alias("__label")
    )
    scores = roc_auc(averaged, "__label", "__mean", [candidate], "Score")
    return scores.join(spread, candidate).withColumn("Score_Weighted", F.col("Score") - 0.1 * F.col("Score_Std"))


def best_row(scores: DataFrame, candidate: str, score: str = "Score_Weighted") -> DataFrame:
    """The row with the highest score; the first candidate wins a tie."""
    return scores.orderBy(F.desc_nulls_last(score), F.asc(candidate)).limit(1)


def mean_importance(importance: DataFrame, k: int = 40) -> DataFrame:
    """The ``k`` features with the highest importance averaged over folds."""
    means = importance.groupBy("feature").agg(F.avg("importance").alias("importance"))
    return means.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


def top_importance_rows(importance: DataFrame, k: int = 40) -> DataFrame:
    """All per-fold rows of the ``k`` most important features."""
    return keep_listed(importance, mean_importance(importance, k), "feature")
