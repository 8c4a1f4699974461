"""Gaps between neighbouring values of a group, and partition counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.functions.scalars import ratio
from sparkfeat.operators.impute import global_values
from sparkfeat.sources.checkpoints import stored

def gap_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, sum, sum of squares and maximum of the gaps between sorted values, per key.

    ``value`` is a whole number such as a day or an instalment number. Rows collapse to
    one per (key, value) before the sort, since equal values are a gap of 0. The pairs are dealt
    into ranges of about equally many of them and stored, so that they stay where they are. Gaps
    inside a range are taken there; those between ranges come from the first and last value
    that a key has in each. So no task sorts more than a range, however many values one key has
    and however far apart they lie, and the last step sees one row per key and range.
    """
    values = (
        df.filter(col(key).isNotNull())
        .groupBy(col(key).alias("k"), col(value).cast("bigint").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranges = stored(values.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("k", "part").orderBy("v")
    step = (F.col("v") - F.lag("v").over(inside)).cast("double")
    parts = (
        ranges.withColumn("gap", step)
        .groupBy("k", "part")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("known"),
            F.min("v").alias("first"),
            F.max("v").alias("last"),
            F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0.0)).alias("squares"),
            F.max(F.greatest(F.col("gap"), F.when((F.col("n") > 1) & F.col("v").isNotNull(), 0.0))).alias("widest"),
        )
    )
    across = Window.partitionBy("k").orderBy("part")
    edge = (F.col("first") - F.lag("last").over(across)).cast("double")
    return (
        parts.withColumn("edge", edge)
        .groupBy("k")
        .agg(
            F.sum("rows").alias("rows"),
            F.greatest(F.coalesce(F.sum("known"), F.lit(0)) - 1, F.lit(0)).alias("gaps"),
            F.coalesce(F.max("last") - F.min("first"), F.lit(0)).cast("double").alias("gap_sum"),
            (F.sum("squares") + F.coalesce(F.sum(F.col("edge") * F.col("edge")), F.lit(0.0))).alias("gap_squares"),
            F.greatest(F.max("widest"), F.max("edge")).alias("gap_max"),
        )
        .withColumnRenamed("k", key)
    )


def mean_gap(summary: DataFrame) -> Column:
    """Mean of all gaps of all keys, from the keys' summaries."""
    return global_values(summary, {"mean": ratio(F.sum("gap_sum"), F.sum("gaps"))})["mean"]


def gap_std(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Sample deviation of the gaps per key; rows without a predecessor count as a mean gap.

    The summaries are stored, so ``df`` is read once for them and their mean.
    """
    mean = F.col("mean_gap")
    n = F.col("rows").cast("double")
    shift = F.col("gap_sum") - F.col("gaps") * mean
    squares = F.col("gap_squares") - 2 * mean * F.col("gap_sum") + F.col("gaps") * mean * mean
    variance = F.greatest((squares - shift * shift / n) / (n - 1), F.lit(0.0))
    summary = stored(gap_summary(df, key, value))
    return summary.withColumn("mean_gap", mean_gap(summary)).select(
        col(key), F.when(n > 1, F.sqrt(variance)).alias(out)
    )


def gap_mean_max(df: DataFrame, key: str, value: str, mean_out: str, max_out: str) -> DataFrame:
    """Mean and maximum gap per key; rows without a predecessor count as the truncated mean gap."""
    fill = F.col("fill")
    filled = F.col("rows") - F.col("gaps")
    summary = stored(gap_summary(df, key, value))
    return summary.withColumn("fill", mean_gap(summary).cast("bigint")).select(
        col(key),
        ratio(F.col("gap_sum") + filled * fill, F.col("rows")).alias(mean_out),
        F.greatest(F.col("gap_max").cast("bigint"), F.when(filled > 0, fill)).alias(max_out),
    )


def partition_count(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Per key, the mean over its rows of the key's count of ``value``.

    That count is the same on every row of the key, so its mean is the count and no
    window is needed.
    """
    return df.filter(col(key).isNotNull()).groupBy(col(key)).agg(F.count(col(value)).cast("double").alias(out))
