"""Lookups of keyed statistics, semi-joins and unseen shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.functions.scalars import ratio
from sparkfeat.sources.checkpoints import stored

MAX_BROADCAST_ROWS = 100_000


def counted_lookup(
    df: DataFrame, table: DataFrame, on: str | list[str], max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Left join a statistics table that has one row per ``on`` value.

    The table is stored and counted first. Up to ``max_rows`` narrow rows it is
    broadcast, and ``df`` is not shuffled at all, so a value held by a third of the
    rows does no harm. Beyond that it is a shuffled join in which adaptive execution
    splits the heavy partitions of ``df``.
    """
    kept = stored(table)
    small = kept.count() <= max_rows
    return df.join(F.broadcast(kept) if small else kept, on, "left")


def keep_listed(df: DataFrame, listed: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` value occurs in ``listed``."""
    return df.join(listed.select(on), on, "left_semi")


def unseen_share(train: DataFrame, test: DataFrame, column: str) -> Column:
    """Share of test rows whose value never occurs in train, as a scalar column.

    Test rows are counted per value before the anti-join, so a value held by many rows
    is one row of the join. Missing values match missing values.
    """
    counts = test.groupBy(col(column).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    seen = train.select(col(column).alias("__t")).distinct()
    unseen = counts.join(seen, F.col("__v").eqNullSafe(F.col("__t")), "left_anti")
    hit = unseen.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).scalar()
    total = test.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ratio(hit, total)
