"""Statistics that travel up more than one level of keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.operators.aggregate import Spec, aggregate
from sparkfeat.operators.impute import fill_global_mean
from sparkfeat.sources.checkpoints import stored


def attach_child_stats(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    spec: Spec,
    inputs: Mapping[str, Column] | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Left join one row of child statistics onto each parent row."""
    return parent.join(aggregate(child, key, spec, inputs=inputs, extra=extra), key, "left")


def weighted_rollup(
    rows: DataFrame, child_key: str, key: str, stats: DataFrame, columns: Sequence[str], fill: bool = True
) -> DataFrame:
    """Mean of child statistics per key, each child weighing as many times as it has rows.

    Equals joining the statistics to every row and averaging, but rows are counted per
    (key, child) first, so the join sees children and not rows. Missing statistics are
    skipped; with ``fill`` a key left without any gets the mean over keys (the result is
    stored for it, so that what is above is not run twice).
    """
    present = rows.filter(col(key).isNotNull())
    weights = present.groupBy(col(key), col(child_key)).agg(F.count(F.lit(1)).cast("double").alias("__w"))
    joined = weights.join(stats, child_key, "left")
    means = {
        c: F.try_divide(F.sum(F.col("__w") * col(c)), F.sum(F.when(col(c).isNotNull(), F.col("__w")))) for c in columns
    }
    out = joined.groupBy(col(key)).agg(*[e.alias(c) for c, e in means.items()])
    return fill_global_mean(stored(out), list(columns)) if fill else out
