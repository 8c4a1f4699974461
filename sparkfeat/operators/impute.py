"""Global statistics and imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col


def global_values(df: DataFrame, aggregates: Mapping[str, Column]) -> dict[str, Column]:
    """Whole-table aggregates as scalar columns usable in any other query.

    All values come from one aggregation, held in a struct and read through a scalar
    subquery: the result is a single row computed once, so there is neither a join nor
    a window over the whole table.
    """
    row = df.agg(F.struct(*[e.alias(n) for n, e in aggregates.items()]).alias("values")).scalar()
    return {n: row.getField(n) for n in aggregates}


def global_means(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return global_values(df, {c: F.avg(col(c)) for c in columns})


def fill_global_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace missing values by the mean of the column over the whole table.

    The frame is read for the means and again for the rows: hand in a table or a stored frame.
    """
    means = global_means(df, columns)
    return df.withColumns({c: F.coalesce(col(c).cast("double"), means[c]) for c in columns})
