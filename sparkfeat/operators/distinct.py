"""Many distinct counts in one pass, and category shares without a column per value."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.operators.categories import first_seen_codes, label_codes


@dataclass(frozen=True)
class Distinct:
    """A distinct count of a column, over all rows or those that satisfy a condition."""

    column: str
    where: Column | None = None


def distinct_counts(df: DataFrame, key: str, counts: Mapping[str, Distinct]) -> DataFrame:
    """One row per key with every count, exact, whatever the number of conditions.

    Rows collapse to (key, column, value), before the shuffle as well, and carry for each count
    whether it has seen the value; then each key's marks are added up. A row is
    multiplied by the number of different columns, not of counts (Spark's own plan for several
    conditional ``count_distinct`` multiplies by the counts). Missing values are not counted; a
    count whose condition no row of the key satisfies is NULL, as for any empty subset.
    """
    columns = list(dict.fromkeys(c.column for c in counts.values()))
    wheres = {n: F.lit(True) if c.where is None else F.coalesce(c.where, F.lit(False)) for n, c in counts.items()}
    rows = df.filter(col(key).isNotNull()).select(
        col(key).alias("__key"),
        *[w.alias(f"__w{i}") for i, w in enumerate(wheres.values())],
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), col(c).cast("string").alias("v")) for c in columns])).alias("__cell"),
    )
    marks = []
    for i, c in enumerate(counts.values()):
        seen = F.col(f"__w{i}") & (F.col("__cell.c") == c.column)
        marks += [F.max(seen.cast("int")).alias(f"__s{i}")]
    values = rows.groupBy("__key", "__cell").agg(*marks)
    out = []
    for i, (name, c) in enumerate(counts.items()):
        counted = F.sum(F.when(F.col("__cell.v").isNotNull(), F.col(f"__s{i}")).otherwise(0)).cast("bigint")
        out.append((counted if c.where is None else F.when(F.max(f"__s{i}") > 0, counted)).alias(name))
    return values.groupBy("__key").agg(*out).withColumnRenamed("__key", key)


def sparse_shares(df: DataFrame, key: str, column: str, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, codes)``: per key the share of its rows that each value has, as sorted codes and their shares.

    For columns of any number of values: there is no column per value and no list of values on
    the driver. Codes are alphabetical, a missing cell counting as ``nan``, or by
    the smallest ``order`` a value occurs with (then missing cells are in no share but in the
    number of rows). ``rows`` has ``codes``, ``shares`` and ``n_rows``; ``codes`` is the code table.
    """
    table = label_codes(df, [column]) if order is None else first_seen_codes(df, [column], order)
    value = col(column).cast("string")
    value = F.coalesce(value, F.lit("nan")) if order is None else value
    counted = df.filter(col(key).isNotNull()).groupBy(col(key), value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    coded = counted.join(table.select("value", "code"), "value", "left")
    pairs = F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "n"))))
    sums = coded.groupBy(col(key)).agg(pairs.alias("pairs"), F.sum("n").alias("n_rows"))
    shares = F.transform("pairs", lambda p: p["n"] / F.col("n_rows"))
    return sums.select(col(key), F.col("pairs.code").alias("codes"), shares.alias("shares"), "n_rows"), table


def merged_shares(shares: DataFrame, key: str) -> DataFrame:
    """Several blocks of shares of a key as one: shares are weighed by their rows."""
    each = shares.select(col(key), F.explode(F.arrays_zip("codes", "shares")).alias("p"), "n_rows")
    counts = each.groupBy(col(key), F.col("p.codes").alias("code")).agg(F.sum(F.col("p.shares") * F.col("n_rows")).alias("n"))
    rows = shares.groupBy(col(key)).agg(F.sum("n_rows").alias("n_rows"))
    sums = counts.groupBy(col(key)).agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("pairs")).join(rows, key)
    return sums.select(col(key), F.col("pairs.code").alias("codes"), F.transform("pairs", lambda p: p["n"] / F.col("n_rows")).alias("shares"), "n_rows")


def share_of(rows: DataFrame, code: int) -> Column:
    """The share of one code, 0 where the key has none."""
    place = F.array_position("codes", F.lit(code)).cast("int")
    return F.when(place > 0, F.get("shares", place - 1)).otherwise(F.lit(0.0))
