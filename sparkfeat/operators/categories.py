"""Category vocabularies and the features built on them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col, string_columns
from sparkfeat.operators.aggregate import agg_column
from sparkfeat.sources.checkpoints import stored

MISSING = "nan"
#: Values a column may have if each is to become a column of its own.
MAX_VALUES = 5000
#: Code rows of one column that are broadcast to its rows.
MAX_BROADCAST_CODES = 100_000


def distinct_values(df: DataFrame, names: Sequence[str], *more: Column) -> DataFrame:
    """``column, value``: the values that occur in each text column, all columns in one pass."""
    return _cells(df, names, *more).filter("value is not null").distinct()


def _cells(df: DataFrame, names: Sequence[str], *more: Column) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in names])
    return df.select(*more, F.explode(cells).alias("cell")).select("cell.*", *[F.col(f"__more{i}") for i in range(len(more))])


@dataclass(frozen=True)
class Vocabulary:
    """Sorted category values of each column; keeps train and score schemas equal."""

    values: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str] | None = None, max_values: int = MAX_VALUES) -> Vocabulary:
        """Collect the distinct values of all columns in one pass.

        A vocabulary is for features that make one column per value, so a column with more
        than ``max_values`` of them is an error and not something to be cut short; code
        tables (``label_codes``, ``first_seen_codes``) have no such bound.
        """
        names = list(columns) if columns is not None else string_columns(df)
        if not names:
            return Vocabulary({})
        found: dict[str, list[str]] = {c: [] for c in names}
        for row in distinct_values(df, names).limit(max_values * len(names) + 1).collect():
            found[row["column"]].append(row["value"])
        wide = sorted(c for c, v in found.items() if len(v) > max_values)
        if wide:
            raise ValueError(f"more than {max_values} category values in {wide}: encode them by codes")
        return Vocabulary({c: tuple(sorted(v)) for c, v in found.items()})

    def only(self, columns: Iterable[str]) -> Vocabulary:
        return Vocabulary({c: self.values[c] for c in columns})

    def indicators(self, missing: bool) -> dict[str, Column]:
        """0/1 columns named ``<column>_<value>``, with ``<column>_nan`` when asked for."""
        out: dict[str, Column] = {}
        for c, values in self.values.items():
            for v in values:
                out[f"{c}_{v}"] = F.when(col(c) == F.lit(v), 1).otherwise(0)
            if missing:
                out[f"{c}_{MISSING}"] = col(c).isNull().cast("int")
        return out


def one_hot(df: DataFrame, vocabulary: Vocabulary, missing: bool = False) -> DataFrame:
    """Replace the vocabulary's columns by indicator columns."""
    kept = [col(c) for c in df.columns if c not in vocabulary.values]
    return df.select(kept + [e.alias(n) for n, e in vocabulary.indicators(missing).items()])


def share_spec(vocabulary: Vocabulary, missing: bool = True, funcs: Sequence[str] = ("mean",)) -> dict[str, list[str]]:
    """Spec of category shares: the mean of an indicator is its share of the rows."""
    return {name: list(funcs) for name in vocabulary.indicators(missing)}


def category_counts(column: str, values: Sequence[str], prefix: str) -> list[Column]:
    """Row count per category as aggregates; a category that does not occur is NULL, not 0."""
    return [
        F.nullif(F.count(F.when(col(column) == F.lit(v), 1)), F.lit(0).cast("bigint")).alias(prefix + v) for v in values
    ]


def codes(column: Column, values: Sequence[str], unknown: int | None) -> Column:
    """Position of each value in ``values``; anything else becomes ``unknown``."""
    if not values:
        return F.lit(unknown).cast("int")
    place = F.array_position(F.array(*[F.lit(v) for v in values]), column)
    code = (F.nullif(place, F.lit(0).cast("bigint")) - 1).cast("int")
    return code if unknown is None else F.coalesce(code, F.lit(unknown))


def sorted_with_missing(df: DataFrame, column: str, vocabulary: Vocabulary) -> list[str]:
    """Sorted values, with missing cells taking part as the text ``nan`` where they occur."""
    values = set(vocabulary.values[column])
    if df.filter(col(column).isNull()).limit(1).count():
        values.add(MISSING)
    return sorted(values)


def _numbered(pairs: DataFrame, *order: str) -> DataFrame:
    """``column, value, code``: codes from 0 in the given order within each column.

    The pairs are dealt into ranges of that order and stored, so that they stay where they
    are; each range is numbered on its own and goes on from the ranges before it. No task
    sees all values of a column.
    """
    ranges = stored(pairs.repartitionByRange("column", *order).withColumn("part", F.spark_partition_id()))
    held = ranges.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("column", "part").orderBy(*order)
    local = ranges.withColumn("code", F.row_number().over(inside) - 1)
    code = (F.col("code") + F.col("start")).cast("int")
    return stored(local.join(starts, ["column", "part"]).select("column", "value", code.alias("code")))


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Code table of alphabetical codes, a missing cell counting as the value ``nan``."""
    filled = df.select(*[F.coalesce(col(c).cast("string"), F.lit(MISSING)).alias(c) for c in columns])
    return _numbered(distinct_values(filled, columns), "value")


def first_seen_codes(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Code table by the smallest ``order`` value that a value occurs with; missing cells have no code."""
    cells = _cells(df, columns, col(order).alias("__more0")).filter("value is not null")
    return _numbered(cells.groupBy("column", "value").agg(F.min("__more0").alias("first")), "first", "value")


def with_codes(
    df: DataFrame, codes: DataFrame, columns: Sequence[str], unknown: int | None = None, missing: str | None = None
) -> DataFrame:
    """Replace each column by its code; values not in the table become ``unknown``.

    ``missing`` is the value that missing cells take. A column's codes are broadcast if they
    are few, and joined by a shuffle that adaptive execution balances if they are many.
    """
    sizes = {r["column"]: r["count"] for r in codes.groupBy("column").count().collect()}
    names = df.columns
    for i, c in enumerate(columns):
        own = codes.filter(F.col("column") == c).select(F.col("value").alias(f"__value{i}"), F.col("code").alias(f"__code{i}"))
        own = F.broadcast(own) if sizes.get(c, 0) <= MAX_BROADCAST_CODES else own
        value = col(c).cast("string") if missing is None else F.coalesce(col(c).cast("string"), F.lit(missing))
        df = df.join(own, value == F.col(f"__value{i}"), "left")
    place = {c: i for i, c in enumerate(columns)}
    code = lambda i: F.col(f"__code{i}") if unknown is None else F.coalesce(f"__code{i}", F.lit(unknown))
    return df.select(*[code(place[c]).alias(c) if c in place else col(c) for c in names])


def status_code_stats(column: str, values: Sequence[str]) -> dict[str, Column]:
    """Distinct statuses and highest status code of a group, as aggregates.

    Codes follow the alphabet, so the highest code is the code of the greatest text and
    no row has to be encoded.
    """
    text = F.coalesce(col(column), F.lit(MISSING))
    return {
        "NUNIQUE_STATUS": agg_column(text, "nunique"),
        "MAX_NUNIQUE_STATUS": codes(F.max(text), values, None),
    }
