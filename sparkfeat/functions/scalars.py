"""Scalar expressions with one fixed rule for missing values.

NULL is the only missing marker. Division by zero gives NULL, never an infinity,
so that a ratio can be averaged or summed without poisoning its group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col

# Fixed value: the "no such day" marker of the day columns.
DAY_SENTINEL = 365243


def as_column(value: Column | str | int | float) -> Column:
    if isinstance(value, Column):
        return value
    return col(value) if isinstance(value, str) else F.lit(value)


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` in double precision, NULL when ``b`` is zero or either side is NULL."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinel: int = DAY_SENTINEL) -> DataFrame:
    return df.withColumns({c: F.nullif(col(c), F.lit(sentinel).cast(df.schema[c].dataType)) for c in columns})


def positive_part(x: Column) -> Column:
    """``max(x, 0)`` where a missing value counts as 0."""
    return F.when(x > 0, x).otherwise(F.lit(0).cast("double"))


def differs_flag(c: Column | str, value: str) -> Column:
    """0 where the column equals ``value``, 1 elsewhere and on NULL."""
    return F.when(as_column(c) == F.lit(value), 0).otherwise(1)


def not_negative_flag(c: Column | str) -> Column:
    """0 where the column is below zero, 1 elsewhere and on NULL."""
    return F.when(as_column(c) < 0, 0).otherwise(1)


def product(*columns: str) -> Column:
    """Product that is NULL as soon as one factor is NULL."""
    return reduce(lambda a, b: a * b, [as_column(c).cast("double") for c in columns])


def null_count(columns: Sequence[str]) -> Column:
    return reduce(add, [col(c).isNull().cast("int") for c in columns], F.lit(0))


def payment_columns(due_amount: str, paid_amount: str, due_day: str, paid_day: str) -> dict[str, Column]:
    """Share paid, amount short, days past due and days before due of one instalment."""
    late = col(paid_day) - col(due_day)
    return {
        "PAYMENT_PERC": ratio(paid_amount, due_amount),
        "PAYMENT_DIFF": col(due_amount) - col(paid_amount),
        "DPD": positive_part(late),
        "DBD": positive_part(-late),
    }


@dataclass(frozen=True)
class RowStat:
    """One statistic across the columns of a row: ``sum``, ``mean``, ``std`` or ``kurt``."""

    name: str
    func: str
    columns: tuple[str, ...]


def with_row_stats(df: DataFrame, stats: Sequence[RowStat]) -> DataFrame:
    """Add row-wise statistics that skip missing cells.

    The sums are plain arithmetic over the columns, in three projections (count and
    mean, then central moments, then results). That stays inside generated code,
    which the array functions with lambdas do not, and each column list is summed
    once however many statistics ask for it.
    """
    lists = list(dict.fromkeys(s.columns for s in stats))
    base: dict[str, Column] = {}
    moments: dict[str, Column] = {}
    for i, cols in enumerate(lists):
        values = [col(c).cast("double") for c in cols]
        count = reduce(add, [v.isNotNull().cast("int") for v in values], F.lit(0))
        total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values], F.lit(0.0))
        base[f"__n{i}"] = count
        base[f"__s{i}"] = total
        base[f"__m{i}"] = F.try_divide(total, count.cast("double"))
        devs = [F.coalesce(v - F.col(f"__m{i}"), F.lit(0.0)) for v in values]
        squares = [d * d for d in devs]
        moments[f"__q{i}"] = reduce(add, squares, F.lit(0.0))
        moments[f"__k{i}"] = reduce(add, [s * s for s in squares], F.lit(0.0))
    results = {s.name: _row_result(s.func, lists.index(s.columns)) for s in stats}
    plain = [c for c in df.columns if c not in results]
    return (
        df.withColumns(base)
        .withColumns(moments)
        .select([col(c) for c in plain] + [e.alias(n) for n, e in results.items()])
    )


def _row_result(func: str, i: int) -> Column:
    n = F.col(f"__n{i}").cast("double")
    q, k = F.col(f"__q{i}"), F.col(f"__k{i}")
    if func == "sum":
        return F.col(f"__s{i}")
    if func == "mean":
        return F.col(f"__m{i}")
    if func == "std":
        return F.when(n > 1, F.sqrt(q / (n - 1)))
    if func == "kurt":
        # Bias-corrected excess kurtosis; 0 on constant rows, NULL under four values.
        spread = (n - 2) * (n - 3) * q * q
        peak = F.try_divide(n * (n + 1) * (n - 1) * k, spread)
        base = F.try_divide(3 * (n - 1) * (n - 1), (n - 2) * (n - 3))
        return F.when(n >= 4, F.when(F.abs(spread) < 1e-14, 0.0).otherwise(peak - base))
    raise ValueError(f"unknown row statistic {func!r}")


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(exprs)) if exprs else df
