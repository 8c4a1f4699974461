"""Closed-form formula features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.sources.checkpoints import stored

#: Formulas of one projection.
CHUNK = 64


def formula_features(df: DataFrame, formulas: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Evaluate ``tanh(formula)`` for each named SQL expression over the columns of ``df``.

    The formulas are the caller's data. The usual pieces read ``+ - * /``, ``tanh(x)``,
    ``greatest(a, b)``, ``least(a, b)``, ``if(c > 0, a, b)`` and
    ``cast(a > b as double)``. They form one projection; with hundreds of them take
    ``formula_chunks``.
    """
    return df.select(*[col(c) for c in keep], *[F.tanh(F.expr(e)).alias(n) for n, e in formulas.items()])


def formula_chunks(
    df: DataFrame, formulas: Mapping[str, str], keep: Sequence[str] = (), size: int = CHUNK
) -> list[DataFrame]:
    """The formulas in projections of at most ``size``, each with the ``keep`` columns.

    Generated code covers a limited number of columns (``spark.sql.codegen.maxFields``), so
    several projections over a stored frame are planned and run faster than a single one.
    ``df`` is read once per chunk: hand in a stored frame.
    """
    names = list(formulas)
    parts = [names[i : i + size] for i in range(0, len(names), size)]
    return [formula_features(df, {n: formulas[n] for n in part}, keep) for part in parts]


def equal_rows(df: DataFrame, columns: Sequence[str], count: str) -> DataFrame:
    """The different rows of ``columns``, each once with its number, stored.

    Formulas depend on their inputs alone, so they are evaluated once per different row. Equal
    rows combine before the shuffle; where all rows differ, there are as many as before.
    """
    return stored(df.groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias(count)))
