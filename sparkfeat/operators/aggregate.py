"""Spec-driven aggregation to one row per key.

A spec is ``{input: [functions]}``. All functions of all inputs, and all row
subsets, become expressions of a single ``groupBy``, so a table is scanned and
shuffled once per key whatever the number of features. Sums, means, deviations,
minima, maxima and counts keep a small fixed state, so rows combine before the
shuffle and one heavy key costs no more than the others. Where keys have few rows
each, nothing combines and the states of many aggregates are wider than the rows:
then the rows are shuffled instead (``grouped``). Medians are made in a
pass of their own, and ``nunique`` makes Spark shuffle the distinct values (with
several conditional ones it first multiplies the rows): ``distinct_counts`` makes
those in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col, numeric_columns
from sparkfeat.functions.scalars import ratio

#: From so many aggregates on, states are taken to be wider than rows.
WIDE = 16
#: From so many rows on, it is looked up how they fall on the keys.
SCATTERED_FROM = 1_000_000
#: Hash buckets the keys are counted in; a bucket with more than ``CROWDED`` times the mean number of rows holds a heavy
#: key, and rows of a bucket with more than ``DEEP`` rows a key combine well.
KEY_BUCKETS, CROWDED, DEEP = 4096, 8, 64

Spec = Mapping[str, Sequence[str]]
Namer = Callable[[str, str], str]


def upper_suffix(prefix: str = "") -> Namer:
    """``AMT``, ``mean`` -> ``<prefix>AMT_MEAN``."""
    return lambda name, func: f"{prefix}{name}_{func.upper()}"


def of_style(name: str, func: str) -> str:
    """``AMT``, ``mean`` -> ``MEAN_OF_AMT``."""
    return f"{func.upper()}_OF_{name}"


def agg_column(x: Column, func: str, where: Column | None = None) -> Column:
    """One aggregate. With ``where`` it covers the rows that satisfy the condition.

    A sum over rows that are all missing is 0, a sum over no rows is NULL, and so are
    the size and the distinct count of an empty subset.
    """
    v = x if where is None else F.when(where, x)
    if func == "min":
        return F.min(v)
    if func == "max":
        return F.max(v)
    if func == "mean":
        return F.avg(v)
    if func == "var":
        return F.var_samp(v)
    if func == "std":
        return F.stddev_samp(v)
    if func == "count":
        return F.count(v)
    if func not in ("sum", "size", "nunique"):
        raise ValueError(f"unknown aggregate {func!r}")
    rows = F.count(F.lit(1)) if where is None else F.count(F.when(where, 1))
    whole = {"sum": lambda: _sum_or_zero(v), "size": lambda: rows, "nunique": lambda: F.count_distinct(v)}[func]()
    return whole if where is None else F.when(rows > 0, whole)


def _sum_or_zero(v: Column) -> Column:
    # bool and int sums stay integral, double sums stay double
    return F.coalesce(F.sum(v), F.lit(0))


def spec_columns(
    spec: Spec,
    namer: Namer,
    inputs: Mapping[str, Column] | None = None,
    where: Column | None = None,
) -> list[Column]:
    """Aliased aggregate expressions of a spec; ``inputs`` supplies derived input columns."""
    derived = inputs or {}
    return [
        agg_column(derived[name] if name in derived else col(name), func, where).alias(namer(name, func))
        for name, funcs in spec.items()
        for func in funcs
        if func != "median"
    ]


def aggregate(
    df: DataFrame,
    key: str | Sequence[str],
    spec: Spec,
    prefix: str = "",
    namer: Namer | None = None,
    inputs: Mapping[str, Column] | None = None,
    subsets: Mapping[str, tuple[Column, Spec]] | None = None,
    extra: Iterable[Column] = (),
) -> DataFrame:
    """One row per key: the spec over all rows, each subset's spec, and extra aggregates.

    ``subsets`` maps a name prefix to ``(condition, spec)``. They are computed as
    conditional aggregates of the same pass instead of filtered scans joined back.
    Rows whose key is NULL are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    name = namer or upper_suffix(prefix)
    exprs = spec_columns(spec, name, inputs)
    for sub_prefix, (condition, sub_spec) in (subsets or {}).items():
        exprs += spec_columns(sub_spec, upper_suffix(sub_prefix), inputs, condition)
    exprs += list(extra)
    present = df.filter(reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys]))
    out = grouped(present, keys, exprs)
    medians = {
        name(c, "median"): inputs[c] if inputs and c in inputs else col(c) for c, funcs in spec.items() if "median" in funcs
    }
    if medians:
        from sparkfeat.operators.ranks import group_medians

        out = out.join(group_medians(present, keys, medians), keys, "left")
    return out


def grouped(rows: DataFrame, keys: Sequence[str], exprs: Sequence[Column]) -> DataFrame:
    """``groupBy(keys).agg(exprs)``; rows of keys with few rows each are shuffled as they are.

    Spark makes a state per key and task before the shuffle. With few rows a key there are about
    as many states as rows, and many aggregates make a state several times as wide as a row, so
    that memory, spill and shuffle grow with both. Keys are counted in ``KEY_BUCKETS`` hash buckets
    first, in a pass over the keys alone. Rows of buckets that hold a heavy key, or many rows a
    key, still combine before the shuffle, so no key is gathered in one task row by row.
    """
    by = [col(k) for k in keys]
    if len(exprs) < WIDE:
        return rows.groupBy(*by).agg(*exprs)
    bucket = F.pmod(F.xxhash64(*by), F.lit(KEY_BUCKETS))
    sizes = rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*by), 0.1).alias("keys"))
    counted = sizes.collect()  # KEY_BUCKETS rows at most
    total = sum(r["n"] for r in counted)
    if total < SCATTERED_FROM:
        return rows.groupBy(*by).agg(*exprs)
    deep = [r["b"] for r in counted if r["n"] > CROWDED * total / KEY_BUCKETS or r["n"] > DEEP * r["keys"]]
    if len(deep) == len(counted):
        return rows.groupBy(*by).agg(*exprs)
    if not deep:
        return rows.repartition(*by).groupBy(*by).agg(*exprs)
    few = rows.filter(~bucket.isin(deep)).repartition(*by).groupBy(*by).agg(*exprs)
    return few.unionByName(rows.filter(bucket.isin(deep)).groupBy(*by).agg(*exprs))


def all_numeric_spec(df: DataFrame, funcs: Sequence[str], exclude: Iterable[str]) -> dict[str, list[str]]:
    """The same functions for every numeric column but the excluded ids."""
    return {c: list(funcs) for c in numeric_columns(df, exclude)}


def subset_ratios(df: DataFrame, spec: Spec, over: str, under: str, out: str) -> dict[str, Column]:
    """``over_f / under_f`` for every feature ``f`` of the spec."""
    suffixes = [f"{c}_{f.upper()}" for c, funcs in spec.items() for f in funcs]
    return {out + s: ratio(over + s, under + s) for s in suffixes}


def filled_sum(x: Column, mean: Column) -> Column:
    """Sum with missing values replaced by ``mean``, as one aggregate expression.

    ``sum(x) + missing * mean`` needs no filled copy of the column, so it shares a pass
    with every other aggregate of the table.
    """
    missing = F.count(F.lit(1)) - F.count(x)
    filled = F.coalesce(missing.cast("double") * mean, F.lit(0.0))
    return F.coalesce(F.sum(x).cast("double"), F.lit(0.0)) + filled


@dataclass(frozen=True)
class Family:
    """Named aggregates of a child table, and the features made of them.

    ``features`` gets a function from aggregate name to column; without it the
    aggregates are the features.
    """

    aggregates: Mapping[str, Column]
    features: Callable[[Callable[[str], Column]], Mapping[str, Column]] | None = None

    @staticmethod
    def of_spec(spec: Spec, namer: Namer, inputs: Mapping[str, Column] | None = None) -> Family:
        derived = inputs or {}
        return Family(
            {
                namer(c, f): agg_column(derived[c] if c in derived else col(c), f)
                for c, funcs in spec.items()
                for f in funcs
            }
        )

    def adding(self, **aggregates: Column) -> Family:
        return Family({**self.aggregates, **aggregates}, self.features)


def family_features(df: DataFrame, key: str, families: Mapping[str, Family]) -> DataFrame:
    """All families of one table in one pass, columns named ``<family>__<feature>``.

    An aggregate that several families share is computed once.
    """
    aggregates = [e.alias(f"{f}__{n}") for f, family in families.items() for n, e in family.aggregates.items()]
    grouped = df.filter(col(key).isNotNull()).groupBy(col(key)).agg(*aggregates)
    outputs = []
    for f, family in families.items():

        def ref(name: str, f: str = f) -> Column:
            return col(f"{f}__{name}")

        made = family.features(ref) if family.features else {n: ref(n) for n in family.aggregates}
        outputs += [e.alias(f"{f}__{n}") for n, e in made.items()]
    return grouped.select(col(key), *outputs)


def one_family(df: DataFrame, key: str, family: Family) -> DataFrame:
    """The features of a single family under their own names."""
    out = family_features(df, key, {"f": family})
    return out.select(col(key), *[col(c).alias(c.removeprefix("f__")) for c in out.columns if c != key])
