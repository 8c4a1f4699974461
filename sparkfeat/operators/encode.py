"""Target, frequency and scaling encoders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col, integer_columns
from sparkfeat.functions.scalars import ratio
from sparkfeat.operators.impute import global_values
from sparkfeat.operators.lookup import MAX_BROADCAST_ROWS, counted_lookup
from sparkfeat.sources.checkpoints import stored

MAX_EXPONENT = 700.0


def smoothed_mean(mean: Column, n: Column, prior: Column, min_samples_leaf: int, smoothing: Column) -> Column:
    """Blend of category mean and prior, the mean weighing more the larger the category.

    With a smoothing of 0 the blend is a step: the mean above ``min_samples_leaf`` rows,
    the prior at or below it. A category without rows gets the prior.
    """
    excess = (n - F.lit(min_samples_leaf)).cast("double")
    exponent = F.try_divide(-excess, smoothing)
    weight = 1 / (1 + F.exp(F.least(F.greatest(exponent, F.lit(-MAX_EXPONENT)), F.lit(MAX_EXPONENT))))
    blend = prior * (1 - weight) + mean * weight
    step = F.when(excess > 0, mean).otherwise(prior)
    return F.coalesce(F.when(smoothing == 0, step).otherwise(blend), prior)


def _as_smoothing(smoothing: float | Column) -> Column:
    return smoothing.cast("double") if isinstance(smoothing, Column) else F.lit(float(smoothing))


def target_encode(
    train: DataFrame,
    df: DataFrame,
    column: str,
    label: str,
    out: str,
    min_samples_leaf: int = 1,
    smoothing: float | Column = 1.0,
) -> DataFrame:
    """Smoothed label mean of each row's category; missing and unseen categories get the prior."""
    s = _as_smoothing(smoothing)
    prior = global_values(train, {"prior": F.avg(col(label))})["prior"]
    stats = (
        train.filter(col(column).isNotNull())
        .groupBy(col(column))
        .agg(F.avg(col(label)).alias("__m"), F.count(col(label)).alias("__n"))
    )
    encoded = counted_lookup(df, stats, column).withColumn("__p", prior)
    value = F.when(F.col("__n").isNull(), F.col("__p")).otherwise(
        smoothed_mean(F.col("__m"), F.col("__n"), F.col("__p"), min_samples_leaf, s)
    )
    return encoded.select(*[col(c) for c in df.columns], value.alias(out))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """One row per cell of ``columns`` that holds a value: column name, value, kept columns.

    Grouping this form treats all columns in a single pass; cells of equal value combine
    before the shuffle.
    """
    whole = set(columns) <= set(integer_columns(df))
    kind = "bigint" if whole else "string"
    cells = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast(kind).alias("value")) for c in columns])
    exploded = df.select(F.explode(cells).alias("cell"), *keep)
    kept = [c for c in exploded.columns if c != "cell"]
    return exploded.select("cell.column", "cell.value", *kept).filter("value is not null")


@dataclass(frozen=True)
class ValueTable:
    """Fitted statistics per (column, value), kept, with the number of values of each column."""

    table: DataFrame
    sizes: Mapping[str, int]

    @staticmethod
    def of(table: DataFrame) -> ValueTable:
        kept = stored(table)
        # one row per encoded column comes back
        rows = kept.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
        return ValueTable(kept, {r["column"]: r["n"] for r in rows})

    def attach(self, df: DataFrame, column: str, statistic: str, out: str) -> DataFrame:
        """Left join one column's statistic: broadcast when counted small, else shuffled."""
        part = self.table.filter(F.col("column") == column).select(
            F.col("value").cast(df.schema[column].dataType).alias(column), F.col(statistic).alias(out)
        )
        small = self.sizes.get(column, 0) <= MAX_BROADCAST_ROWS
        return df.join(F.broadcast(part) if small else part, column, "left")


def unseen_shares(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Per column, the share of test rows whose value never occurs in train.

    A missing cell counts as unseen where train has no missing cell.
    """
    counted = long_values(test, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    seen = long_values(train, columns).select("column", "value").distinct()
    rows = counted.join(seen, ["column", "value"], "left_anti").groupBy("column").agg(F.sum("n").alias("n")).collect()
    unseen = {r["column"]: r["n"] for r in rows}
    holes = [F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]]
    a, b = train.agg(*holes).first(), test.agg(*holes).first()
    out = {}
    for i, c in enumerate(columns):
        missing = b["n"] - b[f"c{i}"] if a["n"] == a[f"c{i}"] else 0
        out[c] = (unseen.get(c, 0) + missing) / b["n"] if b["n"] else 0.0
    return out


@dataclass(frozen=True)
class FoldEncoding:
    """Out-of-fold target encodings of several columns, fitted on folded train rows.

    Each (column, value) has an array of ``k`` encodings; entry ``j`` comes from every
    fold but ``j``. One grouped pass over all columns makes them: the sums of the other
    folds are the totals minus the fold's own sums. The ``k`` priors are plain numbers.
    """

    columns: tuple[str, ...]
    values: ValueTable
    priors: tuple[float, ...]

    @staticmethod
    def fit(
        train: DataFrame,
        columns: Sequence[str],
        label: str,
        fold: str,
        k: int,
        min_samples_leaf: int = 100,
        smoothing: float | Mapping[str, float] = 0.0,
    ) -> FoldEncoding:
        y = col(label).cast("double")
        rest = {f"p{j}": F.avg(F.when(col(fold) != j, y)) for j in range(k)}
        whole = train.agg(*[e.alias(n) for n, e in rest.items()]).first()
        priors = tuple(float(whole[f"p{j}"]) for j in range(k))

        cells = long_values(train, columns, [y.alias("y"), col(fold).alias("fold")])
        own = [F.coalesce(F.sum(F.when(F.col("fold") == j, F.col("y"))), F.lit(0.0)).alias(f"y{j}") for j in range(k)]
        sizes = [F.count(F.when(F.col("fold") == j, F.col("y"))).alias(f"n{j}") for j in range(k)]
        grouped = cells.groupBy("column", "value").agg(
            F.coalesce(F.sum("y"), F.lit(0.0)).alias("y"), F.count("y").alias("n"), *own, *sizes
        )
        given = smoothing if isinstance(smoothing, Mapping) else dict.fromkeys(columns, smoothing)
        degrees = F.create_map(*[F.lit(x) for c in columns for x in (c, float(given[c]))])
        s = F.element_at(degrees, F.col("column"))
        entries = []
        for j in range(k):
            y_rest, n_rest = F.col("y") - F.col(f"y{j}"), F.col("n") - F.col(f"n{j}")
            entries.append(smoothed_mean(ratio(y_rest, n_rest), n_rest, F.lit(priors[j]), min_samples_leaf, s))
        table = grouped.select("column", "value", F.array(*entries).alias("enc"))
        return FoldEncoding(tuple(columns), ValueTable.of(table), priors)

    def transform(self, df: DataFrame, fold: str | None = None, prefix: str = "te_") -> DataFrame:
        """Encode train rows with the statistics of the folds they are not in, others with all.

        A row whose ``fold`` is NULL is not a train row: it gets the mean of the ``k``
        encodings of its value. Train and test may share one frame.
        """
        k = len(self.priors)
        out = df
        for i, c in enumerate(self.columns):
            out = self.values.attach(out, c, "enc", f"__enc{i}")
        made = []
        for i, c in enumerate(self.columns):
            enc = F.coalesce(F.col(f"__enc{i}"), F.array(*[F.lit(p) for p in self.priors]))
            mean = sum((enc[j] for j in range(1, k)), enc[0]) / k
            if fold is not None:
                own = F.element_at(enc, col(fold).cast("int") + 1)
                mean = F.when(col(fold).isNotNull(), own).otherwise(mean)
            made.append(mean.alias(prefix + c))
        return out.select(*[col(c) for c in df.columns], *made)


def frequency_encode(df: DataFrame, columns: Sequence[str], prefix: str = "cnt_") -> DataFrame:
    """Add the share of all rows that hold the row's value; NULL for missing cells."""
    total = df.count()
    counts = long_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    values = ValueTable.of(counts.select("column", "value", (F.col("n") / F.lit(max(total, 1))).alias("share")))
    out = df
    for c in columns:
        out = values.attach(out, c, "share", prefix + c)
    return out.select(*[col(c) for c in df.columns], *[col(prefix + c) for c in columns])


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation of each column, fitted in one pass."""

    stats: Mapping[str, tuple[float | None, float | None]]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str]) -> Scaler:
        aggregates = [
            e
            for i, c in enumerate(columns)
            for e in (F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}"))
        ]
        row = df.agg(*aggregates).first()
        return Scaler({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {}
        for c, (mean, spread) in self.stats.items():
            if mean is None or not spread:
                scaled[c] = F.lit(0.0)
            else:
                scaled[c] = F.coalesce((col(c) - F.lit(float(mean))) / F.lit(float(spread)), F.lit(0.0))
        return df.withColumns(scaled)


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; constant columns and missing cells become 0."""
    return Scaler.fit(df, columns).transform(df)


def noise(x: Column, level: float, seed: int) -> Column:
    """Multiply by ``1 + level * standard normal``."""
    return x * (1 + F.lit(level) * F.randn(seed))
