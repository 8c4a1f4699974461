"""Exact order statistics without sorting any one group in a single task.

Sorted positions need a total order, and a window per group would hand the largest
group to one task. Here rows first collapse to distinct values, then fall into
buckets that follow the order. Each bucket is sorted on its own, and small
per-bucket totals, at most ``BUCKETS`` per group, give the position where a
bucket starts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.sources.checkpoints import stored

BUCKETS = 128
STRIDE = 12
HASH_SPACE = 1_000_003
HASH_FACTOR = 2_654_435_761
SEED_STEP = 104_729


def with_quantile_bucket(
    rows: DataFrame, df: DataFrame, value: str, out: str, buckets: int = BUCKETS
) -> DataFrame:
    """Add to ``df`` a bucket number that grows with ``value``.

    The bounds are approximate quantiles of ``value`` in ``rows``, read through a scalar
    subquery, so no bucket, of any group, holds much more than ``1 / buckets`` of the rows
    before they collapse to distinct values. Results built on the buckets do not depend
    on where the bounds lie.
    """
    points = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = F.array_distinct(F.percentile_approx(col(value), points, 20 * buckets))
    # every STRIDE-th bound picks a stretch of bounds, so few of them are compared per row
    coarse = F.filter("fine", lambda b, i: i % STRIDE == STRIDE - 1)
    fitted = rows.agg(bounds.alias("fine")).select(F.struct("fine", coarse.alias("coarse")).alias("b"))

    def below(array: Column) -> Column:
        return F.coalesce(F.size(F.filter(array, lambda b: b < col(value))), F.lit(0))

    stretch = F.slice(F.col("__bounds.fine"), F.col("__stretch") * STRIDE + 1, F.lit(STRIDE))
    return (
        df.withColumn("__bounds", fitted.scalar())
        .withColumn("__stretch", below(F.col("__bounds.coarse")))
        .withColumn(out, F.col("__stretch") * STRIDE + below(stretch))
        .drop("__bounds", "__stretch")
    )


def bucket_count(df: DataFrame) -> int:
    """Buckets of a group: at least ``BUCKETS``, more where the session shuffles more widely."""
    return max(BUCKETS, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def group_medians(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Exact medians per key, skipping missing values; a key without any value has no row.

    All columns go through one pass in long form. Rows collapse to distinct values, which
    are stored and then cut into buckets by each column's own quantiles.
    """
    keys = list(keys)
    by = [col(k) for k in keys]
    cells = F.array(*[F.struct(F.lit(i).alias("c"), v.cast("double").alias("v")) for i, v in enumerate(values.values())])
    long = df.filter(by[0].isNotNull()).select(*by, F.explode(cells).alias("cell")).select(*by, "cell.c", "cell.v")
    distinct = stored(long.filter("v is not null").groupBy(*keys, "c", "v").agg(F.count(F.lit(1)).alias("n")))
    buckets = bucket_count(df)
    points = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = distinct.groupBy("c").agg(F.array_distinct(F.percentile_approx("v", points, 20 * buckets)).alias("bounds"))
    # a search by halves: the bounds are sorted
    place = F.aggregate(
        F.sequence(F.lit(1), F.lit(buckets.bit_length())),
        F.struct(F.lit(0).alias("lo"), F.size("bounds").alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s)
        .when(
            F.get("bounds", F.floor((s["lo"] + s["hi"]) / 2).cast("int")) < F.col("v"),
            F.struct((F.floor((s["lo"] + s["hi"]) / 2) + 1).cast("int").alias("lo"), s["hi"].alias("hi")),
        )
        .otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi"))),
    )
    cells = distinct.join(F.broadcast(bounds), "c").withColumn("b", place["lo"]).drop("bounds")
    group = [*keys, "c"]
    order = Window.partitionBy(*group).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = cells.groupBy(*group, "b").agg(F.sum("n").alias("in_bucket"))
    placed = totals.select(
        *group,
        "b",
        "in_bucket",
        F.coalesce(F.sum("in_bucket").over(order), F.lit(0)).alias("before"),
        F.sum("in_bucket").over(whole).alias("all"),
    )
    # 1-based ranks of the two middle rows; they are equal when the count is odd
    low, high = F.expr("(`all` + 1) div 2"), F.expr("`all` div 2 + 1")
    middle = placed.withColumns({"low": low, "high": high}).filter("before < high and before + in_bucket >= low")
    inside = Window.partitionBy(*group, "b").orderBy("v")
    ranked = (
        cells.join(middle.select(*group, "b", "before", "low", "high"), [*group, "b"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("below", F.col("upto") - F.col("n"))
        .filter("(below < low and low <= upto) or (below < high and high <= upto)")
    )
    medians = ranked.groupBy(*group).agg(((F.min("v") + F.max("v")) / 2).alias("m"))
    return medians.groupBy(*keys).agg(*[F.max(F.when(F.col("c") == i, F.col("m"))).alias(n) for i, n in enumerate(values)])


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median of one column per key, skipping missing values; a group without values has no row."""
    return group_medians(df, keys, {out: col(value)})


def fold_hash(key: str, seed: int) -> Column:
    """Even spread of a whole-number key over ``[0, HASH_SPACE)``, the same on every engine.

    The seed changes the factor: added to the product it would only turn the order round,
    and folds cut from that order would stay the same.
    """
    factor = HASH_FACTOR + seed * SEED_STEP
    return F.pmod(F.pmod(col(key), F.lit(HASH_SPACE)) * F.lit(factor) + F.lit(seed), F.lit(HASH_SPACE))


def stratified_rank(df: DataFrame, key: str, label: str, seed: int, rank: str, size: str) -> DataFrame:
    """0-based position of each row within its label in hash order, and the label's row count.

    The hash is even by construction, so equal hash ranges are equal buckets and the
    position of a row is its place in the bucket plus the rows in earlier buckets. A row
    without a label gets no position.
    """
    hashed = df.withColumn("__h", fold_hash(key, seed))
    width = HASH_SPACE // bucket_count(df) + 1
    rows = hashed.withColumn("__b", F.expr(f"__h div {width}"))
    sizes = rows.groupBy(col(label), "__b").agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(col(label)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        col(label),
        "__b",
        F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__start"),
        F.sum("__n").over(Window.partitionBy(col(label))).alias(size),
    )
    inside = Window.partitionBy(col(label), "__b").orderBy("__h", col(key))
    placed = rows.withColumn("__r", F.row_number().over(inside) - 1)
    joined = placed.join(starts, [label, "__b"], "left")
    position = (F.col("__start") + F.col("__r")).alias(rank)
    return joined.select(*[col(c) for c in df.columns], position, col(size))
