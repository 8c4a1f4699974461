"""Two-level statistics, gaps and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.operators.aggregate import aggregate
from sparkfeat.operators.evaluate import mean_importance, top_importance_rows
from sparkfeat.operators.impute import fill_global_mean
from sparkfeat.operators.rollup import attach_child_stats, weighted_rollup
from sparkfeat.operators.sequence import gap_mean_max, gap_std, partition_count
from sparkfeat.queries.registry import (
    SQL_GAPPY,
    SQL_LINES,
    SQL_PURCHASES,
    day_number,
    gappy_lines,
    lines,
    purchases,
    query,
    read,
)
from sparkfeat.sources.checkpoints import stored


@query(
    "two_level_rollup",
    f"""with {SQL_GAPPY}, {SQL_PURCHASES},
    per_order as (select l_orderkey, min(num) as num_min, max(num) as num_max, count(*) as num_size,
                         avg(qty) as qty_mean from gappy group by l_orderkey),
    child as (select * from purchases left join per_order on o_orderkey = l_orderkey)
    select o_custkey, min(day) as "BURO_day_MIN", max(day) as "BURO_day_MAX", coalesce(sum(amount), 0) as "BURO_amount_SUM",
           min(num_min) as "BURO_num_MIN_MIN", max(num_max) as "BURO_num_MAX_MAX", avg(num_size) as "BURO_num_SIZE_MEAN",
           cast(coalesce(sum(num_size), 0) as bigint) as "BURO_num_SIZE_SUM",
           round(avg(qty_mean), 8) as "BURO_qty_MEAN_MEAN"
    from child group by o_custkey""",
)
def two_level_rollup(spark: SparkSession, sf: str) -> DataFrame:
    grandchild = gappy_lines(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    spec = {"num": ["min", "max", "size"], "qty": ["mean"]}
    child = attach_child_stats(purchases(spark, sf), grandchild, "o_orderkey", spec)
    out = aggregate(
        child,
        "o_custkey",
        {
            "day": ["min", "max"],
            "amount": ["sum"],
            "num_MIN": ["min"],
            "num_MAX": ["max"],
            "num_SIZE": ["mean", "sum"],
            "qty_MEAN": ["mean"],
        },
        "BURO_",
    )
    return out.withColumn("BURO_qty_MEAN_MEAN", F.round("BURO_qty_MEAN_MEAN", 8))


SQL_GAP_STD = """gap as (select l_orderkey, l_linenumber - lag(l_linenumber) over (
                        partition by l_orderkey order by l_linenumber) as g from lines),
    seq as (select l_orderkey, stddev_samp(coalesce(g, (select avg(g) from gap))) as seq_std
            from gap group by l_orderkey)"""


@query(
    "sequence_gap_std",
    f"with {SQL_LINES}, {SQL_GAP_STD} select l_orderkey, round(seq_std, 6) as seq_std from seq",
)
def sequence_gap_std(spark: SparkSession, sf: str) -> DataFrame:
    out = gap_std(lines(spark, sf), "l_orderkey", "l_linenumber", "seq_std")
    return out.withColumn("seq_std", F.round("seq_std", 6))


@query(
    "event_gap",
    f"""with {SQL_PURCHASES},
    gap as (select o_custkey, day - lag(day) over (partition by o_custkey order by day) as g from purchases),
    filled as (select o_custkey, coalesce(g, (select cast(trunc(avg(g)) as bigint) from gap)) as g from gap)
    select o_custkey, avg(g) as mean_gap, max(g) as max_gap from filled group by o_custkey""",
)
def event_gap(spark: SparkSession, sf: str) -> DataFrame:
    return gap_mean_max(purchases(spark, sf), "o_custkey", "day", "mean_gap", "max_gap")


@query(
    "weighted_rollup",
    f"""with {SQL_LINES}, {SQL_GAP_STD},
    r as (select o_custkey, l_orderkey, disc - nullif(tax, 0) as short,
                 case when l_linenumber <> 7 then
                   date_diff('day', date '1992-01-01', ship) - date_diff('day', date '1992-01-01', cast(o_orderdate as date))
                 end as late
          from lines join orders on l_orderkey = o_orderkey),
    g as (select l_orderkey, avg(late) as late_mean, avg(short) as short_mean from r group by l_orderkey),
    h as (select l_orderkey, coalesce(late_mean, (select avg(late_mean) from g)) as late_mean,
                 coalesce(short_mean, (select avg(short_mean) from g)) as short_mean from g),
    e as (select o_custkey, avg(seq_std) as seq_std, avg(late_mean) as late_mean, avg(short_mean) as short_mean
          from r left join seq using (l_orderkey) left join h using (l_orderkey) group by o_custkey)
    select o_custkey, round(coalesce(seq_std, (select avg(seq_std) from e)), 7) as seq_std,
           round(coalesce(late_mean, (select avg(late_mean) from e)) + 2e-8, 7) as late_mean,
           round(coalesce(short_mean, (select avg(short_mean) from e)) + 2e-9, 8) as short_mean
    from e""",
)
def weighted(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", day_number("o_orderdate").alias("ordered")
    )
    shipped = F.datediff("ship", F.to_date(F.lit("1992-01-01")))
    rows = lines(spark, sf).join(orders, "l_orderkey").select(
        "o_custkey",
        "l_orderkey",
        (F.col("disc") - F.nullif("tax", F.lit(0.0))).alias("short"),
        F.when(F.col("l_linenumber") != 7, shipped - F.col("ordered")).alias("late"),
    )
    means = rows.groupBy("l_orderkey").agg(F.avg("late").alias("late_mean"), F.avg("short").alias("short_mean"))
    stats = fill_global_mean(stored(means), ["late_mean", "short_mean"]).join(
        gap_std(lines(spark, sf), "l_orderkey", "l_linenumber", "seq_std"), "l_orderkey", "left"
    )
    digits = {"seq_std": 7, "late_mean": 7, "short_mean": 8}
    out = weighted_rollup(rows, "l_orderkey", "o_custkey", stats, list(digits))
    # the shifts keep means over 128 or 256 lines away from rounding ties
    shifted = {"late_mean": F.col("late_mean") + 2e-8, "short_mean": F.col("short_mean") + 2e-9}
    out = out.withColumns(shifted)
    return out.select("o_custkey", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "partition_count",
    """with c as (select o_custkey, count(*) over (partition by o_custkey) as n from orders)
    select o_custkey, avg(n) as n_orders from c group by o_custkey""",
)
def counts(spark: SparkSession, sf: str) -> DataFrame:
    return partition_count(read(spark, sf, "orders"), "o_custkey", "o_orderkey", "n_orders")


SQL_IMPORTANCE = (
    SQL_LINES
    + """, imp as (select p_type || ' ' || p_brand as feature, l_linenumber as fold,
                          cast(sum(qty * (disc + 1)) as double) as importance
                   from lines join part on l_partkey = p_partkey group by 1, 2),
    best as (select feature from imp group by feature order by avg(importance) desc, feature limit 40)"""
)


def importance_table(spark: SparkSession, sf: str) -> DataFrame:
    """Stands in for per-fold importances: revenue weight of part kinds per line number."""
    parts = read(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_type", "p_brand").alias("feature")
    )
    joined = lines(spark, sf).join(parts, "l_partkey")
    weight = F.sum(F.col("qty") * (F.col("disc") + 1))
    return joined.groupBy("feature", F.col("l_linenumber").alias("fold")).agg(weight.alias("importance"))


@query("top_importance", f"with {SQL_IMPORTANCE} select feature, fold, importance from imp semi join best using (feature)")
def top_importance(spark: SparkSession, sf: str) -> DataFrame:
    return top_importance_rows(importance_table(spark, sf), 40).select("feature", "fold", "importance")


@query(
    "mean_importance",
    f"""with {SQL_IMPORTANCE} select feature, avg(importance) as importance from imp semi join best using (feature)
    group by feature""",
)
def importance_means(spark: SparkSession, sf: str) -> DataFrame:
    return mean_importance(importance_table(spark, sf), 40)
