"""Aggregates to one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.scalars import differs_flag, not_negative_flag, ratio
from sparkfeat.operators.aggregate import (
    agg_column,
    aggregate,
    all_numeric_spec,
    filled_sum,
    of_style,
    subset_ratios,
)
from sparkfeat.operators.categories import Vocabulary, category_counts, share_spec, status_code_stats
from sparkfeat.operators.impute import global_means
from sparkfeat.operators.lookup import counted_lookup
from sparkfeat.operators.ranks import group_median
from sparkfeat.queries.registry import (
    SQL_GAPPY,
    SQL_LINES,
    SQL_PEOPLE,
    SQL_PURCHASES,
    day_number,
    gappy_lines,
    hundredths,
    lines,
    people,
    purchases,
    query,
    read,
    sql_day,
)


@query(
    "spec_aggregate",
    f"""with {SQL_PURCHASES}
    select o_custkey, min(cents) as "ORD_cents_MIN", max(cents) as "ORD_cents_MAX", avg(cents) as "ORD_cents_MEAN",
           coalesce(sum(amount), 0) as "ORD_amount_SUM", round(var_samp(amount), 6) as "ORD_amount_VAR",
           count(amount) as "ORD_amount_COUNT", count(*) as "ORD_amount_SIZE",
           count(distinct priority) as "ORD_priority_NUNIQUE", median(day) as "ORD_day_MEDIAN"
    from purchases group by o_custkey""",
)
def spec_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    spec = {
        "cents": ["min", "max", "mean"],
        "amount": ["sum", "var", "count", "size"],
        "priority": ["nunique"],
        "day": ["median"],
    }
    out = aggregate(purchases(spark, sf), "o_custkey", spec, "ORD_")
    return out.withColumn("ORD_amount_VAR", F.round("ORD_amount_VAR", 6))


NUMERIC_AGGREGATES = ", ".join(
    f"""min({c}) as "LI_{c}_MIN", max({c}) as "LI_{c}_MAX", avg({c}) as "LI_{c}_MEAN",
        coalesce(sum({c}), 0) as "LI_{c}_SUM", round(var_samp({c}), 6) as "LI_{c}_VAR" """
    for c in ["num", "qty", "disc", "tax"]
)


@query(
    "all_numeric_aggregate",
    f"""with {SQL_GAPPY} select l_orderkey, {NUMERIC_AGGREGATES}, count(*) as "LI_COUNT"
    from gappy group by l_orderkey""",
)
def all_numeric_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf)
    spec = all_numeric_spec(df, ["min", "max", "mean", "sum", "var"], ["l_orderkey", "l_partkey", "l_suppkey"])
    out = aggregate(df, "l_orderkey", spec, "LI_", extra=[F.count(F.lit(1)).alias("LI_COUNT")])
    return out.withColumns({f"LI_{c}_VAR": F.round(f"LI_{c}_VAR", 6) for c in spec})


@query(
    "mean_max_min_count",
    f"""with ev as (select user_id, round(value * 100) as value, {sql_day("ts")} as day from events)
    select user_id, avg(value) as "MEAN_OF_value", max(value) as "MAX_OF_value", min(value) as "MIN_OF_value",
           count(value) as "COUNT_OF_value", avg(day) as "MEAN_OF_day", max(day) as "MAX_OF_day",
           min(day) as "MIN_OF_day", count(day) as "COUNT_OF_day"
    from ev where user_id is not null group by user_id""",
)
def mean_max_min_count(spark: SparkSession, sf: str) -> DataFrame:
    ev = read(spark, sf, "events").select("user_id", hundredths("value").alias("value"), day_number("ts").alias("day"))
    funcs = ["mean", "max", "min", "count"]
    return aggregate(ev, "user_id", {"value": funcs, "day": funcs}, namer=of_style)


STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def sql_share(column: str, value: str) -> str:
    return f"""avg(case when {column} = '{value}' then 1 else 0 end) as "ORD_{column}_{value}_MEAN" """


@query(
    "category_shares",
    f"""with {SQL_PURCHASES}
    select o_custkey, {", ".join(sql_share("o_orderstatus", v) for v in STATUSES)},
           {", ".join(sql_share("priority", v) for v in PRIORITIES)},
           avg(cast(o_orderstatus is null as int)) as "ORD_o_orderstatus_nan_MEAN",
           avg(cast(priority is null as int)) as "ORD_priority_nan_MEAN"
    from purchases group by o_custkey""",
)
def category_shares(spark: SparkSession, sf: str) -> DataFrame:
    df = purchases(spark, sf)
    vocabulary = Vocabulary.fit(df, ["o_orderstatus", "priority"])
    return aggregate(df, "o_custkey", share_spec(vocabulary), "ORD_", inputs=vocabulary.indicators(missing=True))


@query(
    "status_pivot",
    f"""with {SQL_LINES}
    select l_orderkey, {", ".join(
        f"nullif(count(case when l_returnflag = '{v}' then 1 end), 0) as \"STATUS_{v}\"" for v in ["A", "N", "R"])}
    from lines group by l_orderkey""",
)
def status_pivot(spark: SparkSession, sf: str) -> DataFrame:
    df = lines(spark, sf)
    values = Vocabulary.fit(df, ["l_returnflag"]).values["l_returnflag"]
    return df.groupBy("l_orderkey").agg(*category_counts("l_returnflag", values, "STATUS_"))


@query(
    "pivot_then_mean",
    f"""with {SQL_LINES}, {SQL_PURCHASES},
    pv as (select l_orderkey, nullif(count(case when l_returnflag = 'A' then 1 end), 0) as sa,
                  nullif(count(case when l_returnflag = 'N' then 1 end), 0) as sn,
                  nullif(count(case when l_returnflag = 'R' then 1 end), 0) as sr
           from lines group by l_orderkey)
    select o_custkey, avg(amount) as "MEAN_OF_amount", avg(sa) as "MEAN_OF_STATUS_A", avg(sn) as "MEAN_OF_STATUS_N",
           avg(sr) as "MEAN_OF_STATUS_R",
           {", ".join(f"avg(case when o_orderstatus = '{v}' then 1 else 0 end) as \"MEAN_OF_o_orderstatus_{v}\""
                      for v in STATUSES)},
           count(o_orderkey) as "BUREAU_COUNT"
    from purchases left join pv on o_orderkey = l_orderkey group by o_custkey""",
)
def pivot_then_mean(spark: SparkSession, sf: str) -> DataFrame:
    counts = status_pivot(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    df = purchases(spark, sf).join(counts, "o_orderkey", "left")
    vocabulary = Vocabulary.fit(purchases(spark, sf), ["o_orderstatus"])
    spec = {c: ["mean"] for c in ["amount", "STATUS_A", "STATUS_N", "STATUS_R", *vocabulary.indicators(False)]}
    count = F.count("o_orderkey").alias("BUREAU_COUNT")
    return aggregate(df, "o_custkey", spec, namer=of_style, inputs=vocabulary.indicators(False), extra=[count])


SUBSET_SPEC = {"amount": ["min", "max", "mean", "sum", "var"], "day": ["max", "size"], "priority": ["nunique"]}


def sql_subset(prefix: str, value: str) -> str:
    x = f"case when o_orderstatus = '{value}' then amount end"
    d = f"case when o_orderstatus = '{value}' then day end"
    any_row = f"count(case when o_orderstatus = '{value}' then 1 end)"
    return f"""min({x}) as "{prefix}amount_MIN", max({x}) as "{prefix}amount_MAX", avg({x}) as "{prefix}amount_MEAN",
      case when {any_row} > 0 then coalesce(sum({x}), 0) end as "{prefix}amount_SUM",
      round(var_samp({x}), 6) as "{prefix}amount_VAR", max({d}) as "{prefix}day_MAX",
      nullif({any_row}, 0) as "{prefix}day_SIZE",
      case when {any_row} > 0 then count(distinct case when o_orderstatus = '{value}' then priority end) end
        as "{prefix}priority_NUNIQUE" """


@query(
    "subset_aggregate",
    f"""with {SQL_PURCHASES}
    select o_custkey, count(*) as "ALL_day_SIZE", {sql_subset("ACTIVE_", "O")}, {sql_subset("CLOSED_", "F")}
    from purchases group by o_custkey""",
)
def subset_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    subsets = {
        "ACTIVE_": (F.col("o_orderstatus") == "O", SUBSET_SPEC),
        "CLOSED_": (F.col("o_orderstatus") == "F", SUBSET_SPEC),
    }
    out = aggregate(purchases(spark, sf), "o_custkey", {"day": ["size"]}, "ALL_", subsets=subsets)
    return out.withColumns({f"{p}amount_VAR": F.round(f"{p}amount_VAR", 6) for p in subsets})


RATIO_SPEC = {"amount": ["max", "mean", "sum"], "day": ["size"]}


@query(
    "subset_ratio",
    f"""with {SQL_PURCHASES}, s as (
      select o_custkey, {sql_subset("ACTIVE_", "O")}, {sql_subset("CLOSED_", "F")} from purchases group by o_custkey)
    select o_custkey, {", ".join(
        f"\"ACTIVE_{f}\" / nullif(\"CLOSED_{f}\", 0) as \"NEW_RATIO_{f}\""
        for f in ["amount_MAX", "amount_MEAN", "amount_SUM", "day_SIZE"])}
    from s""",
)
def subset_ratio(spark: SparkSession, sf: str) -> DataFrame:
    subsets = {
        "ACTIVE_": (F.col("o_orderstatus") == "O", RATIO_SPEC),
        "CLOSED_": (F.col("o_orderstatus") == "F", RATIO_SPEC),
    }
    both = aggregate(purchases(spark, sf), "o_custkey", {}, subsets=subsets)
    ratios = subset_ratios(both, RATIO_SPEC, "ACTIVE_", "CLOSED_", "NEW_RATIO_")
    return both.select("o_custkey", *[e.alias(n) for n, e in ratios.items()])


@query(
    "credit_variety",
    f"""with {SQL_PURCHASES}
    select o_custkey, count(amount) as loan_count, count(distinct priority) as loan_types,
           cast(count(amount) as double) / nullif(count(distinct priority), 0) as average_loan_type
    from purchases group by o_custkey""",
)
def credit_variety(spark: SparkSession, sf: str) -> DataFrame:
    counted = purchases(spark, sf).groupBy("o_custkey").agg(
        F.count("amount").alias("loan_count"), F.count_distinct("priority").alias("loan_types")
    )
    return counted.withColumn("average_loan_type", ratio("loan_count", "loan_types"))


@query(
    "flag_share",
    f"""with {SQL_PURCHASES},
    f as (select o_custkey, case when o_orderstatus = 'F' then 0 else 1 end as active,
                 case when amount - 100 < 0 then 0 else 1 end as timely from purchases)
    select o_custkey, cast(sum(active) as bigint) as active_count, avg(active) as active_share,
           avg(timely) as mean_timely, max(timely) as max_timely
    from f group by o_custkey""",
)
def flag_share(spark: SparkSession, sf: str) -> DataFrame:
    active, timely = differs_flag("o_orderstatus", "F"), not_negative_flag(F.col("amount") - 100)
    return purchases(spark, sf).groupBy("o_custkey").agg(
        F.sum(active).alias("active_count"),
        F.avg(active).alias("active_share"),
        F.avg(timely).alias("mean_timely"),
        F.max(timely).alias("max_timely"),
    )


@query(
    "open_loans",
    f"""with {SQL_PURCHASES}
    select o_custkey, max(day) as max_day, count(o_orderkey) as n_open
    from purchases where day > 2000 group by o_custkey""",
)
def open_loans(spark: SparkSession, sf: str) -> DataFrame:
    late = purchases(spark, sf).filter(F.col("day") > 2000)
    return late.groupBy("o_custkey").agg(F.max("day").alias("max_day"), F.count("o_orderkey").alias("n_open"))


@query(
    "debt_ratio",
    f"""with {SQL_PURCHASES},
    f as (select o_custkey, coalesce(amount, (select avg(amount) from purchases)) as debt,
                 coalesce(case when o_orderstatus <> 'P' then amount end,
                          (select avg(case when o_orderstatus <> 'P' then amount end) from purchases)) as credit
          from purchases)
    select o_custkey, round(sum(debt) / nullif(sum(credit), 0), 8) as debt_credit_ratio from f group by o_custkey""",
)
def debt_ratio(spark: SparkSession, sf: str) -> DataFrame:
    df = purchases(spark, sf).withColumn("credit", F.when(F.col("o_orderstatus") != "P", F.col("amount")))
    means = global_means(df, ["amount", "credit"])
    share = ratio(filled_sum(F.col("amount"), means["amount"]), filled_sum(F.col("credit"), means["credit"]))
    return df.groupBy("o_custkey").agg(F.round(share, 8).alias("debt_credit_ratio"))


@query(
    "impute_then_mean",
    f"""with {SQL_GAPPY}
    select l_orderkey, round(avg(coalesce(tax, (select avg(tax) from gappy))), 8) as mean_tax
    from gappy group by l_orderkey""",
)
def impute_then_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf)
    total = filled_sum(F.col("tax"), global_means(df, ["tax"])["tax"])
    return df.groupBy("l_orderkey").agg(F.round(ratio(total, F.count(F.lit(1))), 8).alias("mean_tax"))


@query(
    "group_median_lookup",
    f"""with {SQL_PEOPLE},
    m as (select c_mktsegment, median(balance) as segment_median from people group by c_mktsegment)
    select c_custkey, segment_median, balance / nullif(segment_median, 0) as to_median
    from people join m using (c_mktsegment)""",
)
def group_median_lookup(spark: SparkSession, sf: str) -> DataFrame:
    df = people(spark, sf)
    medians = group_median(df, ["c_mktsegment"], "balance", "segment_median")
    joined = counted_lookup(df, medians, "c_mktsegment")
    return joined.select("c_custkey", "segment_median", ratio("balance", "segment_median").alias("to_median"))


@query(
    "group_median",
    f"""with {SQL_GAPPY}
    select l_orderkey % 7 as bin, median(qty) as median_qty, median(disc) as median_disc from gappy group by 1""",
)
def group_medians(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf).withColumn("bin", F.col("l_orderkey") % 7)
    qty, disc = (group_median(df, ["bin"], c, f"median_{c}") for c in ["qty", "disc"])
    return qty.join(disc, "bin")


@query(
    "status_code_stats",
    """with ev as (select user_id, coalesce(nullif(event_type, 'view'), 'nan') as status from events),
    codes as (select status, cast(row_number() over (order by status) - 1 as int) as code
              from (select distinct status from ev) d)
    select user_id, count(distinct status) as "NUNIQUE_STATUS", max(code) as "MAX_NUNIQUE_STATUS"
    from ev join codes using (status) where user_id is not null group by user_id""",
)
def status_codes(spark: SparkSession, sf: str) -> DataFrame:
    ev = read(spark, sf, "events").select("user_id", F.nullif("event_type", F.lit("view")).alias("status"))
    values = sorted([*Vocabulary.fit(ev, ["status"]).values["status"], "nan"])
    stats = status_code_stats("status", values)
    return ev.filter("user_id is not null").groupBy("user_id").agg(*[e.alias(n) for n, e in stats.items()])


@query(
    "group_size",
    """select user_id, count(*) as ev_count, count(nullif(event_type, 'view')) as typed_count
    from events where user_id is not null group by user_id""",
)
def group_size(spark: SparkSession, sf: str) -> DataFrame:
    ev = read(spark, sf, "events").withColumn("typed", F.nullif("event_type", F.lit("view")))
    size, count = agg_column(F.col("typed"), "size"), agg_column(F.col("typed"), "count")
    return ev.filter("user_id is not null").groupBy("user_id").agg(size.alias("ev_count"), count.alias("typed_count"))
