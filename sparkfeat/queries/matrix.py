"""The flagship query: three child tables rolled up to one row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.scalars import ratio
from sparkfeat.operators.aggregate import aggregate, subset_ratios
from sparkfeat.operators.assemble import assemble
from sparkfeat.operators.categories import Vocabulary, one_hot, share_spec
from sparkfeat.operators.rollup import attach_child_stats
from sparkfeat.queries.registry import (
    SQL_GAPPY,
    SQL_PEOPLE,
    SQL_PURCHASES,
    day_number,
    gappy_lines,
    hundredths,
    people,
    purchases,
    query,
    read,
    sql_day,
)

NUMERIC = {
    "day": ["min", "max", "mean"],
    "amount": ["max", "mean", "sum"],
    "cents": ["max", "mean"],
    "num_MIN": ["min"],
    "num_MAX": ["max"],
    "num_SIZE": ["mean", "sum"],
    "qty_SUM": ["max", "mean"],
}
STATUSES = {"ACTIVE_": "O", "CLOSED_": "F"}
ROUNDED = {"num_SIZE_MEAN", "qty_SUM_MEAN"}


def sql_spec(prefix: str, status: str | None) -> str:
    sql = {"min": "min({x})", "max": "max({x})", "mean": "avg({x})", "sum": "coalesce(sum({x}), 0)"}
    rows = f"count(case when o_orderstatus = '{status}' then 1 end)"
    parts = []
    for c, funcs in NUMERIC.items():
        kind = "bigint" if c == "num_SIZE" else "double"
        for f in funcs:
            x = c if status is None else f"case when o_orderstatus = '{status}' then {c} end"
            e = sql[f].format(x=x)
            if f == "sum":
                e = f"cast({e} as {kind})"
                if status is not None:
                    e = f"case when {rows} > 0 then {e} end"
            parts.append(f'{e} as "{prefix}{c}_{f.upper()}"')
    return ", ".join(parts)


SUFFIXES = [f"{c}_{f.upper()}" for c, fs in NUMERIC.items() for f in fs]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENTS = ["click", "error", "purchase", "scroll", "signup", "view"]


@query(
    "feature_matrix",
    f"""with {SQL_GAPPY}, {SQL_PURCHASES}, {SQL_PEOPLE},
    per_order as (select l_orderkey, min(num) as "num_MIN", max(num) as "num_MAX", count(*) as "num_SIZE",
                         coalesce(sum(qty), 0) as "qty_SUM" from gappy group by l_orderkey),
    child as (select * from purchases left join per_order on o_orderkey = l_orderkey),
    buro as (select o_custkey as c_custkey, {sql_spec("BURO_", None)},
                    {", ".join(f"avg(case when o_orderstatus = '{v}' then 1 else 0 end) as \"BURO_o_orderstatus_{v}_MEAN\""
                               for v in ["F", "O", "P"])},
                    avg(cast(o_orderstatus is null as int)) as "BURO_o_orderstatus_nan_MEAN",
                    {sql_spec("ACTIVE_", "O")}, {sql_spec("CLOSED_", "F")}
             from child group by o_custkey),
    ev as (select user_id as c_custkey, count(*) as "EV_COUNT", max(day) as "EV_day_MAX", avg(value) as "EV_value_MEAN",
                  sum(value) as "EV_value_SUM"
           from (select user_id, round(value * 100) as value, {sql_day("ts")} as day from events) e
           where user_id is not null group by user_id)
    select c_custkey, label, balance, balance / nullif(1 + c_nationkey, 0) as "NEW_BALANCE_PER_NATION",
           {", ".join(f"case when c_mktsegment = '{v}' then 1 else 0 end as \"c_mktsegment_{v}\"" for v in SEGMENTS)},
           buro.* exclude (c_custkey),
           {", ".join(f"\"ACTIVE_{s}\" / nullif(\"CLOSED_{s}\", 0) as \"NEW_RATIO_BURO_{s}\"" for s in SUFFIXES)},
           ev.* exclude (c_custkey)
    from people left join buro using (c_custkey) left join ev using (c_custkey)""",
)
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    entity = people(spark, sf).select(
        "c_custkey",
        "label",
        "balance",
        ratio("balance", 1 + F.col("c_nationkey")).alias("NEW_BALANCE_PER_NATION"),
        "c_mktsegment",
    )
    entity = one_hot(entity, Vocabulary.fit(entity, ["c_mktsegment"]))

    orders = purchases(spark, sf)
    statuses = Vocabulary.fit(orders, ["o_orderstatus"])
    lines = gappy_lines(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    child = attach_child_stats(orders, lines, "o_orderkey", {"num": ["min", "max", "size"], "qty": ["sum"]})
    buro = aggregate(
        child,
        "o_custkey",
        {**NUMERIC, **share_spec(statuses)},
        "BURO_",
        inputs=statuses.indicators(missing=True),
        subsets={p: (F.col("o_orderstatus") == v, NUMERIC) for p, v in STATUSES.items()},
    )
    ratios = subset_ratios(buro, NUMERIC, "ACTIVE_", "CLOSED_", "NEW_RATIO_BURO_")
    buro = buro.withColumns(ratios).withColumnRenamed("o_custkey", "c_custkey")

    ev = read(spark, sf, "events").select(
        F.col("user_id").alias("c_custkey"), hundredths("value").alias("value"), day_number("ts").alias("day")
    )
    spec = {"day": ["max"], "value": ["mean", "sum"]}
    ev = aggregate(ev, "c_custkey", spec, "EV_", extra=[F.count(F.lit(1)).alias("EV_COUNT")])
    return assemble(entity, [buro, ev], "c_custkey")
