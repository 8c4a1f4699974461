"""Columns of very many values, many distinct counts, a store of families, and awkward names, over the star schema."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.columns import sanitise, sanitise_columns
from sparkfeat.operators.assemble import number_columns
from sparkfeat.operators.categories import Vocabulary, one_hot
from sparkfeat.operators.distinct import Distinct, distinct_counts, sparse_shares
from sparkfeat.plans.formulas import merge_suffixed
from sparkfeat.queries.registry import SQL_LINES, lines, query, read
from sparkfeat.sources.checkpoints import ensure_checkpoint_dir
from sparkfeat.sources.sinks import write_importance
from sparkfeat.sources.store import FeatureStore


def fresh(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


@query(
    "distinct_counts",
    f"""with {SQL_LINES}
    select l_suppkey, count(distinct l_partkey) as parts,
           case when count(*) filter (where l_returnflag = 'R') > 0 then count(distinct case when l_returnflag = 'R' then l_partkey end) end as parts_back,
           case when count(*) filter (where qty > 45) > 0 then count(distinct case when qty > 45 then l_partkey end) end as parts_many,
           case when count(*) filter (where disc = 0) > 0 then count(distinct case when disc = 0 then l_partkey end) end as parts_full,
           case when count(*) filter (where l_linestatus = 'O') > 0 then count(distinct case when l_linestatus = 'O' then ship end) end as days_open,
           case when count(*) filter (where tax > 7) > 0 then count(distinct case when tax > 7 then ship end) end as days_taxed
    from lines group by 1""",
)
def conditional_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Five conditional distinct counts and a plain one per supplier, in one pass."""
    counts = {
        "parts": Distinct("l_partkey"),
        "parts_back": Distinct("l_partkey", F.col("l_returnflag") == "R"),
        "parts_many": Distinct("l_partkey", F.col("qty") > 45),
        "parts_full": Distinct("l_partkey", F.col("disc") == 0),
        "days_open": Distinct("ship", F.col("l_linestatus") == "O"),
        "days_taxed": Distinct("ship", F.col("tax") > 7),
    }
    return distinct_counts(lines(spark, sf), "l_suppkey", counts)


@query(
    "sparse_shares",
    """with v as (select l_suppkey, cast(l_partkey as varchar) as part from lineitem),
    codes as (select part, cast(row_number() over (order by part) - 1 as int) as code from (select distinct part from v)),
    n as (select l_suppkey, part, count(*) as n from v group by 1, 2)
    select l_suppkey, code, round(n / cast(sum(n) over (partition by l_suppkey) as double), 10) as share from n join codes using (part)""",
)
def part_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The share of each part in a supplier's lines: as many values as there are parts, and no column per value."""
    rows, _ = sparse_shares(read(spark, sf, "lineitem"), "l_suppkey", "l_partkey")
    each = rows.select("l_suppkey", F.explode(F.arrays_zip("codes", "shares")).alias("p"))
    return each.select("l_suppkey", F.col("p.codes").alias("code"), F.round("p.shares", 10).alias("share"))


@query(
    "feature_store",
    """with o as (select o_custkey, count(*) as n_orders, max(o_totalprice) as most from orders group by 1),
    e as (select user_id, count(*) as n_events from events where user_id is not null group by 1)
    select c_custkey, c_mktsegment, n_orders as orders__n_orders, most as orders__most, n_events as events__n_events
    from customer left join o on c_custkey = o_custkey left join e on c_custkey = user_id""",
)
def stored_families(spark: SparkSession, sf: str) -> DataFrame:
    """Three families written to a store, one of them replaced, and joined in their buckets."""
    store = FeatureStore(spark, fresh(spark, "store"), "c_custkey", 8)
    orders = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    store.put("customer", read(spark, sf, "customer").select("c_custkey", "c_mktsegment"))
    store.put("orders", orders.agg(F.lit(0).alias("to_be_replaced")))
    store.put("events", read(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_events")))
    store.put("orders", orders.agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("most")))
    return store.matrix("customer", ["orders", "events"])


@query(
    "write_importance",
    """select l_returnflag || '/' || l_linestatus as feature, round(avg(l_quantity), 6) as importance, cast(l_linenumber % 3 + 1 as int) as fold
    from lineitem group by 1, 3""",
)
def importance_file(spark: SparkSession, sf: str) -> DataFrame:
    """An importance table written and read back."""
    feature = F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("feature")
    table = read(spark, sf, "lineitem").groupBy(feature, (F.col("l_linenumber") % 3 + 1).alias("fold")).agg(F.round(F.avg("l_quantity"), 6).alias("importance"))
    path = fresh(spark, "importance")
    write_importance(table, path)
    return spark.read.option("header", True).schema("feature string, importance double, fold int").csv(path)


@query(
    "clashing_columns",
    """with a as (select o_custkey as id, count(*) as n, max(o_totalprice) as most, min(o_orderkey) as own from orders group by 1),
    b as (select c_custkey as id, c_nationkey as n, c_acctbal as bal from customer)
    select b.id, b.n as "0_n_x", bal as "1_MOST_x", a.n as "2_n_y", a.most as "3_most_y", own as "4_own" from b left join a using (id)""",
)
def clashing(spark: SparkSession, sf: str) -> DataFrame:
    """Frames whose names clash (case aside) joined with suffixes, then numbered by position."""
    per = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id"))
    right = per.agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("most"), F.min("o_orderkey").alias("own"))
    left = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("MOST"))
    return number_columns(merge_suffixed(left, right, "id"), ["id"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "sanitise_names",
    f"""select o_orderkey, {", ".join(f'cast(o_orderpriority = {chr(39)}{v}{chr(39)} as int) as "{sanitise("o_orderpriority_" + v)}"' for v in PRIORITIES)},
        o_totalprice as "price__in___" from orders""",
)
def sanitised(spark: SparkSession, sf: str) -> DataFrame:
    """Indicator columns of values with spaces and dashes, under names that any engine takes."""
    df = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("price (in $)"))
    wide = one_hot(df, Vocabulary.fit(df, ["o_orderpriority"]))
    return sanitise_columns(wide)
