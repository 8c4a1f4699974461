"""Loading, row-level features and imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col, drop_listed, names_containing, numeric_columns, string_columns
from sparkfeat.functions.scalars import (
    RowStat,
    differs_flag,
    null_count,
    payment_columns,
    product,
    ratio,
    sentinel_to_null,
    with_row_stats,
)
from sparkfeat.operators.impute import fill_global_mean
from sparkfeat.queries.registry import (
    SQL_GAPPY,
    SQL_LINES,
    SQL_PEOPLE,
    gappy_lines,
    lines,
    people,
    query,
    read,
)
from sparkfeat.sources.tables import union_labelled

PROFILED = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
}


def profile(df: DataFrame, name: str) -> DataFrame:
    """Row count and missing cells of every column, from one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("c"), (F.col("n") - col(c)).alias("nulls")) for c in df.columns]
    return counts.select(F.col("n"), F.explode(F.array(*cells)).alias("x")).select(
        F.lit(name).alias("table_name"),
        F.col("x.c").alias("column_name"),
        F.col("n").alias("n_rows"),
        F.col("x.nulls").alias("n_nulls"),
    )


@query(
    "load_profile",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls from {t}"
        for t, cs in PROFILED.items()
        for c in cs.split()
    ),
)
def load_profile(spark: SparkSession, sf: str) -> DataFrame:
    parts = [profile(read(spark, sf, t).select(*cs.split()), t) for t, cs in PROFILED.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "train_test_union",
    f"""with {SQL_PEOPLE},
    every as (select c_custkey, c_mktsegment, truth as label from people where c_custkey % 5 <> 0
             union all select c_custkey, c_mktsegment, null from people where c_custkey % 5 = 0)
    select c_custkey, c_mktsegment, label, cast(label is null as int) as is_test from every""",
)
def train_test_union(spark: SparkSession, sf: str) -> DataFrame:
    everyone = people(spark, sf).select("c_custkey", "c_mktsegment", F.col("truth").alias("label"))
    test = F.col("c_custkey") % 5 == 0
    both = union_labelled(everyone.filter(~test), everyone.filter(test).drop("label"))
    return both.withColumn("is_test", F.col("label").isNull().cast("int"))


@query(
    "sentinel_to_null",
    """select l_orderkey, l_partkey, nullif(l_linenumber, 7) as l_linenumber, nullif(l_quantity, 7) as l_quantity
    from lineitem""",
)
def sentinels(spark: SparkSession, sf: str) -> DataFrame:
    df = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return sentinel_to_null(df, ["l_linenumber", "l_quantity"], 7)


@query(
    "ratio_features",
    f"""with {SQL_LINES}
    select l_orderkey, l_linenumber, price / nullif(qty, 0) as unit_price, price / nullif(disc, 0) as price_per_disc,
           tax / nullif(disc, 0) as tax_to_disc, price / nullif(1 + tax, 0) as price_per_tax1
    from lines""",
)
def ratio_features(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        ratio("price", "qty").alias("unit_price"),
        ratio("price", "disc").alias("price_per_disc"),
        ratio("tax", "disc").alias("tax_to_disc"),
        ratio("price", 1 + F.col("tax")).alias("price_per_tax1"),
    )


@query(
    "rowwise_stats",
    f"""with {SQL_GAPPY}
    select l_orderkey, l_partkey, coalesce(list_sum([num, qty, disc, tax]), 0.0) as row_sum,
           list_avg([num, qty, disc, tax]) as row_mean,
           round(list_stddev_samp([num, qty, disc, tax]), 6) as row_std,
           qty * disc * tax as row_product
    from gappy""",
)
def rowwise_stats(spark: SparkSession, sf: str) -> DataFrame:
    cols = ("num", "qty", "disc", "tax")
    stats = [RowStat("row_sum", "sum", cols), RowStat("row_mean", "mean", cols), RowStat("row_std", "std", cols)]
    return with_row_stats(gappy_lines(spark, sf), stats).select(
        "l_orderkey",
        "l_partkey",
        "row_sum",
        "row_mean",
        F.round("row_std", 6).alias("row_std"),
        product("qty", "disc", "tax").alias("row_product"),
    )


# Many of the results are short binary fractions; the shift keeps rounding away from ties.
@query(
    "rowwise_kurtosis",
    f"""with {SQL_GAPPY},
    wide as (select l_orderkey, l_partkey,
                    [num, qty, disc, tax, cast(l_partkey % 3 as double), cast(l_suppkey % 4 as double)] as v,
                    [cast(l_partkey % 2 as double), cast(l_suppkey % 2 as double),
                     cast(l_orderkey % 2 as double), case when tax is not null then 1.0 end] as f
             from gappy)
    select l_orderkey, l_partkey,
           case when list_count(v) >= 4 then
             case when list_var_pop(v) = 0 then 0.0 else round(list_kurtosis(v) + 2e-7, 6) end end as kurt_values,
           case when list_count(f) >= 4 then
             case when list_var_pop(f) = 0 then 0.0 else round(list_kurtosis(f) + 2e-7, 6) end end as kurt_flags
    from wide""",
)
def rowwise_kurtosis(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf).select(
        "*",
        (F.col("l_partkey") % 3).alias("v1"),
        (F.col("l_suppkey") % 4).alias("v2"),
        (F.col("l_partkey") % 2).alias("f1"),
        (F.col("l_suppkey") % 2).alias("f2"),
        (F.col("l_orderkey") % 2).alias("f3"),
        F.when(F.col("tax").isNotNull(), 1).alias("f4"),
    )
    stats = [
        RowStat("kurt_values", "kurt", ("num", "qty", "disc", "tax", "v1", "v2")),
        RowStat("kurt_flags", "kurt", ("f1", "f2", "f3", "f4")),
    ]
    return with_row_stats(df, stats).select(
        "l_orderkey", "l_partkey", *[F.round(F.col(s.name) + 2e-7, 6).alias(s.name) for s in stats]
    )


@query(
    "null_count",
    f"""with {SQL_GAPPY}
    select l_orderkey, l_partkey, cast(num is null as int) + cast(qty is null as int)
           + cast(disc is null as int) + cast(tax is null as int) as nans
    from gappy""",
)
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf)
    return df.select("l_orderkey", "l_partkey", null_count(["num", "qty", "disc", "tax"]).alias("nans"))


@query("drop_listed_columns", "select c_custkey, c_nationkey, c_mktsegment from customer")
def drop_listed_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = read(spark, sf, "customer")
    unwanted = names_containing(df, "_acct") + [c for c in string_columns(df) if "_name" in c]
    return drop_listed(df, [*unwanted, "no_such_column"])


@query(
    "impute_global_mean",
    f"""with {SQL_GAPPY}
    select l_orderkey, l_partkey, coalesce(disc, (select avg(disc) from gappy)) as disc,
           coalesce(tax, (select avg(tax) from gappy)) as tax, coalesce(num, (select avg(num) from gappy)) as num
    from gappy""",
)
def impute_global_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf).select("l_orderkey", "l_partkey", "disc", "tax", "num")
    return fill_global_mean(df, ["disc", "tax", "num"])


@query(
    "payment_behaviour",
    f"""with {SQL_LINES},
    paid as (select l_orderkey, l_linenumber, disc as due, nullif(tax, 8) as paid,
                    cast(date_diff('day', date '1992-01-01', cast(o_orderdate as date)) + 60 as double) as due_day,
                    case when l_linenumber <> 7
                         then cast(date_diff('day', date '1992-01-01', ship) as double) end as paid_day
             from lines join orders on l_orderkey = o_orderkey)
    select l_orderkey, l_linenumber, paid / nullif(due, 0) as "PAYMENT_PERC", due - paid as "PAYMENT_DIFF",
           case when paid_day - due_day > 0 then paid_day - due_day else 0.0 end as "DPD",
           case when due_day - paid_day > 0 then due_day - paid_day else 0.0 end as "DBD"
    from paid""",
)
def payment_behaviour(spark: SparkSession, sf: str) -> DataFrame:
    start = F.to_date(F.lit("1992-01-01"))
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        (F.datediff(F.to_date("o_orderdate"), start) + 60).cast("double").alias("due_day"),
    )
    df = lines(spark, sf).join(orders, "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        F.col("disc").alias("due"),
        F.nullif("tax", F.lit(8.0)).alias("paid"),
        "due_day",
        F.when(F.col("l_linenumber") != 7, F.datediff("ship", start).cast("double")).alias("paid_day"),
    )
    made = payment_columns("due", "paid", "due_day", "paid_day")
    return df.select("l_orderkey", "l_linenumber", *[e.alias(n) for n, e in made.items()])


@query(
    "numeric_flags",
    """select o_orderkey, cast(case when o_orderstatus = 'F' then 0 else 1 end as int) as open_flag,
              cast(case when o_totalprice < 100000 then 0 else 1 end as int) as large_flag
    from orders""",
)
def numeric_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    assert numeric_columns(df, ["o_orderkey"]) == ["o_totalprice"]
    return df.select(
        "o_orderkey",
        differs_flag("o_orderstatus", "F").alias("open_flag"),
        F.when(F.col("o_totalprice") < 100000, 0).otherwise(1).alias("large_flag"),
    )
