"""Query registry and the inputs the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf}/{name}.parquet")


def hundredths(name: str) -> Column:
    """Amounts and rates as whole hundredths, so that sums are exact in any order."""
    return F.round(F.col(name) * 100)


# The queries below work on these frames. The tables hold no missing cells, so some
# values are turned into NULL, in the SQL twins by the same rule.


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").alias("qty"),
        hundredths("l_discount").alias("disc"),
        hundredths("l_tax").alias("tax"),
        hundredths("l_extendedprice").alias("price"),
        "l_returnflag",
        "l_linestatus",
        F.to_date("l_shipdate").alias("ship"),
    )


SQL_LINES = """lines as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity as qty,
         round(l_discount * 100) as disc, round(l_tax * 100) as tax, round(l_extendedprice * 100) as price,
         l_returnflag, l_linestatus, cast(l_shipdate as date) as ship
  from lineitem)"""


def gappy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with missing cells: no discount, no tax, the largest quantity, line number 7."""
    return lines(spark, sf).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.nullif("l_linenumber", F.lit(7)).cast("double").alias("num"),
        F.nullif("qty", F.lit(50.0)).alias("qty"),
        F.nullif("disc", F.lit(0.0)).alias("disc"),
        F.nullif("tax", F.lit(0.0)).alias("tax"),
    )


SQL_GAPPY = (
    SQL_LINES
    + """, gappy as (
  select l_orderkey, l_partkey, l_suppkey, cast(nullif(l_linenumber, 7) as double) as num,
         nullif(qty, 50.0) as qty, nullif(disc, 0.0) as disc, nullif(tax, 0.0) as tax
  from lines)"""
)


def day_number(name: str) -> Column:
    """Days since the first day of 1992."""
    return F.datediff(F.to_date(name), F.to_date(F.lit("1992-01-01"))).cast("bigint")


def sql_day(name: str) -> str:
    return f"date_diff('day', date '1992-01-01', cast({name} as date))"


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the child table of customers; one priority has no amount, another no status."""
    return read(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        hundredths("o_totalprice").alias("cents"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.round(F.col("o_totalprice") / 1000)).alias("amount"),
        day_number("o_orderdate").alias("day"),
    )


SQL_PURCHASES = f"""purchases as (
  select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, nullif(o_orderpriority, '5-LOW') as priority,
         round(o_totalprice * 100) as cents,
         case when o_orderpriority <> '1-URGENT' then round(o_totalprice / 1000) end as amount,
         {sql_day("o_orderdate")} as day
  from orders)"""


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as entities with a label; every fifth one is unlabelled."""
    test = F.col("c_custkey") % 5 == 0
    return read(spark, sf, "customer").select(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        hundredths("c_acctbal").alias("balance"),
        F.when(~test, (F.col("c_acctbal") < 2000).cast("int")).alias("label"),
        (F.col("c_acctbal") < 2000).cast("int").alias("truth"),
    )


SQL_PEOPLE = """people as (
  select c_custkey, c_nationkey, c_mktsegment, round(c_acctbal * 100) as balance,
         case when c_custkey % 5 <> 0 then cast(c_acctbal < 2000 as int) end as label,
         cast(c_acctbal < 2000 as int) as truth
  from customer)"""
