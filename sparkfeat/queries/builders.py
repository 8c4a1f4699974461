"""Feature builders over the star schema renamed to credit roles: orders are bureau credits, lines their months."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.plans import library
from sparkfeat.queries.registry import day_number, query, read, sql_day
from sparkfeat.sources.checkpoints import ensure_checkpoint_dir
from sparkfeat.sources.sinks import timestamped, write_matrix, write_predictions
from sparkfeat.sources.tables import load_table


def bureau(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as credits of their customers; some end dates, debts and prolongations are missing."""
    price = F.floor("o_totalprice")
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    status = F.when(F.col("o_orderstatus") == "O", "Active").when(F.col("o_orderstatus") == "F", "Closed")
    return read(spark, sf, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        status.otherwise("Sold").alias("CREDIT_ACTIVE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        day_number("o_orderdate").alias("DAYS_CREDIT"),
        F.when(~low, F.col("o_orderkey") % 701 - 350).alias("DAYS_CREDIT_ENDDATE"),
        price.cast("double").alias("AMT_CREDIT_SUM"),
        F.when(~urgent, F.floor(price / 3)).cast("double").alias("AMT_CREDIT_SUM_DEBT"),
        F.when(~low, F.floor(price / 40)).cast("double").alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(~urgent, F.col("o_orderkey") % 3).alias("CNT_CREDIT_PROLONG"),
    )


SQL_BUREAU = f"""bureau as (
  select o_custkey as "SK_ID_CURR", o_orderkey as "SK_ID_BUREAU",
         case o_orderstatus when 'O' then 'Active' when 'F' then 'Closed' else 'Sold' end as active,
         o_orderpriority as kind, {sql_day("o_orderdate")} as day,
         case when o_orderpriority <> '5-LOW' then o_orderkey % 701 - 350 end as enddate,
         floor(o_totalprice) as credit,
         case when o_orderpriority <> '1-URGENT' then floor(floor(o_totalprice) / 3) end as debt,
         case when o_orderpriority <> '5-LOW' then floor(floor(o_totalprice) / 40) end as overdue,
         case when o_orderpriority <> '1-URGENT' then o_orderkey % 3 end as prolong
  from orders)"""


def balance(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as months of their order, the status following the line number."""
    statuses = F.array(*[F.lit(s) for s in "012345CX"])
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        F.get(statuses, F.col("l_linenumber") % 8).alias("STATUS"),
    )


@query(
    "gen_credit_variety",
    f"""with {SQL_BUREAU}
    select "SK_ID_CURR", count(day) as "BUREAU_LOAN_COUNT", count(distinct kind) as "BUREAU_LOAN_TYPES",
           cast(count(day) as double) / nullif(count(distinct kind), 0) as "AVERAGE_LOAN_TYPE"
    from bureau group by 1""",
)
def credit_variety(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_credit_variety(bureau(spark, sf))


@query(
    "gen_bureau_active",
    f"""with {SQL_BUREAU}
    select "SK_ID_CURR", count(case when active <> 'Closed' then 1 end) as "ACTIVE_COUNT",
           avg(cast(active <> 'Closed' as int)) as "ACTIVE_LOANS_PERCENTAGE"
    from bureau group by 1""",
)
def bureau_active(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_bureau_active(bureau(spark, sf))


@query(
    "gen_day_credit_group",
    f"""with {SQL_BUREAU},
    gap as (select "SK_ID_CURR", day - lag(day) over (partition by "SK_ID_CURR" order by day) as g from bureau),
    filled as (select "SK_ID_CURR", coalesce(g, (select cast(trunc(avg(g)) as bigint) from gap)) as g from gap)
    select "SK_ID_CURR", avg(g) as "MEAN_DAYS_DIFF", max(g) as "MAX_DAYS_DIFF" from filled group by 1""",
)
def day_credit_group(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_day_credit_group(bureau(spark, sf))


@query(
    "gen_bureau_credit_time",
    f"""with {SQL_BUREAU}
    select "SK_ID_CURR", avg(cast(coalesce(enddate >= 0, true) as int)) as "MEAN_CREDIT_TIME",
           max(cast(coalesce(enddate >= 0, true) as int)) as "MAX_CREDIT_TIME"
    from bureau group by 1""",
)
def bureau_credit_time(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_bureau_credit_time(bureau(spark, sf))


@query(
    "gen_loan_count",
    f"""with {SQL_BUREAU}
    select "SK_ID_CURR", max(enddate) as "MAX_DAYS_CREDIT_ENDDATE", count("SK_ID_BUREAU") as "COUNT_SK_ID_BUREAU"
    from bureau where enddate > 0 group by 1""",
)
def loan_count(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_loan_count(bureau(spark, sf))


SQL_FILLED = f"""{SQL_BUREAU}, filled as (
  select "SK_ID_CURR", credit, coalesce(debt, (select avg(debt) from bureau)) as debt,
         coalesce(overdue, (select avg(overdue) from bureau)) as overdue,
         coalesce(prolong, (select avg(prolong) from bureau)) as prolong
  from bureau)"""


@query(
    "gen_cust_debt_to_credit",
    f"""with {SQL_FILLED}
    select "SK_ID_CURR", round(sum(debt) / nullif(sum(credit), 0), 8) as "DEBT_CREDIT_RATIO" from filled group by 1""",
)
def debt_to_credit(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_cust_debt_to_credit(bureau(spark, sf))
    return out.withColumn("DEBT_CREDIT_RATIO", F.round("DEBT_CREDIT_RATIO", 8))


@query(
    "gen_cust_overdue_debt",
    f"""with {SQL_FILLED}
    select "SK_ID_CURR", round(sum(overdue) / nullif(sum(debt), 0), 8) as "OVERDUE_DEBT_RATIO" from filled group by 1""",
)
def overdue_debt(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_cust_overdue_debt(bureau(spark, sf))
    return out.withColumn("OVERDUE_DEBT_RATIO", F.round("OVERDUE_DEBT_RATIO", 8))


@query(
    "gen_avg_prolong",
    f"""with {SQL_FILLED}
    select "SK_ID_CURR", round(avg(prolong), 8) as "AVG_CREDITDAYS_PROLONGED" from filled group by 1""",
)
def avg_prolong(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_avg_prolong(bureau(spark, sf))
    return out.withColumn("AVG_CREDITDAYS_PROLONGED", F.round("AVG_CREDITDAYS_PROLONGED", 8))


SQL_STATUS = ", ".join(
    f"""nullif(count(case when l_linenumber % 8 = {i} then 1 end), 0) as s{i}""" for i in range(8)
)


SQL_MEANS = {"DAYS_CREDIT": "day", "DAYS_CREDIT_ENDDATE": "enddate", "AMT_CREDIT_SUM": "credit", "AMT_CREDIT_SUM_DEBT": "debt",
             "AMT_CREDIT_SUM_OVERDUE": "overdue", "CNT_CREDIT_PROLONG": "prolong"}
KINDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "gen_avg_buro",
    f"""with {SQL_BUREAU},
    months as (select l_orderkey as "SK_ID_BUREAU", {SQL_STATUS} from lineitem group by 1)
    select "SK_ID_CURR", {", ".join(f'avg({x}) as "MEAN_OF_{n}"' for n, x in SQL_MEANS.items())},
           {", ".join(f'avg(s{i}) as "MEAN_OF_STATUS_{x}"' for i, x in enumerate("012345CX"))},
           {", ".join(f"avg(cast(active = '{v}' as int)) as \"MEAN_OF_CREDIT_ACTIVE_{v}\"" for v in ("Active", "Closed", "Sold"))},
           {", ".join(f"avg(cast(kind = '{v}' as int)) as \"MEAN_OF_CREDIT_TYPE_{v}\"" for v in KINDS)},
           count(*) as "BUREAU_COUNT"
    from bureau left join months using ("SK_ID_BUREAU") group by 1""",
)
def avg_buro(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_avg_buro(bureau(spark, sf), balance(spark, sf))


def pos_cash(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as monthly balances of their supplier's loans; some instalment counts and statuses are missing."""
    return read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        F.nullif("l_quantity", F.lit(50.0)).alias("CNT_INSTALMENT"),
        F.round(F.col("l_discount") * 100).cast("int").alias("SK_DPD"),
        F.round(F.col("l_tax") * 100).cast("int").alias("SK_DPD_DEF"),
        F.nullif("l_returnflag", F.lit("A")).alias("NAME_CONTRACT_STATUS"),
    )


SQL_POS = """pos as (
  select l_suppkey as "SK_ID_CURR", l_orderkey, -l_linenumber as "MONTHS_BALANCE", nullif(l_quantity, 50.0) as "CNT_INSTALMENT",
         cast(round(l_discount * 100) as int) as "SK_DPD", cast(round(l_tax * 100) as int) as "SK_DPD_DEF",
         nullif(l_returnflag, 'A') as status
  from lineitem)"""
POS_MEASURES = ["MONTHS_BALANCE", "CNT_INSTALMENT", "SK_DPD", "SK_DPD_DEF"]
SQL_POS_MEANS = ", ".join(f'avg("{m}") as "MEAN_OF_{m}"' for m in POS_MEASURES)


@query(
    "gen_pos_cash_features",
    f"""with {SQL_POS}
    select "SK_ID_CURR", {", ".join(f'max("{m}") as "MAX_OF_{m}"' for m in POS_MEASURES)}, {SQL_POS_MEANS},
           count(l_orderkey) as "COUNT_OF_SK_ID_PREV"
    from pos group by 1""",
)
def pos_cash_features(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_pos_cash_features(pos_cash(spark, sf))


@query(
    "gen_agg_pos_cash",
    f"""with {SQL_POS}
    select "SK_ID_CURR", max("MONTHS_BALANCE") as "MONTHS_BALANCE_MAX", avg("MONTHS_BALANCE") as "MONTHS_BALANCE_MEAN",
           count(*) as "MONTHS_BALANCE_SIZE", max("SK_DPD") as "SK_DPD_MAX", avg("SK_DPD") as "SK_DPD_MEAN",
           max("SK_DPD_DEF") as "SK_DPD_DEF_MAX", avg("SK_DPD_DEF") as "SK_DPD_DEF_MEAN"
    from pos group by 1""",
)
def agg_pos_cash(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_agg_pos_cash(pos_cash(spark, sf))


@query(
    "gen_mean_pos_cash",
    f"""with {SQL_POS},
    codes as (select s, row_number() over (order by s) - 1 as code from (select distinct coalesce(status, 'nan') as s from pos))
    select "SK_ID_CURR", {SQL_POS_MEANS}, cast(count(distinct s) as double) as "MEAN_OF_NUNIQUE_STATUS",
           cast(max(code) as double) as "MEAN_OF_MAX_NUNIQUE_STATUS"
    from pos join codes on s = coalesce(status, 'nan') group by 1""",
)
def mean_pos_cash(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_mean_pos_cash(pos_cash(spark, sf))


def _place(spark: SparkSession, name: str) -> str:
    return f"{timestamped(ensure_checkpoint_dir(spark), name)}-{uuid4().hex}"


@query("write_matrix", 'select o_custkey as "SK_ID_CURR", count(*) as n, max(o_totalprice) as most from orders group by 1')
def matrix_file(spark: SparkSession, sf: str) -> DataFrame:
    """A matrix written and read back."""
    df = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("SK_ID_CURR"))
    path = _place(spark, "matrix")
    write_matrix(df.agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("most")), path)
    return load_table(spark, path)


@query("write_predictions", 'select c_custkey as "SK_ID_CURR", cast(c_nationkey as double) / 32 as "TARGET" from customer')
def predictions_file(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions written as CSV and read back."""
    df = read(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey").cast("double") / 32).alias("p"))
    path = _place(spark, "predictions")
    write_predictions(df.withColumnRenamed("c_custkey", "SK_ID_CURR"), path, "SK_ID_CURR", "p")
    return spark.read.option("header", True).schema("SK_ID_CURR long, TARGET double").csv(path)
