"""More feature builders over the star schema renamed to credit roles; source columns are the same text in both engines."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.plans import library, selected, specs
from sparkfeat.queries.registry import query, read

Source = tuple[str, dict[str, str]]

APPLICATION: Source = (
    "customer",
    {
        "SK_ID_CURR": "c_custkey",
        "DAYS_EMPLOYED": "case when c_custkey % 11 = 0 then 365243 else -(c_custkey % 900) end",
        "DAYS_BIRTH": "-(c_custkey % 20000 + 7000)",
        "AMT_INCOME_TOTAL": "cast(c_nationkey * 100 + c_custkey % 37 as double)",
        "AMT_CREDIT": "cast(c_custkey % 501 as double)",
        "AMT_ANNUITY": "case when c_custkey % 13 <> 0 then cast(c_custkey % 97 as double) end",
        "AMT_GOODS_PRICE": "cast(c_custkey % 401 as double)",
        "CNT_FAM_MEMBERS": "case when c_custkey % 17 <> 0 then cast(c_custkey % 6 as double) end",
        "CNT_CHILDREN": "c_custkey % 4",
        "OWN_CAR_AGE": "case when c_custkey % 3 = 0 then cast(c_custkey % 40 as double) end",
        "DAYS_LAST_PHONE_CHANGE": "cast(-(c_custkey % 2500) as double)",
        "ORGANIZATION_TYPE": "c_mktsegment",
        "EXT_SOURCE_1": "case when c_custkey % 2 = 0 then (c_custkey % 101) / 100.0D end",
        "EXT_SOURCE_2": "case when c_custkey % 7 <> 0 then (c_custkey % 89) / 100.0D end",
        "EXT_SOURCE_3": "case when c_custkey % 5 <> 0 then (c_custkey % 73) / 100.0D end",
        **{f"FLAG_DOCUMENT_{i}": f"cast(c_custkey % {i} = 0 as int)" for i in (2, 3, 5, 6, 8)},
        "FLAG_MOBIL": "1",
        "FLAG_PHONE": "cast(c_custkey % 4 = 0 as int)",
        "FLAG_EMAIL": "cast(c_custkey % 9 = 0 as int)",
        "FLAG_OWN_CAR": "'Y'",
    },
)
BUREAU: Source = (
    "orders",
    {
        "SK_ID_CURR": "o_custkey",
        "SK_ID_BUREAU": "o_orderkey",
        "DAYS_CREDIT": "-(o_orderkey % 2900)",
        "CREDIT_DAY_OVERDUE": "o_orderkey % 5",
        "DAYS_CREDIT_ENDDATE": "case when o_orderkey % 6 <> 0 then o_orderkey % 701 - 350 end",
        "AMT_CREDIT_MAX_OVERDUE": "case when o_orderkey % 4 <> 0 then cast(o_orderkey % 50 as double) end",
        "CNT_CREDIT_PROLONG": "o_orderkey % 3",
        "AMT_CREDIT_SUM": "cast(o_orderkey % 9973 as double)",
        "AMT_CREDIT_SUM_DEBT": "case when o_orderkey % 8 <> 0 then cast(o_orderkey % 4999 as double) end",
        "AMT_CREDIT_SUM_OVERDUE": "cast(o_orderkey % 7 as double)",
        "AMT_CREDIT_SUM_LIMIT": "case when o_orderkey % 3 = 0 then cast(o_orderkey % 211 as double) end",
        "DAYS_CREDIT_UPDATE": "-(o_orderkey % 1000)",
        "AMT_ANNUITY": "case when o_orderkey % 9 <> 0 then cast(o_orderkey % 311 as double) end",
    },
)
BALANCE: Source = ("lineitem", {"SK_ID_BUREAU": "l_orderkey", "MONTHS_BALANCE": "-l_linenumber", "STATUS": "l_returnflag"})
PREVIOUS: Source = (
    "orders",
    {
        "SK_ID_CURR": "o_custkey",
        "SK_ID_PREV": "o_orderkey",
        "NAME_CONTRACT_STATUS": "case o_orderstatus when 'O' then 'Approved' when 'F' then 'Refused' else 'Canceled' end",
        "NAME_CONTRACT_TYPE": "case when o_orderpriority <> '5-LOW' then o_orderpriority end",
        "AMT_ANNUITY": "case when o_orderkey % 7 <> 0 then cast(o_orderkey % 503 as double) end",
        "AMT_APPLICATION": "cast(o_orderkey % 5003 as double)",
        "AMT_CREDIT": "cast(case o_orderkey % 4 when 0 then 0 when 1 then 64 when 2 then 128 else 256 end as double)",
        "AMT_DOWN_PAYMENT": "case when o_orderkey % 2 = 0 then cast(o_orderkey % 71 as double) end",
        "AMT_GOODS_PRICE": "cast(o_orderkey % 4001 as double)",
        "HOUR_APPR_PROCESS_START": "o_orderkey % 24",
        "RATE_DOWN_PAYMENT": "case when o_orderkey % 2 = 0 then (o_orderkey % 64) / 64.0D end",
        "DAYS_DECISION": "-(o_orderkey % 2900)",
        "CNT_PAYMENT": "case when o_orderkey % 10 <> 0 then cast(o_orderkey % 60 as double) end",
        **{
            name: f"case when o_orderkey % {6 + i} = 0 then 365243.0D else cast(-(o_orderkey % {1500 + i}) as double) end"
            for i, name in enumerate(specs.DAY_SENTINEL_COLUMNS)
        },
    },
)
INSTALLMENTS: Source = (
    "lineitem",
    {
        "SK_ID_CURR": "l_suppkey",
        "SK_ID_PREV": "l_orderkey",
        "NUM_INSTALMENT_VERSION": "cast(l_linenumber % 3 as double)",
        "NUM_INSTALMENT_NUMBER": "l_linenumber",
        "DAYS_INSTALMENT": "cast(-l_partkey as double)",
        "DAYS_ENTRY_PAYMENT": "case when l_partkey % 9 <> 0 then cast(l_partkey % 7 - 3 - l_partkey as double) end",
        "AMT_INSTALMENT": "cast(case l_partkey % 4 when 0 then 0 when 1 then 64 when 2 then 128 else 256 end as double)",
        "AMT_PAYMENT": "case when l_partkey % 9 <> 0 then cast(l_partkey % 32 * 32 as double) end",
    },
)
CARDS: Source = (
    "lineitem",
    {
        "SK_ID_CURR": "l_suppkey",
        "SK_ID_PREV": "l_orderkey",
        "MONTHS_BALANCE": "-l_linenumber",
        "AMT_BALANCE": "cast(l_partkey % 997 as double)",
        "AMT_DRAWINGS_CURRENT": "case when l_partkey % 4 <> 0 then cast(l_partkey % 89 as double) end",
        "SK_DPD": "l_partkey % 6",
        "NAME_CONTRACT_STATUS": "case l_returnflag when 'A' then null when 'N' then 'Active' else 'Completed' end",
    },
)


def table(spark: SparkSession, sf: str, source: Source) -> DataFrame:
    name, columns = source
    return read(spark, sf, name).selectExpr(*[f"{e} as `{c}`" for c, e in columns.items()])


def sql_table(source: Source) -> str:
    name, columns = source
    duck = lambda e: e.replace("0D", "0::double")
    return f"(select {', '.join(f'{duck(e)} as \"{c}\"' for c, e in columns.items())} from {name})"


def numbers(source: Source, without: Sequence[str] = ("SK_ID_CURR", "SK_ID_PREV")) -> list[str]:
    """Columns that are numbers: the others are texts of the star schema or made of texts."""
    texts = {"NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "STATUS", "ORGANIZATION_TYPE"}
    return [c for c in source[1] if c not in texts and c not in without]


def sql_agg(column: str, func: str, whole: bool) -> str:
    x = f'"{column}"'
    if func == "size":
        return "count(*)"
    if func == "nunique":
        return f"count(distinct {x})"
    if func == "sum":
        return f"cast(coalesce(sum({x}), 0) as {'bigint' if whole else 'double'})"
    plain = {"min": "min({x})", "max": "max({x})", "mean": "avg({x})", "var": "var_samp({x})"}[func].format(x=x)
    return plain if func in ("min", "max") else f"round({plain}, 4)"


def rounded(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.round(n, 4) for n in names})


def sql_spec(spec: Mapping[str, Sequence[str]], name: Callable[[str, str], str], whole: Sequence[str] = ()) -> str:
    return ", ".join(f'{sql_agg(c, f, c in whole)} as "{name(c, f)}"' for c, funcs in spec.items() for f in funcs)


suffixed = lambda c, f: f"{c}_{f.upper()}"
styled = lambda c, f: f"{f.upper()}_OF_{c}"


def long_columns(df: DataFrame) -> list[str]:
    """Means and variances, whose last digits depend on the order of the rows."""
    return [c for c in df.columns if c.endswith(("_MEAN", "_VAR")) or c.startswith("MEAN_OF_")]


def sql_ratio(pair: tuple[str, str], source: str = "a") -> str:
    return f'"{pair[0]}" / nullif(cast("{pair[1]}" as double), 0)'


SQL_CLEAN = f"""a as (select * replace (nullif("DAYS_EMPLOYED", 365243) as "DAYS_EMPLOYED") from {sql_table(APPLICATION)})"""


@query(
    "gen_relative_calculation",
    f"""with {SQL_CLEAN} select "SK_ID_CURR", {", ".join(f'{sql_ratio(p)} as "{n}"' for n, p in specs.RELATIVE_RATIOS.items())} from a""",
)
def relative_calculation(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_relative_calculation(table(spark, sf, APPLICATION))


@query(
    "gen_reduced_relative_calculation",
    f"""with {SQL_CLEAN} select "SK_ID_CURR", {", ".join(f'{sql_ratio(specs.RELATIVE_RATIOS[n])} as "{n}"' for n in specs.REDUCED_RATIOS)} from a""",
)
def reduced_relative_calculation(spark: SparkSession, sf: str) -> DataFrame:
    return library.gen_reduced_relative_calculation(table(spark, sf, APPLICATION))


DOCUMENTS = [c for c in APPLICATION[1] if c.startswith("FLAG_DOC")]
CONTACTS = ["FLAG_MOBIL", "FLAG_PHONE", "FLAG_EMAIL"]
SQL_FLAGS = ", ".join(f'"{c}"' for c in DOCUMENTS)
SQL_SCORES = ", ".join(f'"{c}"' for c in specs.SCORES)


@query(
    "gen_new_relative_feature",
    f"""with {SQL_CLEAN},
    org as (select "ORGANIZATION_TYPE", median("AMT_INCOME_TOTAL") as "INCOME_BY_ORG" from a group by 1),
    made as (
      select a."SK_ID_CURR", "INCOME_BY_ORG", {", ".join(f'{sql_ratio(p)} as "{n}"' for n, p in specs.NEW_RELATIVE_RATIOS.items())},
             "AMT_INCOME_TOTAL" / nullif(1 + "CNT_CHILDREN", 0) as "INCOME_PER_CHLD",
             "AMT_ANNUITY" / nullif(1 + "AMT_INCOME_TOTAL", 0) as "NEW_ANNUITY_TO_INCOME_RATIO",
             "EXT_SOURCE_1" * "EXT_SOURCE_2" * "EXT_SOURCE_3" as "SOURCES_PRODUCT",
             (select round(case when var_pop(x) = 0 then 0 else kurtosis(x) end, 6) from (select unnest([{SQL_FLAGS}]) as x)) as "DOC_IND_KURT",
             cast({" + ".join(f'"{c}"' for c in CONTACTS)} as double) as "LIVE_IND_SUM",
             (select avg(x) from (select unnest([{SQL_SCORES}]) as x)) as m,
             (select stddev_samp(x) from (select unnest([{SQL_SCORES}]) as x)) as s
      from a join org using ("ORGANIZATION_TYPE"))
    select * exclude (m, s), round(m, 8) as "EXT_SOURCES_MEAN", round(coalesce(s, (select avg(s) from made)), 8) as "EXT_SOURCES_STD" from made""",
)
def new_relative_feature(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_new_relative_feature(table(spark, sf, APPLICATION))
    return out.withColumns(
        {
            "DOC_IND_KURT": F.round("DOC_IND_KURT", 6),
            "LIVE_IND_SUM": col("LIVE_IND_SUM").cast("double"),
            "EXT_SOURCES_MEAN": F.round("EXT_SOURCES_MEAN", 8),
            "EXT_SOURCES_STD": F.round("EXT_SOURCES_STD", 8),
        }
    )


BUREAU_WHOLE = ["CNT_CREDIT_PROLONG", "MONTHS_BALANCE_SIZE"]


@query(
    "gen_bur_month_balance",
    f"""with m as (select "SK_ID_BUREAU", min("MONTHS_BALANCE") as "MONTHS_BALANCE_MIN", max("MONTHS_BALANCE") as "MONTHS_BALANCE_MAX",
                 count(*) as "MONTHS_BALANCE_SIZE" from {sql_table(BALANCE)} group by 1)
    select "SK_ID_CURR", {sql_spec(specs.BUREAU_SPEC, suffixed, BUREAU_WHOLE)}
    from {sql_table(BUREAU)} left join m using ("SK_ID_BUREAU") group by 1""",
)
def bur_month_balance(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_bur_month_balance(table(spark, sf, BUREAU), table(spark, sf, BALANCE))
    return rounded(out, long_columns(out))


@query(
    "gen_avg_credit_card_bal",
    f"""select "SK_ID_CURR", {sql_spec({c: ["mean"] for c in numbers(CARDS)}, styled)} from {sql_table(CARDS)} group by 1""",
)
def avg_credit_card_bal(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_avg_credit_card_bal(table(spark, sf, CARDS))
    return rounded(out, long_columns(out))


@query(
    "gen_agg_credit_card_bal",
    f"""select "SK_ID_CURR", {sql_spec({c: ["min", "max", "sum", "var"] for c in numbers(CARDS)}, suffixed, ["MONTHS_BALANCE", "SK_DPD"])},
        count(*) as "CC_COUNT" from {sql_table(CARDS)} group by 1""",
)
def agg_credit_card_bal(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_agg_credit_card_bal(table(spark, sf, CARDS))
    return rounded(out, long_columns(out))


@query(
    "gen_credit_card_bal",
    f"""with c as (select * replace (coalesce("NAME_CONTRACT_STATUS", 'nan') as "NAME_CONTRACT_STATUS") from {sql_table(CARDS)}),
    codes as (select s, row_number() over (order by s) - 1 as code from (select distinct "NAME_CONTRACT_STATUS" as s from c))
    select "SK_ID_CURR", {sql_spec({x: ["mean"] for x in numbers(CARDS)}, styled)},
           cast(count(distinct s) as double) as "MEAN_OF_NUNIQUE_STATUS", cast(max(code) as double) as "MEAN_OF_MAX_NUNIQUE_STATUS"
    from c join codes on s = "NAME_CONTRACT_STATUS" group by 1""",
)
def credit_card_bal(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_credit_card_bal(table(spark, sf, CARDS))
    return rounded(out, long_columns(out))


SQL_ASKED = f"""p as (
  select *, "AMT_APPLICATION" / nullif("AMT_CREDIT", 0) as "APP_CREDIT_PERC" from {sql_table(PREVIOUS)})"""


@query("gen_agg_prev", f"""with {SQL_ASKED} select "SK_ID_CURR", {sql_spec(specs.PREVIOUS_SPEC, suffixed)} from p group by 1""")
def agg_prev(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_agg_prev(table(spark, sf, PREVIOUS))
    return rounded(out, long_columns(out))


SQL_SHARES = ", ".join(
    f"""round(avg(cast(coalesce("{c}" = '{v}', false) as int)), 4) as "MEAN_OF_{c}_{v}\""""
    for c, values in {
        "NAME_CONTRACT_STATUS": ["Approved", "Canceled", "Refused"],
        "NAME_CONTRACT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"],
    }.items()
    for v in values
)


@query(
    "gen_avg_prev",
    f"""select "SK_ID_CURR", {sql_spec({c: ["mean"] for c in numbers(PREVIOUS)}, styled)}, {SQL_SHARES},
        count("SK_ID_PREV") as "COUNT_OF_SK_ID_PREV" from {sql_table(PREVIOUS)} group by 1""",
)
def avg_prev(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_avg_prev(table(spark, sf, PREVIOUS))
    return rounded(out, long_columns(out))


SQL_PAID = f"""i as (
  select *, "AMT_PAYMENT" / nullif("AMT_INSTALMENT", 0) as "PAYMENT_PERC", "AMT_INSTALMENT" - "AMT_PAYMENT" as "PAYMENT_DIFF",
         coalesce(greatest("DAYS_ENTRY_PAYMENT" - "DAYS_INSTALMENT", 0), 0) as "DPD",
         coalesce(greatest("DAYS_INSTALMENT" - "DAYS_ENTRY_PAYMENT", 0), 0) as "DBD"
  from {sql_table(INSTALLMENTS)})"""


@query(
    "gen_agg_installments",
    f"""with {SQL_PAID}
    select "SK_ID_CURR", {sql_spec(specs.INSTALLMENTS_SPEC, suffixed)} from i group by 1""",
)
def agg_installments(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_agg_installments(table(spark, sf, INSTALLMENTS))
    return rounded(out, long_columns(out))


@query(
    "gen_avg_payments",
    f"""select "SK_ID_CURR", {sql_spec({c: ["mean", "max", "min"] for c in numbers(INSTALLMENTS)}, styled)} from {sql_table(INSTALLMENTS)} group by 1""",
)
def avg_payments(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_avg_payments(table(spark, sf, INSTALLMENTS))
    return rounded(out, long_columns(out))


@query(
    "gen_prev_installment_feature",
    f"""with i as (select * from {sql_table(INSTALLMENTS)}),
    gaps as (
      select "SK_ID_PREV", "NUM_INSTALMENT_NUMBER" - lag("NUM_INSTALMENT_NUMBER") over (partition by "SK_ID_PREV" order by "NUM_INSTALMENT_NUMBER") as g from i),
    orders_ as (select "SK_ID_PREV", stddev_samp(coalesce(g, (select avg(g) from gaps))) as seq from gaps group by 1),
    means as (
      select "SK_ID_PREV", avg("DAYS_INSTALMENT" - "DAYS_ENTRY_PAYMENT") as late, avg("AMT_INSTALMENT" - "AMT_PAYMENT") as short from i group by 1),
    filled as (
      select "SK_ID_PREV", coalesce(late, (select avg(late) from means)) as late, coalesce(short, (select avg(short) from means)) as short from means),
    per as (
      select "SK_ID_CURR", avg(seq) as seq, avg(late) as late, avg(short) as short
      from i join filled using ("SK_ID_PREV") join orders_ using ("SK_ID_PREV") group by 1)
    select "SK_ID_CURR", round(coalesce(seq, (select avg(seq) from per)), 4) as "STD_OF_INSTALLMENT_SEQ",
           round(coalesce(late, (select avg(late) from per)), 4) as "MEAN_OF_LATE_INSTALLMENT",
           round(coalesce(short, (select avg(short) from per)), 4) as "MEAN_OF_INSUFFICIENT_PAYMENT"
    from per""",
)
def prev_installment_feature(spark: SparkSession, sf: str) -> DataFrame:
    out = library.gen_prev_installment_feature(table(spark, sf, INSTALLMENTS))
    return rounded(out, [c for c in out.columns if c != "SK_ID_CURR"])


# --- the builders of the wide pipeline ---------------------------------------------------

POS: Source = (
    "lineitem",
    {
        "SK_ID_CURR": "l_suppkey",
        "SK_ID_PREV": "l_orderkey",
        "MONTHS_BALANCE": "-l_linenumber",
        "CNT_INSTALMENT": "case when l_partkey % 8 <> 0 then cast(l_partkey % 36 as double) end",
        "SK_DPD": "l_partkey % 6",
        "SK_DPD_DEF": "l_partkey % 4",
        "NAME_CONTRACT_STATUS": "case l_returnflag when 'A' then null when 'N' then 'Active' else 'Completed' end",
    },
)
STATUSES = {POS[0]: ["Active", "Completed"], "orders": ["Approved", "Canceled", "Refused"]}
TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def sql_shares(prefix: str, values: Mapping[str, Sequence[str]], funcs: Sequence[str] = ("mean",)) -> str:
    """The statistics of the 0/1 indicators of every value and of a missing one."""
    out = []
    for c, known in values.items():
        for v in [*known, "nan"]:
            x = f"""cast("{c}" is null as int)""" if v == "nan" else f"""cast(coalesce("{c}" = '{v}', false) as int)"""
            for f in funcs:
                made = {"mean": f"round(avg({x}), 4)", "var": f"round(var_samp({x}), 4)", "sum": f"cast(sum({x}) as bigint)"}.get(f, f"{f}({x})")
                out.append(f'{made} as "{prefix}{c}_{v}_{f.upper()}"')
    return ", ".join(out)


def prefixed(prefix: str) -> Callable[[str, str], str]:
    return lambda c, f: f"{prefix}{c}_{f.upper()}"


@query(
    "wide_pos_cash",
    f"""select "SK_ID_CURR", {sql_spec(specs.POS_CASH_SPEC, prefixed("POS_"))}, {sql_shares("POS_", {"NAME_CONTRACT_STATUS": STATUSES["lineitem"]})},
        count(*) as "POS_COUNT" from {sql_table(POS)} group by 1""",
)
def wide_pos_cash(spark: SparkSession, sf: str) -> DataFrame:
    out = selected.pos_cash(table(spark, sf, POS))
    return rounded(out, long_columns(out))


def wide_installments_sql(prefix: str) -> str:
    return f"""with {SQL_PAID} select "SK_ID_CURR", {sql_spec(specs.SELECTED_INSTALLMENTS_SPEC, prefixed(prefix))},
        count(*) as "{prefix}COUNT" from i group by 1"""


@query("wide_installments", wide_installments_sql("INSTAL_"))
def wide_installments(spark: SparkSession, sf: str) -> DataFrame:
    out = selected.installments_payments(table(spark, sf, INSTALLMENTS))
    return rounded(out, long_columns(out))


@query("simple_installments", wide_installments_sql("INS_"))
def simple_installments(spark: SparkSession, sf: str) -> DataFrame:
    out = selected.installments_payments(table(spark, sf, INSTALLMENTS), selected.SIMPLE)
    return rounded(out, long_columns(out))


FIVE = ["min", "max", "mean", "sum", "var"]


@query(
    "wide_credit_card",
    f"""select "SK_ID_CURR", {sql_spec({c: FIVE for c in numbers(CARDS)}, prefixed("CC_"), ["MONTHS_BALANCE", "SK_DPD"])},
        {sql_shares("CC_", {"NAME_CONTRACT_STATUS": STATUSES["lineitem"]}, FIVE)}, count(*) as "CC_COUNT" from {sql_table(CARDS)} group by 1""",
)
def wide_credit_card(spark: SparkSession, sf: str) -> DataFrame:
    out = selected.credit_card_balance(table(spark, sf, CARDS))
    return rounded(out, long_columns(out))


def sql_subset(spec: Mapping[str, Sequence[str]], prefix: str, where: str) -> str:
    """The spec over the rows that satisfy the condition; a subset without rows has no sums either."""
    out = []
    for c, funcs in spec.items():
        x = f'case when {where} then "{c}" end'
        rows = f"count(case when {where} then 1 end)"
        for f in funcs:
            made = {"min": f"min({x})", "max": f"max({x})", "mean": f"round(avg({x}), 4)", "var": f"round(var_samp({x}), 4)",
                    "sum": f"case when {rows} > 0 then cast(coalesce(sum({x}), 0) as double) end"}[f]
            out.append(f'{made} as "{prefix}{c}_{f.upper()}"')
    return ", ".join(out)


SQL_CLEANED = f"""p as (
  select * replace ({", ".join(f'nullif("{c}", 365243) as "{c}"' for c in specs.DAY_SENTINEL_COLUMNS)}),
         "AMT_APPLICATION" / nullif("AMT_CREDIT", 0) as "APP_CREDIT_PERC"
  from {sql_table(PREVIOUS)})"""


@query(
    "simple_previous",
    f"""with {SQL_CLEANED} select "SK_ID_CURR", {sql_spec(specs.SELECTED_PREVIOUS_SPEC, prefixed("PREV_"))},
        {sql_shares("PREV_", {"NAME_CONTRACT_STATUS": STATUSES["orders"], "NAME_CONTRACT_TYPE": TYPES})},
        {sql_subset(specs.SELECTED_PREVIOUS_SPEC, "APR_", chr(34) + "NAME_CONTRACT_STATUS" + chr(34) + " = 'Approved'")},
        {sql_subset(specs.SELECTED_PREVIOUS_SPEC, "REF_", chr(34) + "NAME_CONTRACT_STATUS" + chr(34) + " = 'Refused'")}
    from p group by 1""",
)
def simple_previous(spark: SparkSession, sf: str) -> DataFrame:
    out = selected.previous_applications(table(spark, sf, PREVIOUS), selected.SIMPLE)
    return rounded(out, long_columns(out))
