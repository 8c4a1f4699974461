"""Encoders, scaling and formula features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.columns import sanitise_columns
from sparkfeat.operators.categories import MISSING, Vocabulary, first_seen_codes, label_codes, one_hot, with_codes
from sparkfeat.operators.encode import FoldEncoding, frequency_encode, noise, standardise, target_encode
from sparkfeat.operators.evaluate import kfold
from sparkfeat.operators.formula import equal_rows, formula_chunks, formula_features
from sparkfeat.operators.lookup import unseen_share
from sparkfeat.queries.registry import (
    SQL_GAPPY,
    SQL_PEOPLE,
    SQL_PURCHASES,
    gappy_lines,
    people,
    purchases,
    query,
    read,
)

K = 5


def sql_hash(key: str, seed: int) -> str:
    return f"((({key} % 1000003) * {2654435761 + seed * 104729} + {seed}) % 1000003)"


@query(
    "one_hot",
    """select c_custkey, {segments}, cast(s is null as int) as c_mktsegment_nan
    from (select c_custkey, nullif(c_mktsegment, 'MACHINERY') as s from customer) t""".replace(
        "{segments}",
        ", ".join(
            f"case when s = '{v}' then 1 else 0 end as c_mktsegment_{v}"
            for v in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
        ),
    ),
)
def one_hots(spark: SparkSession, sf: str) -> DataFrame:
    df = read(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("c_mktsegment")
    )
    return sanitise_columns(one_hot(df, Vocabulary.fit(df), missing=True))


@query(
    "label_encode",
    f"""with {SQL_PURCHASES},
    p as (select o_orderkey, coalesce(priority, 'nan') as priority from purchases),
    codes as (select priority, cast(row_number() over (order by priority) - 1 as int) as code
              from (select distinct priority from p) d)
    select o_orderkey, code from p join codes using (priority)""",
)
def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    df = purchases(spark, sf)
    coded = with_codes(df, label_codes(df, ["priority"]), ["priority"], missing=MISSING)
    return coded.select("o_orderkey", F.col("priority").alias("code"))


@query(
    "label_encode_many",
    """with p as (select l_orderkey, l_linenumber, cast(l_partkey as varchar) as part from lineitem),
    codes as (select part, cast(row_number() over (order by part) - 1 as int) as code from (select distinct part from p) d)
    select l_orderkey, l_linenumber, code from p join codes using (part)""",
)
def label_encode_many(spark: SparkSession, sf: str) -> DataFrame:
    """A text column with as many values as there are parts."""
    df = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    coded = with_codes(df, label_codes(df, ["part"]), ["part"], missing=MISSING)
    return coded.select("l_orderkey", "l_linenumber", F.col("part").alias("code"))


@query(
    "factorize_many",
    """with p as (select l_orderkey, l_linenumber, cast(l_partkey as varchar) as part from lineitem),
    codes as (select part, cast(row_number() over (order by min(l_orderkey), part) - 1 as int) as code
              from p where l_orderkey % 3 <> 0 group by part)
    select l_orderkey, l_linenumber, coalesce(code, -1) as code from p left join codes using (part)""",
)
def factorize_many(spark: SparkSession, sf: str) -> DataFrame:
    """Codes learned from two thirds of the orders; parts that are not among them are -1."""
    df = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    codes = first_seen_codes(df.filter("l_orderkey % 3 <> 0"), ["part"], "l_orderkey")
    coded = with_codes(df, codes, ["part"], unknown=-1)
    return coded.select("l_orderkey", "l_linenumber", F.col("part").alias("code"))


@query(
    "factorize",
    f"""with {SQL_PEOPLE},
    p as (select c_custkey, c_custkey % 5 = 0 as test,
                 case when c_mktsegment = 'BUILDING' and c_custkey % 5 <> 0 then 'FURNITURE'
                      when c_mktsegment = 'MACHINERY' then null else c_mktsegment end as seg from people),
    codes as (select seg, cast(row_number() over (order by min(c_custkey)) - 1 as int) as code
              from p where not test and seg is not null group by seg)
    select c_custkey, coalesce(code, -1) as code from p left join codes using (seg)""",
)
def factorized(spark: SparkSession, sf: str) -> DataFrame:
    test = F.col("c_custkey") % 5 == 0
    seg = (
        F.when((F.col("c_mktsegment") == "BUILDING") & ~test, "FURNITURE")
        .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
        .alias("seg")
    )
    df = people(spark, sf).select("c_custkey", test.alias("test"), seg)
    codes = first_seen_codes(df.filter(~F.col("test")), ["seg"], "c_custkey")
    return with_codes(df, codes, ["seg"], unknown=-1).select("c_custkey", F.col("seg").alias("code"))


@query(
    "unseen_share",
    """with a as (select distinct l_partkey from lineitem where l_shipdate < timestamp '1998-06-01'),
    b as (select l_partkey from lineitem where l_shipdate >= timestamp '1998-06-01')
    select cast(count(case when l_partkey not in (select l_partkey from a) then 1 end) as double) / count(*) as share,
           count(*) as n_rows
    from b""",
)
def unseen(spark: SparkSession, sf: str) -> DataFrame:
    df = read(spark, sf, "lineitem").select("l_partkey", "l_shipdate")
    cut = F.lit("1998-06-01").cast("timestamp_ntz")
    train, test = df.filter(F.col("l_shipdate") < cut), df.filter(F.col("l_shipdate") >= cut)
    share = unseen_share(train, test, "l_partkey")
    return test.agg(F.count(F.lit(1)).alias("n_rows")).select(share.alias("share"), "n_rows")


@query(
    "target_encode",
    f"""with {SQL_PEOPLE},
    tr as (select * from people where label is not null),
    pr as (select avg(label) as prior from tr),
    st as (select c_nationkey, avg(label) as m, count(label) as n from tr group by c_nationkey),
    seg as (select c_mktsegment, avg(label) as m, count(label) as n from tr where c_mktsegment <> 'BUILDING'
            group by c_mktsegment)
    select c_custkey,
           round(coalesce(prior * (1 - 1 / (1 + exp(-(st.n - 45) / 10.0)))
                          + st.m * (1 / (1 + exp(-(st.n - 45) / 10.0))), prior), 9) as te_smooth,
           case when st.n > 45 then st.m else prior end as te_step,
           round(coalesce(prior * (1 - 1 / (1 + exp(-(seg.n - 200) / 50.0)))
                          + seg.m * (1 / (1 + exp(-(seg.n - 200) / 50.0))), prior), 9) as te_segment
    from people cross join pr left join st using (c_nationkey) left join seg using (c_mktsegment)""",
)
def target_encodings(spark: SparkSession, sf: str) -> DataFrame:
    df = people(spark, sf).select("c_custkey", "c_nationkey", "c_mktsegment", "label")
    train = df.filter("label is not null")
    # a null category is not a category: BUILDING is hidden from the fit and unknown when applied
    hidden = train.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    out = target_encode(train, df, "c_nationkey", "label", "te_smooth", 45, 10.0)
    out = target_encode(train, out, "c_nationkey", "label", "te_step", 45, 0.0)
    out = target_encode(hidden, out, "c_mktsegment", "label", "te_segment", 200, 50.0)
    return out.select(
        "c_custkey", F.round("te_smooth", 9).alias("te_smooth"), "te_step", F.round("te_segment", 9).alias("te_segment")
    )


SQL_FOLDED = (
    SQL_PEOPLE
    + f""", tr as (select c_custkey, c_nationkey, label, cast({sql_hash("c_custkey", 42)} % {K} as int) as fold
            from people where label is not null),
    pr as (select f.fold, avg(t.label) as prior from (select distinct fold from tr) f
           join tr t on t.fold <> f.fold group by f.fold),
    st as (select f.fold, t.c_nationkey, sum(t.label) as y, count(t.label) as n
           from (select distinct fold from tr) f join tr t on t.fold <> f.fold group by f.fold, t.c_nationkey)"""
)


@query(
    "oof_target_encode",
    f"""with {SQL_FOLDED}
    select c_custkey, fold, case when n > 38 then cast(y as double) / n else prior end as te_c_nationkey
    from tr join pr using (fold) left join st using (fold, c_nationkey)""",
)
def oof_target_encode(spark: SparkSession, sf: str) -> DataFrame:
    train = people(spark, sf).filter("label is not null").withColumn("fold", kfold("c_custkey", K, 42))
    fitted = FoldEncoding.fit(train, ["c_nationkey"], "label", "fold", K, 38, 0.0)
    out = fitted.transform(train, "fold")
    return out.select("c_custkey", "fold", "te_c_nationkey")


@query(
    "test_target_encode",
    f"""with {SQL_FOLDED},
    te as (select c_custkey, pr.fold, case when n > 38 then cast(y as double) / n else prior end as enc
           from people p cross join pr left join st on st.fold = pr.fold and st.c_nationkey = p.c_nationkey
           where p.label is null)
    select c_custkey, round(avg(enc), 10) as te_c_nationkey from te group by c_custkey""",
)
def test_target_encode(spark: SparkSession, sf: str) -> DataFrame:
    df = people(spark, sf)
    train = df.filter("label is not null").withColumn("fold", kfold("c_custkey", K, 42))
    fitted = FoldEncoding.fit(train, ["c_nationkey"], "label", "fold", K, 38, 0.0)
    out = fitted.transform(df.filter("label is null"))
    return out.select("c_custkey", F.round("te_c_nationkey", 10).alias("te_c_nationkey"))


@query(
    "frequency_encode",
    f"""with {SQL_PURCHASES},
    a as (select priority, count(*) as n from purchases where priority is not null group by priority),
    b as (select o_custkey, count(*) as n from purchases group by o_custkey)
    select o_orderkey, cast(a.n as double) / (select count(*) from purchases) as cnt_priority,
           cast(b.n as double) / (select count(*) from purchases) as cnt_o_custkey
    from purchases left join a using (priority) left join b using (o_custkey)""",
)
def frequencies(spark: SparkSession, sf: str) -> DataFrame:
    df = purchases(spark, sf).select("o_orderkey", "o_custkey", "priority")
    return frequency_encode(df, ["priority", "o_custkey"]).select("o_orderkey", "cnt_priority", "cnt_o_custkey")


STANDARD = ["num", "qty", "disc", "tax"]


def sql_standard(digits: int | None) -> str:
    body = ", ".join(
        (f"round({e}, {digits})" if digits else e) + f" as {c}"
        for c in STANDARD
        for e in [f"coalesce(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 0.0)"]
    )
    return f"select l_orderkey, l_partkey, {body}, cast(0 as double) as fixed from gappy"


@query("standardise", f"with {SQL_GAPPY} {sql_standard(6)}")
def standardised(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy_lines(spark, sf).withColumn("fixed", F.lit(3.0))
    out = standardise(df, [*STANDARD, "fixed"])
    return out.select("l_orderkey", "l_partkey", *[F.round(c, 6).alias(c) for c in STANDARD], "fixed")


# Formulas over standardised inputs, in SQL that both engines read: each shows one kind of expression.
FORMULAS = {
    "load": "0.5 * qty + 0.25 * num",
    "net_rate": "disc - tax",
    "rate_by_load": "(disc + tax) / (1.5 + qty * qty)",
    "peak": "greatest(qty, num, disc, tax)",
    "dip": "least(qty, num, disc, tax)",
    "spread": "greatest(qty, disc) - least(qty, disc)",
    "is_heavy": "cast(qty > 0.8 as double)",
    "heavy_rate": "case when qty > 0.8 then disc else tax end",
    "steps": "cast(qty > -0.5 as double) + cast(qty > 0.5 as double) + cast(qty > 1.25 as double)",
    "curve": "qty * qty * qty - 2.25 * qty",
    "damped": "tanh(qty) * tanh(disc)",
    "nested": "tanh(0.75 * num - tanh(0.2 + tax))",
    "gated": "case when disc > tax then case when num > 0.1 then qty else 0.9 end else -0.35 end",
    "clipped": "least(greatest(qty + tax, -0.6), 0.6)",
    "cross": "num * tax - qty * disc",
}

#: Many formulas made by rule: two inputs, one of four shapes, constants that differ.
WIDE_SHAPES = (
    "{a} * {c} + {b}",
    "greatest({a}, {b} - {c})",
    "case when {a} > {c} then {b} else {a} * 0.5 end",
    "tanh({a} + {c}) - {b}",
)


def wide_formulas(n: int = 512) -> dict[str, str]:
    out = {}
    for i in range(n):
        a, b = STANDARD[i % 4], STANDARD[(i // 4 + i % 3) % 4]
        out[f"w{i}"] = WIDE_SHAPES[(i // 16) % 4].format(a=a, b=b, c=round(0.01 + 0.0137 * i, 4))
    return out


@query(
    "formula_features",
    f"""with {SQL_GAPPY}, z as ({sql_standard(None)})
    select l_orderkey, l_partkey, {", ".join(f"round(tanh({e}), 6) as {n}" for n, e in FORMULAS.items())} from z""",
)
def formulas(spark: SparkSession, sf: str) -> DataFrame:
    z = standardise(gappy_lines(spark, sf), STANDARD)
    out = formula_features(z, FORMULAS, ["l_orderkey", "l_partkey"])
    return out.select("l_orderkey", "l_partkey", *[F.round(n, 6).alias(n) for n in FORMULAS])


#: Values above this count; no formula gives exactly this value.
WIDE_CUT = 0.137913


@query(
    "formula_wide",
    f"""with {SQL_GAPPY}, z as ({sql_standard(None)}),
    c as (select {", ".join(f"count(case when tanh({e}) > {WIDE_CUT} then 1 end) as {n}" for n, e in wide_formulas().items())} from z)
    select formula, n_above from (unpivot c on columns(*) into name formula value n_above)""",
)
def formulas_wide(spark: SparkSession, sf: str) -> DataFrame:
    """512 formulas in chunks over a stored frame of different inputs; of each, the rows above a cut."""
    z = equal_rows(standardise(gappy_lines(spark, sf), STANDARD), STANDARD, "n_rows")
    parts = []
    for chunk in formula_chunks(z, wide_formulas(), ["n_rows"]):
        names = [c for c in chunk.columns if c != "n_rows"]
        above = [F.coalesce(F.sum(F.when(F.col(n) > WIDE_CUT, F.col("n_rows"))), F.lit(0)).alias(n) for n in names]
        parts.append(chunk.agg(*above).unpivot([], names, "formula", "n_above"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "noise",
    f"""with {SQL_GAPPY}
    select l_orderkey, qty, qty as qty_0, case when qty is not null then true end as near_1 from gappy""",
)
def noisy(spark: SparkSession, sf: str) -> DataFrame:
    """Noise of level 0 changes nothing; of level 0.01 it stays within ten deviations."""
    df = gappy_lines(spark, sf)
    near = F.abs(noise(F.col("qty"), 0.01, 1) / F.col("qty") - 1) <= 0.1
    return df.select("l_orderkey", "qty", noise(F.col("qty"), 0.0, 1).alias("qty_0"), near.alias("near_1"))
