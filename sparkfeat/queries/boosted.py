"""Boosted trees over order lines, with their first trees in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.learning.boosting import UNIT, Booster, Boosting, fit_boosted, fit_until_best, round_scores
from sparkfeat.operators.evaluate import kfold, roc_auc
from sparkfeat.queries.registry import SQL_LINES, lines, query

FEATURES = ["num", "qty", "disc", "tax"]
LIMIT = 70
SMALL = {
    "n_estimators": 2, "num_leaves": 4, "max_depth": 2, "max_bin": 64, "learning_rate": 0.3,
    "lambda_l1": 0.5, "lambda_l2": 1.0, "min_child_weight": 1.0, "min_data_in_leaf": 20,
}


def labelled_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with missing cells, labelled by whether quantity, discount and tax, with some noise, pass a limit."""
    df = lines(spark, sf)
    return df.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"),
        F.nullif("l_linenumber", F.lit(7)).cast("double").alias("num"),
        F.nullif("qty", F.lit(50.0)).alias("qty"),
        F.nullif("disc", F.lit(0.0)).alias("disc"),
        F.nullif("tax", F.lit(0.0)).alias("tax"),
        (2 * F.col("qty") + 5 * F.col("disc") - 4 * F.col("tax") + F.col("l_partkey") % 40 > LIMIT).cast("int").alias("label"),
    )


SQL_LABEL = f"2 * qty + 5 * disc - 4 * tax + l_partkey % 40 > {LIMIT}"
SQL_CELLS = f"""{SQL_LINES},
  cells as (
    select cast(nullif(l_linenumber, 7) as double) as num, nullif(qty, 50.0) as qty, nullif(disc, 0.0) as disc, nullif(tax, 0.0) as tax,
           cast({SQL_LABEL} as int) as y
    from lines),
  coded as (
    select {", ".join(f"case when {f} is null then -1 else dense_rank() over (order by {f} nulls last) - 1 end as c{i}" for i, f in enumerate(FEATURES))}, y
    from cells),
  rows0 as (select c0, c1, c2, c3, y, count(*) as n from coded group by all),
  start as (select ln(sum(y * n) / (sum(n) - sum(y * n))) as base from rows0),
  m0 as (select c0, c1, c2, c3, y, n, base as m from rows0, start)"""


def _sql_score(g: str, h: str, s: Boosting) -> str:
    return f"coalesce(power(greatest(abs({g}) - {s.l1}, 0), 2) / nullif({h} + {s.l2}, 0), 0)"


def _sql_weight(g: str, h: str, s: Boosting) -> str:
    return f"-{s.rate} * sign({g}) * greatest(abs({g}) - {s.l1}, 0) / ({h} + {s.l2})"


def _sql_best(rows: str, s: Boosting) -> str:
    """The best split of each node of ``rows (node, c0.., g, h, n)``, whose sums are whole multiples of 1 / UNIT."""
    long = " union all ".join(f"select node, {i} as f, c{i} as code, g, h, n from {rows}" for i in range(len(FEATURES)))
    sides = []
    for missing_left in (0, 1):
        left = {x: f"(up_{x} + {x}_gone)" if missing_left else f"up_{x}" for x in "ghn"}
        sides.append(f"select node, f, code, {missing_left} as missing_left, {', '.join(f'{left[x]} as l{x}' for x in 'ghn')}, g_all, h_all, n_all, n_gone from cum where code >= 0")
    sums = lambda x: (
        f"sum({x}) over w as {x}_all, coalesce(sum(case when code < 0 then {x} end) over w, 0) as {x}_gone, "
        f"coalesce(sum(case when code >= 0 then {x} end) over (w order by code), 0) as up_{x}"
    )
    return f"""
      select * from (
        select *, {_sql_score('lg', 'lh', s)} + {_sql_score('(g_all - lg)', '(h_all - lh)', s)} - {_sql_score('g_all', 'h_all', s)} as gain
        from (
          with cells as (select node, f, code, sum(g) / {UNIT}.0 as g, sum(h) / {UNIT}.0 as h, sum(n) as n from ({long}) group by all),
               cum as (select node, f, code, {", ".join(map(sums, "ghn"))} from cells window w as (partition by node, f))
          {" union all ".join(sides)}) x
        where least(ln, n_all - ln) >= {s.least_rows} and least(lh, h_all - lh) >= {s.least_hessian} and (missing_left = 0 or n_gone > 0)) y
      where gain > {max(s.least_gain, 1e-12)}
      qualify row_number() over (partition by node order by gain desc, f, code, missing_left) = 1"""


def _sql_tree(t: int, s: Boosting) -> str:
    """CTEs of tree ``t``: gradients, the root's split, its children's splits, and the margins after it."""
    p = "(1 / (1 + exp(-m)))"
    turn = lambda b: f"case when (case {' '.join(f'when {b}.f = {i} then c{i}' for i in range(len(FEATURES)))} end) between (case when {b}.missing_left = 1 then -1 else 0 end) and {b}.code then 'L' else 'R' end"
    total = "select node, sum(g) / {u}.0 as g, sum(h) / {u}.0 as h, sum(n) as n from {r} group by node".replace("{u}", str(UNIT))
    return f"""
  g{t} as (
    select *, '' as node, cast(round(({p} - y) * {UNIT}) as bigint) * n as g, cast(round({p} * (1 - {p}) * {UNIT}) as bigint) * n as h from m{t}),
  b{t}_0 as ({_sql_best(f"g{t}", s)}),
  d{t}_1 as (select r.* exclude (node), {turn("b")} as node from g{t} r join b{t}_0 b on r.node = b.node),
  b{t}_1 as ({_sql_best(f"d{t}_1", s)}),
  d{t}_2 as (select r.* exclude (node), r.node || case when b.node is null then '' else {turn("b")} end as node from d{t}_1 r left join b{t}_1 b on r.node = b.node),
  n{t} as (
    {total.format(r=f"g{t}")} union {total.format(r=f"d{t}_1")} union {total.format(r=f"d{t}_2")}),
  v{t} as (select node, n, {_sql_weight("g", "h", s)} as value from n{t}),
  s{t} as (select * from b{t}_0 union all select * from b{t}_1),
  m{t + 1} as (select c0, c1, c2, c3, y, d.n, m + value as m from d{t}_2 d join v{t} v using (node))"""


def _sql_nodes(s: Boosting) -> str:
    name = "case f " + " ".join(f"when {i} then '{f}'" for i, f in enumerate(FEATURES)) + " end"
    parts = [
        f"""select {t} as tree, v.node as path, {name} as feature, cast(code as int) as code, cast(missing_left as boolean) as missing_left,
        round(gain, 5) as gain, round(value, 8) as value, cast(v.n as bigint) as n_rows from v{t} v left join s{t} s on v.node = s.node"""
        for t in range(s.rounds)
    ]
    return f"with {SQL_CELLS}, {', '.join(_sql_tree(t, s) for t in range(s.rounds))} {' union all '.join(parts)}"


@query("boosted_trees", _sql_nodes(Boosting.of(SMALL)))
def boosted_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Two trees of four leaves: every node's split, gain, value and rows."""
    nodes = fit_boosted(labelled_lines(spark, sf), "line", "label", FEATURES, SMALL).nodes()
    return nodes.select(
        "tree", "path", "feature", "code", "missing_left", F.round("gain", 5).alias("gain"), F.round("value", 8).alias("value"), "n_rows"
    )


#: Held-out AUC that the trees must pass; a constant model has 0.5.
LEAST_AUC = 0.8
MANY = {"n_estimators": 1000, "num_leaves": 8, "max_bin": 64, "learning_rate": 1.0, "min_data_in_leaf": 20, "lambda_l2": 1.0}


@query(
    "boosted_rounds",
    f"""with {SQL_LINES} select count(*) as n_rows, cast(sum(cast({SQL_LABEL} as int)) as bigint) as n_positive, true as stopped_early,
    true as best_is_highest, true as auc_ok from lines""",
)
def boosted_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Trees grown until the held-out AUC stops rising: what must hold of the rounds and scores found.

    A thousand rounds are asked for. The best round has the highest AUC of all tried, and the
    predictions of rows by the models that have not seen them pass a bound of the AUC.
    """
    df = labelled_lines(spark, sf).withColumn("fold", kfold("line", 2, 3))
    fitted = fit_until_best(df, "line", "label", FEATURES, MANY, 2, "fold", patience=2)
    own = fitted.out_of_fold()
    facts = own.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").cast("bigint").alias("n_positive"))
    best = len(fitted.forests[0].trees)
    auc = roc_auc(own, "label", "prediction").first()["auc"]
    return facts.withColumns(
        {
            "stopped_early": F.lit(len(fitted.scores) < MANY["n_estimators"]),
            "best_is_highest": F.lit(fitted.scores[best - 1] == max(fitted.scores)),
            "auc_ok": F.lit(auc > LEAST_AUC),
        }
    )


@query("boosted_auc_by_round")
def boosted_auc_by_round(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out AUC after each of the first trees."""
    df = labelled_lines(spark, sf).withColumn("fold", kfold("line", 2, 3))
    booster = Booster(df, "line", "label", FEATURES, Boosting.of({**MANY, "n_estimators": 4}), 2, "fold")
    booster.grow(4)
    rows = [(i + 1, x) for i, x in enumerate(round_scores(booster, 4))]
    return spark.createDataFrame(rows, "round int, auc double")
