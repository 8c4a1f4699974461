"""Folds, AUC, parameter tables and model jobs."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfeat.learning.batched import fit_logistic_many, score_logistic_many
from sparkfeat.learning.estimators import gbt, logistic
from sparkfeat.learning.grids import Normal, Uniform, expand_grid, random_grid
from sparkfeat.learning.guided import guided_search
from sparkfeat.learning.search import Search, Stage, staged_search, with_repeated_folds
from sparkfeat.learning.stacking import fit_blend, joined_predictions
from sparkfeat.learning.training import FeatureVectors, FoldModels, boosting_rounds, feature_names, fit_all, refit_score
from sparkfeat.operators.categories import Vocabulary
from sparkfeat.operators.evaluate import (
    best_row,
    kfold,
    roc_auc,
    score_table,
    stratified_folds,
    stratified_split,
)
from sparkfeat.operators.impute import global_values
from sparkfeat.operators.ranks import HASH_SPACE
from sparkfeat.queries.encodings import sql_hash
from sparkfeat.queries.matrix import feature_matrix
from sparkfeat.queries.registry import SQL_PEOPLE, SQL_PURCHASES, people, query, read
from sparkfeat.sources.checkpoints import stored
from sparkfeat.sources.tables import split_labelled

K = 5


@query(
    "kfold_assign",
    f"select o_orderkey, cast({sql_hash('o_orderkey', 7)} % {K} as int) as fold from orders",
)
def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select("o_orderkey", kfold("o_orderkey", K, 7).alias("fold"))


SQL_RANK = f"""row_number() over (partition by truth order by {sql_hash("c_custkey", 1001)}, c_custkey) - 1"""


@query(
    "stratified_folds",
    f"with {SQL_PEOPLE} select c_custkey, truth, cast(({SQL_RANK}) % {K} as int) as fold from people",
)
def stratified(spark: SparkSession, sf: str) -> DataFrame:
    df = people(spark, sf).select("c_custkey", "truth")
    return stratified_folds(df, "c_custkey", "truth", K, 1001)


@query(
    "stratified_split",
    f"""with {SQL_PEOPLE}
    select c_custkey, truth,
           cast(({SQL_RANK}) < ceil(count(*) over (partition by truth) * 0.33) as int) as is_test
    from people""",
)
def split(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_split(people(spark, sf).select("c_custkey", "truth"), "c_custkey", "truth", 0.33, 1001)


def sql_auc(source: str, by: str, label: str, score: str, out: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    group = f"group by {by}" if by else ""
    return f"""select {keys}sum(pos * (nb + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0) as {out} from (
        select *, coalesce(sum(neg) over ({part} order by s rows between unbounded preceding and 1 preceding), 0) as nb
        from (select {keys}{score} as s, cast(sum({label}) as double) as pos, cast(sum(1 - {label}) as double) as neg
              from {source} group by {keys}{score}) x) y {group}"""


@query(
    "auc_exact",
    f"""with {SQL_PEOPLE},
    sc as (select truth as label, c_nationkey,
                  round(balance / 10000) + ({sql_hash("c_custkey", 3)} % 97) as score from people),
    a as ({sql_auc("sc", "", "label", "score", "auc")}),
    b as ({sql_auc("sc", "c_nationkey", "label", "score", "auc")})
    select -1 as c_nationkey, auc from a union all select c_nationkey, auc from b""",
)
def auc_exact(spark: SparkSession, sf: str) -> DataFrame:
    noise = kfold("c_custkey", 97, 3)
    sc = people(spark, sf).select(
        "c_nationkey", F.col("truth").alias("label"), (F.round(F.col("balance") / 10000) + noise).alias("score")
    )
    whole = roc_auc(sc, "label", "score").select(F.lit(-1).alias("c_nationkey"), "auc")
    return whole.unionByName(roc_auc(sc, "label", "score", ["c_nationkey"]))


@query(
    "expand_grid",
    """with grid as (select s.o_orderstatus, p.o_orderpriority, m.c_mktsegment
                     from (select distinct o_orderstatus from orders) s
                     cross join (select distinct o_orderpriority from orders) p
                     cross join (select distinct c_mktsegment from customer) m),
    n as (select o_orderstatus, o_orderpriority, c_mktsegment, count(*) as n
          from orders join customer on o_custkey = c_custkey group by all)
    select grid.*, coalesce(n, 0) as n_orders
    from grid left join n using (o_orderstatus, o_orderpriority, c_mktsegment)""",
)
def grid(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    customers = read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    values = {
        **Vocabulary.fit(orders, ["o_orderstatus", "o_orderpriority"]).values,
        **Vocabulary.fit(customers, ["c_mktsegment"]).values,
    }
    names = list(values)
    counts = orders.join(customers, "o_custkey").groupBy(*names).agg(F.count(F.lit(1)).alias("n_orders"))
    return expand_grid(spark, values).join(counts, names, "left").fillna(0, ["n_orders"])


CANDIDATES, REPEATS = 4, 2

SQL_PREDICTIONS = f"""preds as (
    select candidate, repeat, o_orderkey, label, fold,
           cast((({sql_hash("o_orderkey", 11)} * 31 * (candidate + 1) + repeat * 104729) % 1009)
                + label * 100 * candidate as double) as pred
    from (select c.candidate, r.repeat, o_orderkey, cast(o_orderstatus = 'F' as int) as label,
                 cast((({sql_hash("o_orderkey", 5)} + r.repeat * 7919) % {K}) as int) as fold
          from orders, (select unnest(range({CANDIDATES})) as candidate) c, (select unnest(range({REPEATS})) as repeat) r) o)"""

SQL_SCORES = f"""{SQL_PREDICTIONS},
    fold_auc as ({sql_auc("preds", "candidate, repeat, fold", "label", "pred", "auc")}),
    avg_pred as (select candidate, o_orderkey, max(label) as label, avg(pred) as pred from preds group by 1, 2),
    whole as ({sql_auc("avg_pred", "candidate", "label", "pred", "score")}),
    spread as (select candidate, stddev_pop(auc) as sd from fold_auc group by candidate)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validation predictions of four candidates, derived from the orders."""
    orders = read(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.explode(F.sequence(F.lit(0), F.lit(CANDIDATES - 1))).alias("candidate"),
    )
    both = orders.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    fold = (kfold("o_orderkey", HASH_SPACE, 5) + F.col("repeat") * 7919) % K
    spread = kfold("o_orderkey", HASH_SPACE, 11).cast("bigint") * 31 * (F.col("candidate") + 1)
    pred = (spread + F.col("repeat") * 104729) % 1009 + F.col("label") * 100 * F.col("candidate")
    return both.withColumns({"fold": fold.cast("int"), "pred": pred.cast("double")})


@query(
    "score_params",
    f"""with {SQL_SCORES}
    select cast(candidate as int) as candidate, round(score, 9) as "Score", round(sd, 9) as "Score_Std",
           round(score - 0.1 * sd, 9) as "Score_Weighted"
    from whole join spread using (candidate)""",
)
def score_params(spark: SparkSession, sf: str) -> DataFrame:
    scores = score_table(predictions(spark, sf), "o_orderkey", "label", "candidate", "repeat", "fold", "pred")
    names = ["Score", "Score_Std", "Score_Weighted"]
    return scores.select("candidate", *[F.round(n, 9).alias(n) for n in names])


@query(
    "pick_best_params",
    f"""with {SQL_SCORES}
    select cast(candidate as int) as candidate, round(score - 0.1 * sd, 9) as "Score_Weighted"
    from whole join spread using (candidate) order by 2 desc, 1 limit 1""",
)
def pick_best(spark: SparkSession, sf: str) -> DataFrame:
    return best_row(score_params(spark, sf), "candidate").select("candidate", "Score_Weighted")


SQL_CENTRE = "(select avg(o_totalprice) as m, stddev(o_totalprice) as s, min(o_totalprice) as low from orders)"
DRAWS = 20


@query(
    "random_grid",
    f"""select cast(unnest(range({DRAWS})) as int) as draw, true as known, true as in_bounds, true as covered
    from {SQL_CENTRE}""",
)
def random_params(spark: SparkSession, sf: str) -> DataFrame:
    """Draws from values and distributions of the tables, and what must hold for each of them.

    A draw's priority occurs in the orders, its limit is not negative, and the orders of that
    priority up to the limit are no more than all of that priority.
    """
    orders = read(spark, sf, "orders").select("o_orderpriority", "o_totalprice")
    values = Vocabulary.fit(orders, ["o_orderpriority"]).values["o_orderpriority"]
    centre = orders.agg(F.avg("o_totalprice").alias("m"), F.stddev("o_totalprice").alias("s")).first()
    space = {"o_orderpriority": list(values), "limit": Normal(centre["m"], centre["s"], low=0.0)}
    draws = stored(random_grid(spark, space, DRAWS, 1).withColumn("draw", F.monotonically_increasing_id()))
    order = Window.orderBy("draw")  # DRAWS rows
    draws = draws.withColumn("draw", (F.row_number().over(order) - 1).cast("int"))
    within = F.col("o_totalprice") <= F.col("limit")
    covered = draws.join(orders, "o_orderpriority").groupBy("draw", "limit").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(within).alias("n_within")
    )
    return draws.select("draw", "limit").join(covered.drop("limit"), "draw", "left").select(
        "draw",
        F.col("n").isNotNull().alias("known"),
        (F.col("limit") >= 0).alias("in_bounds"),
        (F.col("n_within") <= F.col("n")).alias("covered"),
    )


def buyers(wide: DataFrame) -> DataFrame:
    """The feature matrix with ``truth`` (whether the orders' sum is above its average) and ``label``, unknown for every fifth customer."""
    total = F.coalesce("BURO_amount_SUM", F.lit(0.0))
    mean = global_values(wide, {"mean": F.avg("BURO_amount_SUM")})["mean"]
    truth = (total > mean).cast("int")
    return wide.withColumns({"truth": truth, "label": F.when(F.col("c_custkey") % 5 != 0, truth)})


SQL_BUYERS = f"""{SQL_PURCHASES},
    totals as (select o_custkey, cast(coalesce(sum(amount), 0) as double) as total from purchases group by o_custkey),
    bought as (
      select c_custkey, cast(coalesce(total, 0) > (select avg(total) from totals) as int) as truth
      from customer left join totals on c_custkey = o_custkey),
    buyers as (select *, case when c_custkey % 5 <> 0 then truth end as label from bought)"""

#: AUC that predictions of unseen rows must pass; a constant model has 0.5.
LEAST_AUC = 0.7


def above_chance(scored: DataFrame, label: str, score: str) -> Column:
    return F.lit(roc_auc(scored, label, score).first()["auc"] > LEAST_AUC)


def training_matrix(spark: SparkSession, sf: str, folds: int, repeats: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Labelled and unlabelled vectors over the whole feature matrix, with fold columns on the labelled rows.

    The label says whether a customer's orders are worth more than those of the average
    customer, which the other features tell in part. Amounts give it away and are left out.
    """
    wide = buyers(feature_matrix(spark, sf))
    names = [c for c in feature_names(wide, ["c_custkey", "label", "truth"]) if "balance" not in c.lower() and "amount" not in c.lower()]
    wide = stored(wide.select("c_custkey", "label", *names))
    train, test = split_labelled(wide, "label")
    vectors = FeatureVectors.fit(train, names)
    folded = with_repeated_folds(vectors.transform(train, ["c_custkey", "label"]), "c_custkey", "label", folds, repeats)
    return stored(folded), vectors.transform(test, ["c_custkey"]), vectors.names


TREES = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "max_bin": 32}


def sql_rank(key: str, label: str, seed: int) -> str:
    return f"row_number() over (partition by {label} order by {sql_hash(key, seed)}, {key}) - 1"


SQL_FOLDS = f"""{SQL_BUYERS},
    folded as (select c_custkey, label, cast(({sql_rank("c_custkey", "label", 0)}) % 2 as int) as fold
               from buyers where label is not null)"""


def unit_scaled(train: DataFrame, df: DataFrame) -> DataFrame:
    """The vectors of ``df`` on the scale of those of ``train``: linear models then need few steps."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(train)
    return scaler.transform(df).drop("features").withColumnRenamed("scaled", "features")


def share(column: str) -> Column:
    """Whether a prediction is a probability."""
    return F.coalesce(F.col(column).between(0, 1), F.lit(False)).alias(f"{column}_ok")


@query(
    "oof_predict",
    f"""with {SQL_FOLDS}
    select c_custkey, label, fold, true as oof_ok, true as mean_ok, true as auc_ok from folded
    union all select c_custkey, null, null, false, true, true from buyers where label is null""",
)
def oof_predict(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of the out-of-fold predictions of train rows, and of bagged ones of train and test rows: their AUC passes a bound."""
    scored = stored(oof_scores(spark, sf))
    return scored.select("c_custkey", "label", "fold", share("oof"), share("mean")).withColumn("auc_ok", above_chance(scored, "label", "oof"))


@query("oof_scores")
def oof_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Out-of-fold predictions of train rows, bagged ones of train and test rows."""
    train, test, names = training_matrix(spark, sf, 2, 1)
    models = FoldModels.fit(train, gbt(TREES), 2, "fold_0", names)
    own = models.out_of_fold(train, ["c_custkey", "label"], "oof").withColumnRenamed("fold_0", "fold")
    bagged = models.mean_prediction(train, ["c_custkey"], "mean")
    scored = own.join(bagged, "c_custkey")
    both = scored.unionByName(models.mean_prediction(test, ["c_custkey"], "mean"), allowMissingColumns=True)
    return both.select("c_custkey", "label", "fold", "oof", "mean")


@query("fold_importance")
def fold_importance(spark: SparkSession, sf: str) -> DataFrame:
    """All features' importances, fold by fold."""
    train, _, names = training_matrix(spark, sf, 2, 1)
    models = FoldModels.fit(train, gbt(TREES), 2, "fold_0", names)
    return models.importance(train)


@query("importance_per_fold", "select unnest(range(1, 3))::int as fold, true as complete, 1.0::double as total from region where r_regionkey = 0")
def importance_per_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature of the matrix has an importance in every fold, and a fold's add up to 1."""
    train, _, names = training_matrix(spark, sf, 2, 1)
    table = FoldModels.fit(train, gbt(TREES), 2, "fold_0", names).importance(train)
    per = table.groupBy("fold").agg(F.countDistinct("feature").alias("n"), F.sum("importance").alias("total"))
    return per.select("fold", (F.col("n") == len(names)).alias("complete"), F.round("total", 6).alias("total"))


@query(
    "refit_score",
    f"""with {SQL_BUYERS}
    select c_custkey, truth, true as pred_gbt_ok, true as pred_logistic_regression_ok, true as auc_ok from buyers where label is null""",
)
def refit(spark: SparkSession, sf: str) -> DataFrame:
    """Test scores of both model families, each fitted on all of train: probabilities of the unlabelled rows."""
    train, test, _ = training_matrix(spark, sf, 2, 1)
    scaled = stored(unit_scaled(train, train))
    linear = logistic({"C": 1.0}, scaled.count())
    jobs = [
        lambda: refit_score(gbt(TREES), train, test, "c_custkey", "gbt"),
        lambda: refit_score(linear, scaled, unit_scaled(train, test), "c_custkey", "logistic_regression"),
    ]
    trees, line = fit_all(spark, jobs, len(jobs))
    truth = buyers(feature_matrix(spark, sf)).select("c_custkey", "truth")
    scored = stored(trees.join(line, "c_custkey").join(truth, "c_custkey"))
    auc_ok = above_chance(scored, "truth", "pred_gbt") & above_chance(scored, "truth", "pred_logistic_regression")
    return scored.select("c_custkey", "truth", share("pred_gbt"), share("pred_logistic_regression")).withColumn("auc_ok", auc_ok)


@query(
    "boosting_rounds",
    f"""with {SQL_FOLDS} select fold as fold_0, count(*) as n_rows, true as stopped from folded group by fold""",
)
def rounds(spark: SparkSession, sf: str) -> DataFrame:
    """The training rows behind the choice of rounds, and whether it lies before the last round allowed."""
    train, _, _ = training_matrix(spark, sf, 2, 1)
    best = boosting_rounds(train, gbt({**TREES, "n_estimators": 200}), 2, "fold_0", patience=3)
    return train.groupBy("fold_0").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("stopped", F.lit(best < 200))


@query(
    "staged_search",
    """select stage, cast(candidate as int) as candidate, varied, true as score_ok, true as frozen_ok
    from (values ('strength', 0, '0.01'), ('strength', 1, '1.0'), ('iterations', 0, '5'), ('iterations', 1, '20')) v(stage, candidate, varied),
         (select count(*) from customer)""",
)
def search(spark: SparkSession, sf: str) -> DataFrame:
    """Two stages of logistic candidates over the whole matrix, one row each.

    Scores pass a bound, and the second stage keeps the strength that was best in the first.
    """
    train, _, _ = training_matrix(spark, sf, 2, 1)
    train = stored(unit_scaled(train, train))
    n = train.count()
    work = Search(train, "c_custkey", lambda p: logistic(p, n), folds=2, repeats=1, parallelism=4)
    stages = [Stage("strength", lambda best: {"C": [0.01, 1.0]}), Stage("iterations", lambda best: {"max_iter": [5, 20]})]
    first, second = staged_search(work, stages, {"C": 1.0, "max_iter": 10})
    out = []
    for result, name, frozen in ((first, "C", "max_iter=10"), (second, "max_iter", f"C={first.scored.best['C']}")):
        out.append(
            result.scored.report().select(
                F.lit(result.name).alias("stage"),
                "candidate",
                F.regexp_extract("params", f"\\b{name}=([^,]+)", 1).alias("varied"),
                F.col("Score").between(LEAST_AUC, 1).alias("score_ok"),
                F.contains("params", F.lit(frozen)).alias("frozen_ok"),
            )
        )
    return out[0].unionByName(out[1])


STRENGTHS = [0.001, 0.01, 0.1, 1.0, 10.0]


@query(
    "logistic_many",
    f"""select cast(unnest(range({len(STRENGTHS)})) as int) as candidate, true as score_ok, true as spread_ok, count(*) as n_rows
    from customer where c_custkey % 5 <> 0""",
)
def logistic_many(spark: SparkSession, sf: str) -> DataFrame:
    """Five penalties, two repeats of two folds, all fitted in the same passes: what holds of their scores."""
    train, _, _ = training_matrix(spark, sf, 2, 2)
    train = stored(unit_scaled(train, train))
    scored = score_logistic_many(train, "c_custkey", [{"C": c} for c in STRENGTHS], 2, 2)
    return scored.table.select(
        "candidate", (F.col("Score") > LEAST_AUC).alias("score_ok"), F.col("Score_Std").between(0, 0.2).alias("spread_ok"),
        F.lit(scored.best_predictions.count()).cast("bigint").alias("n_rows"),
    )


@query("stacked_blend")
def stacked_blend(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of trees and of two linear models in their blend, with the held-out AUC of each and of the blend."""
    train, _, names = training_matrix(spark, sf, 2, 1)
    trees = FoldModels.fit(train, gbt(TREES), 2, "fold_0", names).out_of_fold(train, ["c_custkey"], "pred")
    scaled = stored(unit_scaled(train, train))
    # both penalties share their passes
    linear = stored(fit_logistic_many(scaled, [{"C": 1.0}, {"C": 1e-4}], 2).out_of_fold(scaled, "c_custkey"))
    families = {"trees": trees, "logistic": linear.filter("candidate = 0"), "strict": linear.filter("candidate = 1")}
    rows = stored(joined_predictions(families, "c_custkey").join(train.select("c_custkey", "label"), "c_custkey"))
    return fit_blend(rows, "label", list(families)).report(rows)


@query("guided_search")
def guided(spark: SparkSession, sf: str) -> DataFrame:
    """Every trial of a search for the penalty and the number of steps, led by a forest over the scores so far."""
    train, _, _ = training_matrix(spark, sf, 2, 1)
    train = stored(unit_scaled(train, train))

    def score(params: list[dict]) -> list[float]:
        scored = score_logistic_many(train, "c_custkey", [{"C": 10.0 ** p["log_c"], "max_iter": p["max_iter"]} for p in params], 2)
        found = {r["candidate"]: r["Score_Weighted"] for r in scored.table.collect()}
        return [found[i] for i in range(len(params))]

    space = {"log_c": Uniform(-5, 2), "max_iter": Uniform(1, 12, whole=True)}
    return guided_search(spark, space, score, first=5, batches=2, size=3, pool=200).table(spark)
