"""Boosted trees against a plain one-leaf-at-a-time version, and what training promises."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.learning.boosting import (
    UNIT, Binning, Booster, Boosting, best_round, fit_boosted, fit_until_best, round_scores,
)
from sparkfeat.operators.evaluate import kfold, roc_auc
from sparkfeat.sources.tables import nan_to_null

N = 300

pytestmark = pytest.mark.usefixtures("plain_execution")


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    out = pd.DataFrame({"id": np.arange(N), "a": rng.normal(size=N).round(1), "b": rng.integers(0, 6, N).astype(float), "c": rng.normal(size=N)})
    odds = 2 * out.a + np.where(out.b > 3, 1.5, -0.5)
    out["y"] = (rng.random(N) < 1 / (1 + np.exp(-odds))).astype(float)
    out.loc[rng.random(N) < 0.2, "a"] = np.nan
    out.loc[rng.random(N) < 0.1, "b"] = np.nan
    out["d"] = 7.0
    out["e"] = np.nan
    out.loc[rng.random(N) < 0.1, "y"] = np.nan
    return out


@pytest.fixture(scope="module")
def rows(spark, pdf):
    return nan_to_null(spark.createDataFrame(pdf)).withColumn("fold", kfold("id", 2, 1)).cache()


FEATURES = ["a", "b", "c", "d", "e"]


def plain_tree(codes, g, h, use, s, columns):
    """Grow one leaf at a time, always the one with the largest gain."""
    score = lambda x, y: max(abs(x) - s.l1, 0) ** 2 / (y + s.l2) if y + s.l2 else 0.0

    def best(rows):
        top = None
        for f in columns:
            c = codes[rows, f]
            for t in sorted(set(c[c >= 0])):
                for missing_left in (False, True):
                    if missing_left and not (c < 0).any():
                        continue
                    left = (c <= t) & ((c >= 0) | missing_left)
                    x, y = rows[left], rows[~left]
                    if min(len(x), len(y)) < max(s.least_rows, 1):
                        continue
                    sums = [v[r].sum() / UNIT for r in (x, y, rows) for v in (g, h)]
                    if min(sums[1], sums[3]) < s.least_hessian:
                        continue
                    gain = score(sums[0], sums[1]) + score(sums[2], sums[3]) - score(sums[4], sums[5])
                    key = (gain, -f, -t, not missing_left)
                    if gain > max(s.least_gain, 1e-12) and (top is None or key > top[0]):
                        top = (key, x, y)
        return top

    leaves, splits = [(np.flatnonzero(use), 0)], 0
    found = []
    while splits < s.leaves - 1:
        options = [(best(r), i) for i, (r, d) in enumerate(leaves) if s.depth <= 0 or d < s.depth]
        options = [(b, i) for b, i in options if b is not None]
        if not options:
            break
        top, i = max(options, key=lambda o: o[0][0][0])
        depth = leaves.pop(i)[1]
        leaves += [(top[1], depth + 1), (top[2], depth + 1)]
        found.append((FEATURES[-top[0][1]], -top[0][2], not top[0][3], round(top[0][0], 6)))
        splits += 1
    values = {}
    for r, _ in leaves:
        x, y = g[r].sum() / UNIT, h[r].sum() / UNIT
        values.update(dict.fromkeys(r.tolist(), -s.rate * math.copysign(max(abs(x) - s.l1, 0), x) / (y + s.l2)))
    return found, values, sorted((len(r), round(values[r[0]], 6)) for r, _ in leaves)


@pytest.mark.parametrize(
    "params",
    [
        {"n_estimators": 3, "num_leaves": 4, "min_child_samples": 5, "lambda_l2": 1.0},
        {"n_estimators": 2, "num_leaves": 9, "max_depth": 3, "lambda_l1": 2.0, "min_child_weight": 2.0, "max_bin": 16, "scale_pos_weight": 2.5},
        {"n_estimators": 2, "num_leaves": 31, "min_split_gain": 0.5, "min_child_samples": 1, "colsample_bytree": 0.6, "is_unbalance": True},
    ],
)
def test_trees_against_plain_growth(rows, pdf, params):
    s = Boosting.of({"learning_rate": 0.3, **params})
    booster = Booster(rows, "id", "y", FEATURES, s)
    codes = {r["key"]: r["codes"] for r in booster.rows.collect()}
    codes = np.array([codes[i] for i in pdf.id])
    booster.grow(s.rounds)
    y, use = pdf.y.to_numpy(), pdf.y.notna().to_numpy()
    weight = s.positive_weight if not s.balanced else (y[use] == 0).sum() / (y[use] == 1).sum()
    w = np.where(y == 1, weight, 1.0)
    margin = np.full(N, math.log((y[use] == 1).sum() * weight / (y[use] == 0).sum()))
    for t, tree in enumerate(booster.trees[0]):
        p = 1 / (1 + np.exp(-margin))
        g = np.where(use, np.round((p - np.nan_to_num(y)) * w * UNIT), 0)
        h = np.where(use, np.round(p * (1 - p) * w * UNIT), 0)
        columns = range(5)
        if s.column_share < 1:
            columns = sorted({p.feature for p in tree.splits.values()})  # a subset of those drawn
            assert len(columns) <= 3
        splits, values, leaves = plain_tree(codes, g, h, use, s, columns)
        names = [(FEATURES[p.feature], p.code, p.missing_left, round(p.gain, 6)) for p in tree.splits.values()]
        assert names == splits and len(splits) > 0
        ends = [n for n in tree.values if n not in tree.splits]
        assert sorted((tree.rows[n], round(tree.values[n], 6)) for n in ends) == leaves
        for i, v in values.items():
            margin[i] += v


def test_every_row_is_scored_by_every_model(rows, pdf):
    fitted = fit_boosted(rows, "id", "y", FEATURES, {"n_estimators": 5, "num_leaves": 4, "learning_rate": 0.3}, 2, "fold")
    own = fitted.out_of_fold().toPandas().set_index("id")
    assert len(own) == pdf.y.notna().sum()
    assert roc_auc(fitted.out_of_fold(), "label", "prediction").first()["auc"] > 0.75
    # a forest scores new rows as training has scored them
    margins = {r["key"]: r["margins"] for r in fitted.rows.collect()}
    for j, forest in enumerate(fitted.forests):
        for r in forest.margin(rows, ["id"]).collect():
            assert r["margin"] == pytest.approx(margins[r["id"]][j], abs=1e-9)
    rest = fitted.mean_prediction(unlabelled_only=True).toPandas()
    assert len(rest) == pdf.y.isna().sum() and rest.prediction.between(0, 1).all()
    shares = fitted.importance().toPandas()
    assert shares.groupby("fold").importance.sum().round(9).tolist() == [1, 1]
    assert shares.groupby("feature").importance.mean().idxmax() == "a"
    assert set(fitted.nodes().toPandas().query("feature.notna()").feature) <= {"a", "b", "c"}


def test_a_model_learns_from_the_other_folds_only(rows):
    """The models of folds equal single fits on the rows of the other folds."""
    params = {"n_estimators": 1, "num_leaves": 4, "max_bin": 300}
    both = fit_boosted(rows, "id", "y", FEATURES, params, 2, "fold")
    for j in range(2):
        alone = fit_boosted(rows.withColumn("y", F.when(F.col("fold") != j, F.col("y"))), "id", "y", FEATURES, params)
        mine = [[(p.feature, p.missing_left, round(p.gain, 6)) for p in t.splits.values()] for t in both.forests[j].trees]
        other = [[(p.feature, p.missing_left, round(p.gain, 6)) for p in t.splits.values()] for t in alone.forests[0].trees]
        assert mine == other


def test_scores_of_every_round(rows):
    booster = Booster(rows, "id", "y", FEATURES, Boosting.of({"num_leaves": 4, "learning_rate": 0.5}), 2, "fold")
    booster.grow(2)
    got = round_scores(booster, 2)
    for n, score in enumerate(got):
        parts = []
        for j in range(2):
            held = rows.filter(f"y is not null and fold = {j}")
            forest = fit_forest(booster, j, n + 1)
            parts.append(roc_auc(forest.margin(held, ["y"]), "y", "margin").first()["auc"])
        assert score == pytest.approx(sum(parts) / 2, abs=1e-12)


def fit_forest(booster, j, n):
    from sparkfeat.learning.boosting import Forest

    return Forest(booster.bases[j], tuple(booster.trees[j][:n]), booster.binning)


def test_training_stops_by_auc_and_grows_on(rows, monkeypatch):
    """A thousand rounds are asked for; no tree is grown twice and few beyond the decision."""
    grown = []
    original = Booster._next_trees
    monkeypatch.setattr(Booster, "_next_trees", lambda self: grown.append(1) or original(self))
    fitted = fit_until_best(rows, "id", "y", FEATURES, {"n_estimators": 1000, "num_leaves": 4, "learning_rate": 1.0}, 2, "fold", patience=2)
    best = len(fitted.forests[0].trees)
    assert fitted.scores[best - 1] == max(fitted.scores[: best + 2])
    assert best + 2 <= len(grown) < best + 2 + 4
    margins = {r["key"]: r["margins"] for r in fitted.rows.collect()}
    for r in fitted.forests[1].margin(rows, ["id"]).collect():
        assert r["margin"] == pytest.approx(margins[r["id"]][1], abs=1e-9)


def test_bins(spark):
    df = spark.createDataFrame([(float(i % 3), float(i), None, 5.0) for i in range(100)], "few double, many double, none double, one double")
    b = Binning.fit(df, df.columns, 10)
    assert b.edges[0] == (1.0, 2.0) and len(b.edges[1]) == 9 and b.edges[2] == () and b.edges[3] == ()
    got = b.codes(df, [F.col("many")]).orderBy("many").collect()
    assert [r["codes"][0] for r in got[:4]] == [0, 1, 2, 0] and {r["codes"][2] for r in got} == {-1} and {r["codes"][3] for r in got} == {0}
    codes = [r["codes"][1] for r in got]
    assert codes == sorted(codes) and set(codes) == set(range(10))


def test_settings():
    s = Boosting.of({"num_boost_round": 7.0, "reg_alpha": 1, "lambda_l2": 2, "min_child_weight": 3, "max_depth": -1, "boosting": "gbdt", "nthread": 4})
    assert (s.rounds, s.l1, s.l2, s.least_hessian, s.depth) == (7, 1.0, 2.0, 3.0, -1)
    for wrong in ({"leraning_rate": 1}, {"lambda_l1": 1, "reg_alpha": 1}, {"num_leaves": 1}, {"lambda_l2": -1}, {"subsample": 0}, {"max_bin": 1}):
        with pytest.raises(ValueError):
            Boosting.of(wrong)
    assert best_round([0.5, 0.6, 0.6, 0.7, 0.1], 2) == 4 and best_round([0.5], 3) == 1


def test_no_labelled_rows(rows):
    fitted = fit_boosted(rows.filter("y is null"), "id", "y", FEATURES, {"n_estimators": 2})
    assert {r["prediction"] for r in fitted.mean_prediction().collect()} == {0.5}


def test_equal_rows_are_grown_over_once(spark):
    """Rows of equal label, fold and codes are one cell; trees, scores and margins are those of the rows one by one."""
    df = spark.range(3000).selectExpr("id", "cast(id % 7 as double) as a", "cast(id % 5 as double) as b", "int(id % 7 + id % 5 + id % 3 > 6) as y", "int(id % 2) as fold")
    s = Boosting.of({"num_leaves": 5, "learning_rate": 0.5})
    booster = Booster(df, "id", "y", ["a", "b"], s, 2, "fold")
    assert booster.cells.count() <= 7 * 5 * 2 * 2 and booster.cells.agg(F.sum("n")).first()[0] == 3000
    single = Booster(df, "id", "y", ["a", "b"], s, 2, "fold")
    single.cells = single.rows.join(single.cells, ["label", "fold", "codes"]).withColumn("n", F.lit(1).cast("long"))
    booster.grow(2)
    single.grow(2)
    assert booster.trees == single.trees and round_scores(booster, 2) == round_scores(single, 2)


def test_trees_beyond_the_decision_do_not_count(rows, monkeypatch):
    """However many trees are grown at a time, the scores end where the decision falls."""
    import sparkfeat.learning.boosting as module

    monkeypatch.setattr(module, "round_scores", lambda booster, n: [[0.5, 0.6, 0.55, 0.9][len(booster.trees[0]) - n + i] for i in range(n)])
    fitted = fit_until_best(rows, "id", "y", FEATURES, {"n_estimators": 4, "num_leaves": 3}, 2, "fold", patience=1)
    assert fitted.scores == (0.5, 0.6, 0.55) and len(fitted.forests[0].trees) == 2


def test_a_pass_is_one_job_and_plans_no_query(spark, rows, monkeypatch):
    """Hundreds of passes over few cells took most of their time to plan queries and to store margins."""
    booster = Booster(rows, "id", "y", FEATURES, Boosting.of({"num_leaves": 4, "learning_rate": 0.5}), 2, "fold")
    booster.grow(1)
    passes = []
    original = Booster._best_splits
    monkeypatch.setattr(Booster, "_best_splits", lambda self, *a: passes.append(1) or original(self, *a))
    for name in ("collect", "checkpoint"):
        monkeypatch.setattr(type(rows), name, lambda *a, name=name: pytest.fail(f"{name} of a query"))
    spark.sparkContext.setJobGroup("passes", "passes")
    try:
        booster.settle()
        booster.grow(4)
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("passes")
        spark.sparkContext._jsc.clearJobGroup()
    assert len(booster.trees[0]) == 5 and len(passes) >= 8 and len(jobs) == len(passes)


def test_many_sums_blocks_and_ranges_give_the_same(rows, monkeypatch):
    """Sums that are too many to be sent home, small blocks and scores in several ranges change nothing."""
    import sparkfeat.learning.boosting as boosting
    import sparkfeat.learning.histograms as tasks

    def grown():
        booster = Booster(rows, "id", "y", FEATURES, Boosting.of({"num_leaves": 6, "learning_rate": 0.5}), 2, "fold")
        booster.grow(6)
        return booster.trees, round_scores(booster, 2)

    want = grown()
    for module, name, value in ((boosting, "HOME", 0), (boosting, "CELLS", 40), (boosting, "PACKED", 3), (tasks, "HELD", 0), (tasks, "BLOCK", 17), (tasks, "EXACT", 0.0)):
        monkeypatch.setattr(module, name, value)
    assert grown() == want


def test_rows_are_drawn_by_key_and_tree(rows, monkeypatch):
    """The root of every tree has the labelled rows drawn for it, also after blocks were packed anew."""
    import sparkfeat.learning.boosting as boosting

    monkeypatch.setattr(boosting, "PACKED", 3)
    booster = Booster(rows, "id", "y", FEATURES, Boosting.of({"num_leaves": 3, "subsample": 0.5, "seed": 4}), 2, "fold")
    booster.grow(8)
    for t in range(8):
        drawn = rows.filter("y is not null").filter(F.pmod(F.xxhash64(F.lit(4), F.lit(t), "id"), F.lit(1 << 20)) < (1 << 19))
        counts = {r["fold"]: r["count"] for r in drawn.groupBy("fold").count().collect()}
        assert [booster.trees[j][t].rows[0] for j in range(2)] == [counts[1], counts[0]]


def test_whole_gradients():
    """Halves are rounded away from zero, and sums beyond the doubles' whole numbers stay exact."""
    from sparkfeat.learning.histograms import _summed, _whole

    assert _whole(np.array([0.5, 1.5, -0.5, -2.5, 0.49999999999999994, 2.4])).tolist() == [1, 2, -1, -3, 0, 2]
    big = np.array([1 << 60, 1, 1 << 60, -1])
    assert _summed(np.array([0, 0, 1, 1]), big, 2).tolist() == [(1 << 60) + 1, (1 << 60) - 1]
