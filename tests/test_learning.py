"""Training, scoring and search on a small learnable matrix."""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.learning.estimators import depth_for_leaves, gbt, logistic
from sparkfeat.learning.search import Search, Stage, combinations, staged_search, with_repeated_folds
from sparkfeat.learning.stages import (
    DEPTHWISE_START,
    LEAFWISE_START,
    depths_for,
    depthwise_stages,
    fractions_around,
    leafwise_stages,
    leaves_around,
    neighbours,
    wide_random_stage,
)
from sparkfeat.learning.training import (
    FeatureVectors,
    FoldModels,
    _best_round,
    boosting_rounds,
    class_weights,
    early_stop,
    feature_names,
    fit_folds_early,
    refit_score,
)
from sparkfeat.operators.evaluate import roc_auc, score_table
from sparkfeat.sources.tables import nan_to_null

N = 400


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": np.arange(N), "a": rng.normal(size=N), "b": rng.normal(size=N)})
    pdf["label"] = (rng.random(N) < 1 / (1 + np.exp(-3 * pdf.a))).astype(int)
    pdf.loc[rng.random(N) < 0.2, "b"] = np.nan
    return nan_to_null(spark.createDataFrame(pdf)).cache()


@pytest.fixture(scope="module")
def matrix(rows):
    vectors = FeatureVectors.fit(rows, ["a", "b"])
    return with_repeated_folds(vectors.transform(rows, ["id", "label"]), "id", "label", 2, 2).cache()


def test_vectors_fill_and_flag(spark):
    df = spark.createDataFrame([(1, 2.0, None, None), (2, 4.0, 1.0, None)], "k int, a double, b double, c double")
    fitted = FeatureVectors.fit(df, ["a", "b", "c"])
    assert fitted.names == ["a", "b", "c", "b__missing", "c__missing"]
    got = [list(r["features"].toArray()) for r in fitted.transform(df, ["k"]).orderBy("k").collect()]
    assert got == [[2.0, 1.0, 0.0, 1.0, 1.0], [4.0, 1.0, 0.0, 0.0, 1.0]]
    assert feature_names(df.withColumnRenamed("k", "SK_ID_CURR")) == ["a", "b", "c"]


def test_parameter_names():
    model = gbt({"learning_rate": 0.2, "num_boost_round": 7.0, "num_leaves": 31, "max_depth": -1, "max_bin": 64})
    assert (model.getStepSize(), model.getMaxIter(), model.getMaxDepth(), model.getMaxBins()) == (0.2, 7, 5, 64)
    model = gbt({"feature_fraction": 0.8, "subsample": 1.0, "min_child_weight": 39.3, "gamma": 0.1, "max_depth": 4})
    assert model.getFeatureSubsetStrategy() == "0.8" and model.getSubsamplingRate() == 1.0
    assert model.getMinInstancesPerNode() == 39 and model.getMinInfoGain() == 0.1
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        gbt({"lambda_l1": 1, "scale_pos_weight": 3})
    assert "lambda_l1" in str(caught[0].message) and "scale_pos_weight" in str(caught[0].message)
    for wrong in (
        {"max_depth": 50},
        {"subsample": 1.2},
        {"max_bin": 1},
        {"n_estimators": 0},
        {"min_child_weight": 2, "min_child_samples": 3},
    ):
        with pytest.raises(ValueError):
            gbt(wrong)
    assert gbt({"num_leaves": 34, "max_depth": 8}).getMaxDepth() == 6
    assert gbt({"num_leaves": 34, "max_depth": 3}).getMaxDepth() == 3
    assert gbt({"n_estimators": 3}, weight="w").getWeightCol() == "w"
    with pytest.raises(ValueError, match="unknown boosted-tree parameter"):
        gbt({"leraning_rate": 0.1})
    line = logistic({"C": 2.0, "penalty": "l1"}, n_rows=50)
    assert line.getRegParam() == pytest.approx(0.01) and line.getElasticNetParam() == 1.0
    assert depth_for_leaves(31) == 5 and depth_for_leaves(33) == 6


def test_out_of_fold(rows, matrix):
    models = FoldModels.fit(matrix, gbt({"n_estimators": 4, "max_depth": 2}), 2, "fold_0", ["a", "b", "b__missing"])
    own = models.out_of_fold(matrix, ["id", "label"]).cache()
    assert own.count() == own.select("id").distinct().count() == N
    assert roc_auc(own, "label", "prediction").first()["auc"] > 0.75
    # a held-out row is scored by the model that has not seen its fold
    by_hand = models.models[1].transform(matrix.filter("fold_0 = 1")).select("id", "probability").first()
    assert own.filter(F.col("id") == by_hand["id"]).first()["prediction"] == pytest.approx(by_hand["probability"][1])
    bagged = models.mean_prediction(matrix, ["id"])
    assert bagged.columns == ["id", "prediction"] and bagged.count() == N
    importance = models.importance(matrix).toPandas()
    assert len(importance) == 6
    assert importance.groupby("feature").importance.mean().idxmax() == "a"


def test_boosting_rounds(matrix):
    best = boosting_rounds(matrix, gbt({"n_estimators": 6, "max_depth": 2, "learning_rate": 0.3}), 2, "fold_0", 2)
    assert 1 <= best <= 6


def test_training_stops_early(matrix):
    """A thousand rounds are asked for; far fewer are grown, and the best lies before the last."""
    trees = gbt({"n_estimators": 1000, "max_depth": 4, "learning_rate": 0.5})
    stop = early_stop(matrix, trees, 2, "fold_0", patience=3)
    assert stop.rounds < stop.fitted <= 48 and len(stop.losses) == stop.fitted
    assert stop.losses[stop.rounds - 1] == min(stop.losses[: stop.rounds + 3])
    models = fit_folds_early(matrix, trees, 2, "fold_0", ["a", "b", "b__missing"], patience=3)
    assert [m.getNumTrees for m in models.models] == [stop.rounds] * 2


def test_best_round_waits_for_patience():
    assert _best_round([5, 4, 3, 4, 4, 1], 2) == 3
    assert _best_round([5, 4, 3, 4, 4, 1], 3) == 6
    assert _best_round([1.0], 5) == 1


def test_refit_score(rows, matrix):
    out = refit_score(logistic({"C": 1.0}, N), matrix, matrix, "id", "logistic_regression")
    assert out.columns == ["id", "pred_logistic_regression"]
    joined = out.join(rows, "id")
    assert roc_auc(joined, "label", "pred_logistic_regression").first()["auc"] > 0.8


def test_class_weights(rows):
    sums = class_weights(rows, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert sums[0]["w"] == pytest.approx(sums[1]["w"])


def test_score_table(spark):
    rows = []
    for repeat in (0, 1):
        for i in range(8):
            label = i % 2
            rows.append((0, repeat, i // 4, i, label, float(label)))
            rows.append((1, repeat, i // 4, i, label, float(i if repeat else -i)))
    df = spark.createDataFrame(rows, "candidate int, repeat int, fold int, id int, label int, pred double")
    got = {r["candidate"]: r for r in score_table(df, "id", "label", "candidate", "repeat", "fold", "pred").collect()}
    assert got[0]["Score"] == 1.0 and got[0]["Score_Std"] == 0.0 and got[0]["Score_Weighted"] == 1.0
    # the repeats cancel out on average, and every fold has an AUC of 0.75 or 0.25
    assert got[1]["Score"] == 0.5 and got[1]["Score_Std"] == pytest.approx(0.25)
    assert got[1]["Score_Weighted"] == pytest.approx(0.475)


def test_staged_search(matrix):
    work = Search(matrix, "id", lambda p: logistic(p, N), folds=2, repeats=2)
    stages = [
        Stage("strength", lambda best: {"C": [1e-6, 1.0]}),
        Stage("drawn", candidates=lambda best: [{**best, "max_iter": n} for n in (1, 5)], repeats=1),
    ]
    results = staged_search(work, stages, {"C": 0.5, "max_iter": 5})
    assert [r.name for r in results] == ["strength", "drawn"]
    assert results[0].scored.candidates == {0: {"C": 1e-6, "max_iter": 5}, 1: {"C": 1.0, "max_iter": 5}}
    best = results[0].scored.best
    assert all(p["C"] == best["C"] for p in results[1].scored.candidates.values())
    predictions = results[1].scored.best_predictions
    assert predictions.count() == N
    report = results[1].scored.report()
    assert report.count() == 2
    assert {"candidate", "params", "Score", "Score_Std", "Score_Weighted"} == set(report.columns)


def test_equal_models_are_fitted_once(matrix):
    work = Search(matrix, "id", lambda p: gbt({"n_estimators": 2, **p}), folds=2, repeats=1)
    many = [{"num_leaves": n, "min_child_weight": w} for n in range(17, 33) for w in range(1, 8)]
    assert len(many) > 100 and len(work.different(many)) == 7
    scored = work.score(many[:9])
    assert scored.repeated == 2 and scored.report().count() == 7 and scored.best_predictions.count() == N


def test_search_finds_rounds(matrix):
    work = Search(matrix, "id", lambda p: gbt({**p, "max_depth": 2}), folds=2, repeats=1)
    (result,) = staged_search(work, [Stage("rounds", rounds="n_estimators")], {"n_estimators": 3})
    assert 1 <= result.scored.best["n_estimators"] <= 3


def test_stages(spark):
    assert combinations({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
    assert fractions_around(0.9) == [0.75, 0.8, 0.85, 0.9, 0.95, 1.0]
    assert fractions_around(1.0) == [0.85, 0.9, 0.95, 1.0]
    assert leaves_around(32)[:3] == [26, 27, 28] and leaves_around(32)[-1] == 38 and neighbours(1, 1, 3) == [1, 2, 3, 4]
    assert depths_for(32) == [3, 4, 5, 6]
    best = {**LEAFWISE_START}
    sizes = [len(combinations(s.grid(best))) for s in leafwise_stages()]
    assert sizes[1] == 28 and sizes[4] == 8 and sizes[5] == 36
    stages = depthwise_stages(spark, draws=5)
    drawn = next(s for s in stages if s.candidates).candidates(dict(DEPTHWISE_START))
    assert len(drawn) == 5 and all(0 <= p["subsample"] <= 1 for p in drawn)
    # every candidate is something the model family accepts
    for p in [*drawn, *wide_random_stage(spark, draws=3).candidates({"num_boost_round": 10})]:
        gbt(p)


def test_folds_are_fitted_side_by_side_where_repeats_are_few(spark, monkeypatch):
    """One repeat leaves the whole parallelism to its folds, four repeats none."""
    from sparkfeat.learning import search as module

    seen = []

    class Fitted:
        @staticmethod
        def fit(matrix, estimator, k, fold, names, parallelism):
            seen.append((fold, parallelism))
            return Fitted()

        def out_of_fold(self, matrix, keep, out):
            return matrix.selectExpr("id", "label", "fold_0", "fold_1", "0.5D as pred")

    monkeypatch.setattr(module, "FoldModels", Fitted)
    work = module.Search(spark.sql("select 1 as id, 0 as label, 0 as fold_0, 1 as fold_1"), "id", lambda p: None, folds=2, repeats=1, parallelism=4)
    assert work.predictions(0, {}, 1).count() == 1
    assert work.predictions(0, {}, 2).count() == 2
    assert sorted(seen) == [("fold_0", 2), ("fold_0", 4), ("fold_1", 2)]
