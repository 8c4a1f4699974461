"""Fits that share their passes, blends of families, and searches led by a surrogate."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkfeat.learning.batched import _twins, fit_logistic_many, score_logistic_many
from sparkfeat.learning.grids import Uniform, random_grid
from sparkfeat.learning.guided import guided_search
from sparkfeat.learning.stacking import blend_weights, fit_blend, joined_predictions, on_simplex

N, D = 300, 3

pytestmark = pytest.mark.usefixtures("plain_execution")


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(N, D)) * [1, 3, 0.2]
    y = (rng.random(N) < 1 / (1 + np.exp(-(x[:, 0] - 0.4 * x[:, 1] + 0.5)))).astype(int)
    return pd.DataFrame({"id": np.arange(N), "label": y, "x": x.tolist(), "fold_0": np.arange(N) % 3, "fold_1": (np.arange(N) * 7 // 5) % 3})


@pytest.fixture(scope="module")
def matrix(spark, pdf):
    return spark.createDataFrame(pdf).select("id", "label", array_to_vector("x").alias("features"), "fold_0", "fold_1").cache()


def plain_fit(x, y, c):
    """Gradient and curvature of one fit, until nothing moves."""
    x1, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    shrink = np.append(np.full(x.shape[1], 1 / c), 0)
    for _ in range(200):
        p = 1 / (1 + np.exp(-x1 @ beta))
        step = np.linalg.solve((x1.T * (p * (1 - p))) @ x1 + np.diag(shrink), x1.T @ (p - y) + shrink * beta)
        beta -= step
        if np.abs(step).max() < 1e-12:
            return beta
    raise AssertionError("no end")


CANDIDATES = [{"C": 0.01}, {"C": 1.0}, {"C": 100.0}]


def test_all_fits_equal_single_ones(matrix, pdf):
    fits = fit_logistic_many(matrix, CANDIDATES, folds=3, repeats=2)
    x, y = np.array(pdf.x.tolist()), pdf.label.to_numpy()
    for c, p in enumerate(CANDIDATES):
        for r in range(2):
            for j in range(3):
                use = (pdf[f"fold_{r}"] != j).to_numpy()
                assert fits.coefficients[c, r, j] == pytest.approx(plain_fit(x[use], y[use], p["C"]), abs=1e-6)
    assert fits.passes < 20  # for eighteen fits
    own = fits.out_of_fold(matrix, "id").toPandas()
    assert len(own) == N * 3 * 2
    for row in own.sample(20, random_state=1).itertuples():
        i = int(row.id)
        assert row.fold == pdf[f"fold_{row.repeat}"][i] and row.label == pdf.label[i]
        beta = fits.coefficients[row.candidate, row.repeat, row.fold]
        assert row.pred == pytest.approx(1 / (1 + np.exp(-(np.dot(beta[:-1], pdf.x[i]) + beta[-1]))))


def test_fits_at_one_point_are_summed_once():
    """Candidates start at the same point; only those on the same rows are twins, and only while they are there."""
    left_out = [(r, j) for _ in range(3) for r in range(2) for j in range(2)]
    beta = np.zeros((12, 4))
    assert _twins(beta, left_out) == [0, 1, 2, 3] * 3
    beta[5, 2] = 0.5
    assert _twins(beta, left_out) == [0, 1, 2, 3, 0, 5, 2, 3, 0, 1, 2, 3]


def test_steps_are_bounded_and_one_class_is_no_trouble(matrix):
    short = fit_logistic_many(matrix, [{"C": 1.0, "max_iter": 1}], folds=3)
    assert short.passes == 2
    ones = fit_logistic_many(matrix.filter("label = 1"), [{"C": 1.0}], folds=3)
    assert np.isfinite(ones.coefficients).all() and (ones.coefficients[..., -1] > 3).all()
    assert fit_logistic_many(matrix.limit(0), [{"C": 1.0}], folds=3).passes == 0


def test_scores(matrix):
    scored = score_logistic_many(matrix, "id", CANDIDATES, 3, 2)
    table = scored.report().toPandas()
    assert len(table) == 3 and table.Score.between(0.6, 1).all()
    assert scored.best == CANDIDATES[int(table.sort_values(["Score_Weighted", "candidate"], ascending=[False, True]).candidate.iloc[0])]
    assert scored.best_predictions.count() == N


def test_weights_against_a_grid():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 400)
    p = np.column_stack([np.clip(y * 0.5 + rng.normal(0.25, s, 400), 0, 1) for s in (0.2, 0.3, 0.6)])
    m, t = p.T @ p / 400, p.T @ y / 400
    w = blend_weights(m, t)
    assert w.min() >= 0 and w.sum() == pytest.approx(1)
    loss = lambda v: v @ m @ v - 2 * v @ t
    grid = [(a / 40, b / 40, 1 - a / 40 - b / 40) for a in range(41) for b in range(41 - a)]
    assert loss(w) <= min(loss(np.array(g)) for g in grid) + 1e-9
    assert on_simplex(np.array([0.2, 5.0, -1.0])).tolist() == [0, 1, 0]


def test_a_blend_is_not_below_the_best_family(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, N)
    noisy = lambda s: np.clip(y * 0.4 + rng.normal(0.3, s, N), 0, 1)
    pdf = pd.DataFrame({"id": np.arange(N), "label": y, "a": noisy(0.3), "b": noisy(0.3), "c": rng.random(N)})
    df = spark.createDataFrame(pdf)
    families = {n: df.select("id", F.col(n).alias("pred")) for n in "abc"}
    rows = joined_predictions(families, "id").join(df.select("id", "label"), "id")
    blend = fit_blend(rows, "label", list("abc"))
    assert blend.score >= max(blend.scores.values())
    assert sum(blend.weights.values()) == pytest.approx(1) and blend.weights["c"] < 0.2
    assert blend.report(df).count() == 4
    alone = fit_blend(rows, "label", ["c"])
    assert alone.weights == {"c": 1.0} and alone.score == pytest.approx(blend.scores["c"])


def test_guided_search_beats_random_draws(spark):
    space = {"a": Uniform(0, 1), "b": Uniform(0, 1), "kind": ["x", "y", "z"], "n": Uniform(1, 20, whole=True)}
    value = lambda p: -((p["a"] - 0.7) ** 2) - (p["b"] - 0.2) ** 2 - 0.002 * abs(p["n"] - 9) - 0.3 * (p["kind"] != "y")
    score = lambda ps: [value(p) for p in ps]
    guided, random = [], []
    for seed in (1, 11):
        found = guided_search(spark, space, score, first=8, batches=4, size=4, pool=300, seed=seed)
        assert len(found.trials) == 24 and [t.number for t in found.trials] == list(range(24))
        assert all(t.chance is None for t in found.trials[:8]) and all(0 <= t.chance <= 1 for t in found.trials[8:])
        guided.append(found.best.score)
        random.append(max(value(r.asDict()) for r in random_grid(spark, space, 24, seed).collect()))
    assert sum(guided) > sum(random)
    assert found.table(spark).count() == 24


def test_linear_families_of_the_blend_share_their_passes(spark, monkeypatch):
    """Both penalties of ``stacked_blend`` are fitted by one call, and no scores are made beside the blend's."""
    from sparkfeat.queries import learning as module
    from tests.conftest import SF

    calls = []

    def fit(matrix, candidates, folds):
        calls.append([c["C"] for c in candidates])
        return fit_logistic_many(matrix, candidates, folds)

    monkeypatch.setattr(module, "fit_logistic_many", fit)
    rows = {r["family"]: r for r in module.stacked_blend(spark, SF).collect()}
    assert calls == [[1.0, 1e-4]]
    assert set(rows) == {"trees", "logistic", "strict", "blend"}
    assert rows["blend"]["auc"] >= max(rows[n]["auc"] for n in ("trees", "logistic", "strict"))


def test_refits_of_both_families_run_side_by_side(spark, monkeypatch):
    from sparkfeat.queries import learning as module
    from tests.conftest import SF

    calls, run = [], module.fit_all

    def fit_all(spark, jobs, parallelism):
        calls.append((len(jobs), parallelism))
        return run(spark, jobs, parallelism)

    monkeypatch.setattr(module, "fit_all", fit_all)
    out = module.refit(spark, SF)
    assert calls == [(2, 2)]
    assert out.filter("pred_gbt_ok and pred_logistic_regression_ok").count() == out.count() > 0
