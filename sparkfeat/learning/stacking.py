"""A second level over stored predictions of several model families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.operators.evaluate import roc_auc
from sparkfeat.sources.checkpoints import stored

STEPS = 5_000


def joined_predictions(families: Mapping[str, DataFrame], key: str, prediction: str = "pred") -> DataFrame:
    """One row per key that all families have scored, with a column per family."""
    parts = [df.select(col(key), col(prediction).alias(name)) for name, df in families.items()]
    return reduce(lambda a, b: a.join(b, key), parts)


def on_simplex(v: np.ndarray) -> np.ndarray:
    """The nearest point with no negative part whose parts add up to 1."""
    u = np.sort(v)[::-1]
    over = (np.cumsum(u) - 1) / np.arange(1, len(v) + 1)
    return np.maximum(v - over[np.flatnonzero(u > over)[-1]], 0)


def blend_weights(moments: np.ndarray, towards: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights of least squared error, from the mean products of the predictions and those with the label."""
    w = np.full(len(towards), 1 / len(towards))
    rate = 1 / max(np.linalg.eigvalsh(moments)[-1], 1e-12)
    for _ in range(steps):
        after = on_simplex(w - rate * (moments @ w - towards))
        if np.abs(after - w).max() < 1e-12:
            break
        w = after
    return w


@dataclass(frozen=True)
class Blend:
    """Non-negative weights of the families, which add up to 1, with the held-out AUC of each family and of the blend."""

    weights: dict[str, float]
    scores: dict[str, float]
    score: float

    def predict(self, out: str = "prediction") -> Column:
        """The blend of a frame that has a column per family."""
        return sum([F.lit(w) * col(n) for n, w in self.weights.items()], F.lit(0.0)).alias(out)

    def report(self, df: DataFrame) -> DataFrame:
        rows = [(n, w, self.scores[n]) for n, w in self.weights.items()] + [("blend", sum(self.weights.values()), self.score)]
        return df.sparkSession.createDataFrame(rows, "family string, weight double, auc double")


def fit_blend(rows: DataFrame, label: str, families: Sequence[str]) -> Blend:
    """Fit the weights on out-of-fold predictions: one pass for the moments, one for the scores of all.

    The least squared error of a blend is no greater than that of any family. Its AUC may be
    smaller; then the best family alone is the blend, so it is never below the best.
    """
    n = len(families)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    y = col(label).cast("double")
    known = rows.filter(y.isNotNull())
    row = known.agg(
        *[F.avg(col(families[i]) * col(families[j])).alias(f"m{i}_{j}") for i, j in pairs], *[F.avg(col(f) * y).alias(f"t{i}") for i, f in enumerate(families)]
    ).first()
    moments = np.array([[row[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
    w = blend_weights(moments, np.array([row[f"t{i}"] or 0.0 for i in range(n)]))
    weights = dict(zip(families, w.tolist()))
    blend = Blend(weights, {}, 0.0)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("family"), col(f).alias("score")) for f in families], F.struct(F.lit("").alias("family"), blend.predict("x").alias("score"))))
    long = stored(known.select(y.alias("label"), each.alias("e")).select("label", "e.family", "e.score"))
    scores = {r["family"]: r["auc"] or 0.0 for r in roc_auc(long, "label", "score", ["family"]).collect()}
    score = scores.pop("", 0.0)
    best = max(families, key=lambda f: scores.get(f, 0.0))
    if scores.get(best, 0.0) > score:
        weights, score = {f: float(f == best) for f in families}, scores[best]
    return Blend(weights, {f: scores.get(f, 0.0) for f in families}, score)
