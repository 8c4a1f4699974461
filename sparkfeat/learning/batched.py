"""Logistic fits of all candidates, folds and repeats together: one pass over the rows an iteration."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.learning.search import Scored
from sparkfeat.operators.evaluate import best_row, score_table
from sparkfeat.sources.checkpoints import stored

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Halvings of a step that has raised the loss, after which a fit ends where it is.
HALVINGS = 30


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))


@dataclass
class BatchedFits:
    """Coefficients, the intercept last, of every candidate, repeat and fold; each fit left out the rows of its fold."""

    candidates: list[dict[str, Any]]
    repeats: int
    folds: int
    coefficients: np.ndarray  # (candidate, repeat, fold, feature)
    passes: int

    def out_of_fold(self, matrix: DataFrame, key: str) -> DataFrame:
        """``candidate, repeat, fold, key, label, pred``: each row scored by the fits that have not seen it, in one pass."""
        beta, repeats = self.coefficients, self.repeats
        width = beta.shape[-1] - 1

        @F.arrow_udf("array<double>")
        def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for features, folds in batches:
                x = np.column_stack([_matrix(features, width), np.ones(len(features))])
                own = _matrix(folds, repeats).astype(np.int64)
                out = np.stack([_probability((x * beta[c, r, own[:, r]]).sum(1)) for c in range(len(beta)) for r in range(repeats)], axis=1)
                ends = np.arange(len(features) + 1, dtype=np.int32) * out.shape[1]
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

        folds = F.array(*[col(f"fold_{r}").cast("int") for r in range(repeats)])
        rows = matrix.select(col(key), "label", vector_to_array("features").alias("x"), folds.alias("folds"))
        each = rows.select(col(key), "label", "folds", F.posexplode(score("x", "folds")).alias("at", "pred"))
        repeat = (F.col("at") % repeats).cast("int")
        return each.select(
            (F.col("at") / repeats).cast("int").alias("candidate"), repeat.alias("repeat"), F.get("folds", repeat).alias("fold"), col(key), "label", "pred"
        )


def fit_logistic_many(matrix: DataFrame, candidates: Sequence[Mapping[str, Any]], folds: int, repeats: int = 1, max_iter: int = 50, tol: float = 1e-8) -> BatchedFits:
    """Newton steps of all fits at once on ``matrix``: ``label``, ``features``, ``fold_0`` to ``fold_<repeats - 1>``.

    A candidate's ``C`` weighs the summed loss against half the squared coefficients (not the
    intercept's). A pass sums, for every fit that is still going on, the loss, the gradient and
    the curvature over the rows outside its fold; they are added up in Spark and each fit's step
    is solved in a task, so one row of coefficients per fit comes to the driver. A step that
    raises the loss is halved. ``max_iter`` of a candidate, if given, bounds its steps.
    """
    specs = [(c, r, j) for c in range(len(candidates)) for r in range(repeats) for j in range(folds)]
    first = matrix.select(F.size(vector_to_array("features")).alias("n")).first()
    width = first["n"] if first else 0
    penalty = np.array([1.0 / float(candidates[c].get("C", 1.0)) for c, _, _ in specs])
    steps_left = np.array([int(candidates[c].get("max_iter", max_iter)) for c, _, _ in specs])
    shrink = np.append(np.ones(width), 0.0)
    beta, step, loss, halved = np.zeros((len(specs), width + 1)), np.zeros((len(specs), width + 1)), np.full(len(specs), np.inf), np.zeros(len(specs), int)
    rows = matrix.select("label", vector_to_array("features").alias("x"), F.array(*[col(f"fold_{r}").cast("int") for r in range(repeats)]).alias("folds"))
    going, passes = list(range(len(specs))) if width else [], 0
    spark = matrix.sparkSession
    while going:
        shared = spark.sparkContext.broadcast((np.array(going), beta[going], [specs[m][1:] for m in going]))
        solved = {r["model"]: r for r in _solve(_sums(rows, shared, width, repeats), shared, {m: penalty[m] for m in going}, width).collect()}
        passes += 1
        still = []
        for m in going:
            if m not in solved:
                continue
            now = solved[m]["loss"] + 0.5 * penalty[m] * float(((beta[m] * shrink) ** 2).sum())
            if now > loss[m] * (1 + 1e-12) and halved[m] < HALVINGS:  # go back half of the way
                step[m] /= 2
                beta[m] -= step[m]
                halved[m] += 1
                still.append(m)
                continue
            loss[m], halved[m], step[m] = now, 0, np.array(solved[m]["step"])
            if steps_left[m] > 0 and np.abs(step[m]).max() > tol:
                beta[m] += step[m]
                steps_left[m] -= 1
                still.append(m)
        going = still
        shared.destroy()
    shape = (len(candidates), repeats, folds, width + 1)
    return BatchedFits([dict(c) for c in candidates], repeats, folds, beta.reshape(shape), passes)


def _twins(beta: np.ndarray, left_out: Sequence[tuple[int, int]]) -> list[int]:
    """Of each fit the first one that stands at the same point on the same rows, as all candidates do at first."""
    known: dict[tuple, int] = {}
    return [known.setdefault((r, j, beta[m].tobytes()), m) for m, (r, j) in enumerate(left_out)]


def _sums(rows: DataFrame, shared, width: int, repeats: int) -> DataFrame:
    """``model, place, value``: the loss (place 0), the gradient and the upper half of the curvature of every fit."""
    upper = np.triu_indices(width + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, beta, left_out = shared.value
        total = np.zeros((len(models), 1 + (width + 1)))
        curvature = np.zeros((len(models), width + 1, width + 1))
        twin = _twins(beta, left_out)
        for batch in batches:
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.column_stack([_matrix(batch.column("x"), width), np.ones(len(y))])
            own = _matrix(batch.column("folds"), repeats)
            for r, j in dict.fromkeys(left_out):  # the rows of a fold's fits are cut out once
                use = own[:, r] != j
                a, t = x[use], y[use]
                for m in (m for m, rest in enumerate(left_out) if rest == (r, j) and twin[m] == m):
                    z = a @ beta[m]
                    p = _probability(z)
                    total[m, 0] += (np.logaddexp(0, z) - t * z).sum()
                    total[m, 1:] += (p - t) @ a
                    weighted = a * np.sqrt(p * (1 - p))[:, None]
                    curvature[m] += weighted.T @ weighted  # one factor twice: half of the products
        total = np.column_stack([total, curvature[:, upper[0], upper[1]]])[twin]
        n = total.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(models, n).astype(np.int32)), pa.array(np.tile(np.arange(n), len(models)).astype(np.int32)), pa.array(total.ravel())],
            names=["model", "place", "value"],
        )

    return rows.mapInArrow(add, "model int, place int, value double").groupBy("model", "place").agg(F.sum("value").alias("value"))


def _solve(sums: DataFrame, shared, penalty: Mapping[int, float], width: int) -> DataFrame:
    """``model, loss, step``: the loss without its penalty, and the Newton step of each fit."""
    upper = np.triu_indices(width + 1)

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        model = int(frame["model"].iloc[0])
        models, beta, _ = shared.value
        own = beta[int(np.flatnonzero(models == model)[0])]
        values = np.zeros(1 + (width + 1) + len(upper[0]))
        values[frame["place"].to_numpy()] = frame["value"].to_numpy()
        shrink = np.append(np.full(width, penalty[model]), 0.0)
        curvature = np.zeros((width + 1, width + 1))
        curvature[upper] = values[width + 2 :]
        curvature = curvature + np.triu(curvature, 1).T + np.diag(shrink + 1e-12)
        step = np.linalg.lstsq(curvature, -(values[1 : width + 2] + shrink * own), rcond=None)[0]
        return pd.DataFrame({"model": [model], "loss": [values[0]], "step": [step]})

    return sums.groupBy("model").applyInPandas(solve, "model int, loss double, step array<double>")


def score_logistic_many(matrix: DataFrame, key: str, candidates: Sequence[Mapping[str, Any]], folds: int, repeats: int = 1) -> Scored:
    """Score all candidates by repeated cross-validation; rows are read once an iteration, however many fits there are."""
    fits = fit_logistic_many(matrix, candidates, folds, repeats)
    predictions = stored(fits.out_of_fold(matrix, key))
    table = stored(score_table(predictions, key, "label", "candidate", "repeat", "fold", "pred"))
    top = best_row(table, "candidate").first()["candidate"]
    best = predictions.filter(F.col("candidate") == top).groupBy(col(key)).agg(F.avg("pred").alias("pred"))
    return Scored({i: dict(c) for i, c in enumerate(candidates)}, table, dict(candidates[top]), best)
