"""Feature vectors, out-of-fold training and scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col, numeric_columns
from sparkfeat.sources.checkpoints import stored

# Columns that are ids or the label and never features.
NOT_FEATURES = ("TARGET", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "index")


def feature_names(df: DataFrame, not_features: Sequence[str] = NOT_FEATURES) -> list[str]:
    return numeric_columns(df, not_features)


@dataclass(frozen=True)
class FeatureVectors:
    """Numeric features as one vector: missing cells take the train mean, with a flag beside it.

    Trees in Spark have no branch for missing values, so a 0/1 flag is added for every
    feature that has missing cells in the fitted rows.
    """

    features: tuple[str, ...]
    means: tuple[float, ...]
    flagged: tuple[str, ...]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str], flags: bool = True) -> FeatureVectors:
        aggregates = [F.count(F.lit(1)).alias("n")]
        for i, c in enumerate(features):
            aggregates += [F.avg(col(c)).alias(f"m{i}"), F.count(col(c)).alias(f"c{i}")]
        row = df.agg(*aggregates).first()
        means = tuple(float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(features)))
        flagged = tuple(c for i, c in enumerate(features) if flags and row[f"c{i}"] < row["n"])
        return FeatureVectors(tuple(features), means, flagged)

    @property
    def names(self) -> list[str]:
        return [*self.features, *[f"{c}__missing" for c in self.flagged]]

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and the vector column ``features``."""
        values = [
            F.coalesce(col(c).cast("double"), F.lit(m)).alias(f"__f{i}")
            for i, (c, m) in enumerate(zip(self.features, self.means, strict=True))
        ]
        flags = [col(c).isNull().cast("double").alias(f"__g{i}") for i, c in enumerate(self.flagged)]
        inputs = [f"__f{i}" for i in range(len(values))] + [f"__g{i}" for i in range(len(flags))]
        wide = df.select(*[col(k) for k in keep], *values, *flags)
        vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(wide)
        return vectors.select(*[col(k) for k in keep], "features")


def positive_probability() -> Column:
    return vector_to_array("probability")[1]


def fit_all(spark: SparkSession, jobs: Sequence[Callable[[], Any]], parallelism: int) -> list[Any]:
    """Run independent fits side by side, so that small ones share the cluster."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs)


@dataclass(frozen=True)
class FoldModels:
    """One model per fold, each fitted on the rows of the other folds."""

    models: tuple[Model, ...]
    names: tuple[str, ...]
    fold: str

    @staticmethod
    def fit(
        matrix: DataFrame, estimator: Estimator, k: int, fold: str, names: Sequence[str], parallelism: int = 2
    ) -> FoldModels:
        """``matrix`` holds ``label``, ``features`` and the fold column; persist it first."""

        def job(j: int) -> Callable[[], Model]:
            return lambda: estimator.fit(matrix.filter(col(fold) != j))

        models = fit_all(matrix.sparkSession, [job(j) for j in range(k)], parallelism)
        return FoldModels(tuple(models), tuple(names), fold)

    def out_of_fold(self, matrix: DataFrame, keep: Sequence[str], out: str = "prediction") -> DataFrame:
        """Predict every row with the model that has not seen it."""
        parts = []
        for j, model in enumerate(self.models):
            scored = model.transform(matrix.filter(col(self.fold) == j))
            parts.append(scored.select(*[col(c) for c in keep], col(self.fold), positive_probability().alias(out)))
        return reduce(DataFrame.unionByName, parts)

    def mean_prediction(self, matrix: DataFrame, keep: Sequence[str], out: str = "prediction") -> DataFrame:
        """Mean prediction of all fold models, for unlabelled rows or for bagged train scores."""
        scored = matrix.select(*[col(c) for c in keep], "features")
        for j, model in enumerate(self.models):
            scored = model.transform(scored).withColumn(f"__p{j}", positive_probability())
            scored = scored.drop("rawPrediction", "probability", "prediction")
        total = reduce(lambda a, b: a + b, [F.col(f"__p{j}") for j in range(len(self.models))])
        return scored.select(*[col(c) for c in keep], (total / len(self.models)).alias(out))

    def importance(self, matrix: DataFrame) -> DataFrame:
        """``(feature, importance, fold)`` rows, folds counted from 1."""
        rows = []
        for j, model in enumerate(self.models):
            for name, value in zip(self.names, importances(model), strict=True):
                rows.append((name, float(value), j + 1))
        return matrix.sparkSession.createDataFrame(rows, "feature string, importance double, fold int")


def importances(model: Model) -> list[float]:
    """Tree importances, or the size of the coefficients of a linear model."""
    if hasattr(model, "featureImportances"):
        return list(model.featureImportances.toArray())
    return [abs(x) for x in model.coefficients.toArray()]


@dataclass(frozen=True)
class EarlyStop:
    """How many boosting rounds are worth their while, and how it was found out."""

    rounds: int
    fitted: int
    losses: tuple[float, ...]
    models: tuple[Model, ...]


def early_stop(
    matrix: DataFrame, estimator: Estimator, k: int, fold: str, patience: int = 50, parallelism: int = 2
) -> EarlyStop:
    """The number of rounds with the lowest held-out log-loss, averaged over the folds.

    Forests grow in steps: a first one of twice the patience, then twice as many trees each
    time, until the best round lies ``patience`` rounds back or the estimator's own number
    of rounds is reached. So no more than about twice the rounds that were needed for the
    decision are fitted, however many were asked for. The metric is the log-loss, which
    Spark follows round by round in one pass over the held-out rows.
    """
    most = estimator.getMaxIter()
    fitted = min(most, max(2 * patience, 2))
    while True:
        grown = estimator.copy({estimator.maxIter: fitted})
        models = FoldModels.fit(matrix, grown, k, fold, [], parallelism).models
        losses = [m.evaluateEachIteration(matrix.filter(col(fold) == j)) for j, m in enumerate(models)]
        means = [sum(x) / k for x in zip(*losses, strict=True)]
        best = _best_round(means, patience)
        if best + patience <= fitted or fitted == most:
            return EarlyStop(best, fitted, tuple(means), models)
        fitted = min(most, 2 * fitted)


def _best_round(losses: Sequence[float], patience: int) -> int:
    """Number of the last improvement, the search ending where ``patience`` rounds bring none."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boosting_rounds(
    matrix: DataFrame, estimator: Estimator, k: int, fold: str, patience: int = 50, parallelism: int = 2
) -> int:
    """Number of trees with the lowest mean held-out loss over the folds, found by ``early_stop``."""
    return early_stop(matrix, estimator, k, fold, patience, parallelism).rounds


def fit_folds_early(
    matrix: DataFrame,
    estimator: Estimator,
    k: int,
    fold: str,
    names: Sequence[str],
    patience: int = 100,
    parallelism: int = 2,
) -> FoldModels:
    """Fold models at the best number of rounds; fitted anew only if more trees were grown than that."""
    stop = early_stop(matrix, estimator, k, fold, patience, parallelism)
    if stop.rounds == stop.fitted:
        return FoldModels(stop.models, tuple(names), fold)
    return FoldModels.fit(matrix, estimator.copy({estimator.maxIter: stop.rounds}), k, fold, names, parallelism)


def refit_score(
    estimator: Estimator, train: DataFrame, test: DataFrame, key: str, name: str
) -> DataFrame:
    """Fit on all of train and return ``(key, pred_<name>)`` for test."""
    model = estimator.fit(train)
    return model.transform(test).select(col(key), positive_probability().alias(f"pred_{name}"))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight positives so that both classes weigh the same in total."""
    share = df.agg(F.struct(F.avg(col(label).cast("double")).alias("p")).alias("s")).scalar().getField("p")
    weight = F.when(col(label) == 1, F.try_divide(1 - share, share)).otherwise(F.lit(1.0))
    return df.withColumn(out, weight)


def keep_matrix(df: DataFrame) -> DataFrame:
    """Store the training matrix: every fit reads it again, and it survives lost executors."""
    return stored(df)
