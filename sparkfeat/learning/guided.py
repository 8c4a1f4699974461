"""Search guided by a surrogate: the next candidates are those most likely to improve on the best."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.learning.grids import random_grid

Params = dict[str, Any]
TREES, POOL = 30, 500
#: Least spread of the surrogate's trees, so that equal answers do not divide by zero.
LEAST_SPREAD = 1e-6


@dataclass(frozen=True)
class Trial:
    number: int
    params: Params
    score: float
    chance: float | None


@dataclass(frozen=True)
class Guided:
    """Every trial in order; those of the first batch were drawn at random and have no ``chance``."""

    trials: list[Trial]

    @property
    def best(self) -> Trial:
        return max(self.trials, key=lambda t: (t.score, -t.number))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t.number, ", ".join(f"{k}={v}" for k, v in t.params.items()), float(t.score), t.chance) for t in self.trials]
        return spark.createDataFrame(rows, "trial int, params string, score double, chance double")


def _numbers(df: DataFrame, space: Mapping[str, Any]) -> DataFrame:
    """The parameters as a vector: listed values by their place in the list."""
    out = df
    for i, (name, values) in enumerate(space.items()):
        x = F.col(name)
        if isinstance(values, (list, tuple)):
            x = sum([F.when(F.col(name) == v, F.lit(float(k))).otherwise(F.lit(0.0)) for k, v in enumerate(values)], F.lit(0.0))
        out = out.withColumn(f"__x{i}", x.cast("double"))
    return VectorAssembler(inputCols=[f"__x{i}" for i in range(len(space))], outputCol="features").transform(out)


def next_batch(spark: SparkSession, space: Mapping[str, Any], trials: Sequence[Trial], size: int, pool: int, seed: int) -> list[tuple[Params, float]]:
    """The ``size`` drawn candidates with the greatest probability of improvement, and that probability.

    A forest is fitted to the scores so far. The mean and spread of its trees' answers to a
    drawn candidate are taken as those of a normal variable.
    """
    drawn = random_grid(spark, space, pool, seed)
    schema = drawn.select(*space).withColumn("label", F.lit(0.0)).schema
    known = spark.createDataFrame([(*(t.params[n] for n in space), float(t.score)) for t in trials], schema)
    forest = RandomForestRegressor(numTrees=TREES, maxDepth=6, minInstancesPerNode=1, featureSubsetStrategy="all", seed=seed).fit(_numbers(known, space))
    rows = _numbers(drawn, space)
    for i, tree in enumerate(forest.trees):
        rows = tree.setPredictionCol(f"__p{i}").transform(rows)
    answers = F.array(*[F.col(f"__p{i}") for i in range(len(forest.trees))])
    n = len(forest.trees)
    mean = F.aggregate(answers, F.lit(0.0), lambda s, x: s + x) / n
    square = F.aggregate(answers, F.lit(0.0), lambda s, x: s + x * x) / n
    best = max(t.score for t in trials)
    rows = rows.withColumns({"__mean": mean, "__spread": F.greatest(F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))), F.lit(LEAST_SPREAD))})
    rows = rows.withColumn("__z", (F.col("__mean") - best) / F.col("__spread")).dropDuplicates(list(space))
    top = rows.orderBy(F.desc("__z"), F.desc("__spread"), *space).limit(size).collect()
    return [({n: r[n] for n in space}, 0.5 * (1 + math.erf(r["__z"] / math.sqrt(2)))) for r in top]


def guided_search(
    spark: SparkSession, space: Mapping[str, Any], score: Callable[[list[Params]], Sequence[float]], first: int, batches: int, size: int, pool: int = POOL, seed: int = 1
) -> Guided:
    """``first`` random trials, then ``batches`` of ``size`` trials where an improvement is most likely.

    ``score`` gives one number per candidate, the greater the better, and may score a batch in one pass.
    """
    params = [{n: r[n] for n in space} for r in random_grid(spark, space, first, seed).collect()]
    trials = [Trial(i, p, float(s), None) for i, (p, s) in enumerate(zip(params, score(params)))]
    for b in range(batches):
        chosen = next_batch(spark, space, trials, size, pool, seed + b + 1)
        scores = score([p for p, _ in chosen])
        trials += [Trial(len(trials) + i, p, float(s), c) for i, ((p, c), s) in enumerate(zip(chosen, scores))]
    return Guided(trials)
