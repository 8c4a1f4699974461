"""Parameter tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col


@dataclass(frozen=True)
class Normal:
    """Normal distribution to draw a parameter from, kept inside ``[low, high]`` where given."""

    loc: float
    scale: float
    low: float | None = None
    high: float | None = None

    def column(self, seed: int) -> Column:
        return _clamp(F.lit(float(self.loc)) + F.lit(float(self.scale)) * F.randn(seed), self.low, self.high)


@dataclass(frozen=True)
class Uniform:
    """Uniform distribution over ``[low, high)``; ``whole`` rounds down to whole numbers."""

    low: float
    high: float
    whole: bool = False

    def column(self, seed: int) -> Column:
        x = F.lit(float(self.low)) + F.lit(float(self.high - self.low)) * F.rand(seed)
        return F.floor(x).cast("int") if self.whole else x


def _clamp(x: Column, low: float | None, high: float | None) -> Column:
    if low is not None:
        x = F.greatest(x, F.lit(float(low)))
    return x if high is None else F.least(x, F.lit(float(high)))


def expand_grid(spark: SparkSession, values: Mapping[str, Sequence]) -> DataFrame:
    """One row per combination of the listed values, the last parameter varying fastest."""
    grid = spark.range(1)
    for name, options in values.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in options])))
    return grid.select(*[col(n) for n in values])


def random_grid(
    spark: SparkSession, space: Mapping[str, Sequence | Normal | Uniform], n: int = 10, seed: int = 1
) -> DataFrame:
    """``n`` rows of random draws: from a list each value alike, else from the distribution."""
    columns = []
    for i, (name, options) in enumerate(space.items()):
        if isinstance(options, (Normal, Uniform)):
            value = options.column(seed + i)
        elif isinstance(options, (list, tuple, range)):
            place = F.floor(F.rand(seed + i) * len(options)).cast("int") + 1
            value = F.element_at(F.array(*[F.lit(v) for v in options]), place)
        else:
            raise TypeError(f"parameter {name}: expected a list of values or a distribution, got {type(options)}")
        columns.append(value.alias(name))
    # one partition, so that the draws follow the seed whatever the cluster's parallelism
    return spark.range(0, n, 1, 1).select(*columns)
