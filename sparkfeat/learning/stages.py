"""Ready-made stages: which parameters are searched after which, and around what.

Penalties on leaf weights are left out, since Spark's trees have none.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sparkfeat.learning.estimators import depth_for_leaves
from sparkfeat.learning.grids import Normal, Uniform, random_grid
from sparkfeat.learning.search import Params, Stage

# Starting points and coarse value lists of the two boosted-tree searches.
LEAFWISE_START = {
    "learning_rate": 0.1,
    "num_boost_round": 10000,
    "num_leaves": 31,
    "min_child_weight": 20,
    "max_depth": -1,
    "max_bin": 255,
    "bagging_fraction": 0.8,
    "feature_fraction": 0.8,
}
DEPTHWISE_START = {
    "learning_rate": 0.1,
    "n_estimators": 2000,
    "max_depth": 6,
    "min_child_weight": 1,
    "gamma": 0,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
}
LEAVES = [8, 32, 128, 512]
LEAF_CHILD_WEIGHTS = [1, 4, 7, 10, 13, 16, 19]
BINS = [8, 16, 32, 64, 128, 256, 512, 1024]
DEPTHS = [3, 5, 7, 9, 11, 13, 15, 17, 19]
DEPTH_CHILD_WEIGHTS = [1, 3, 5]
GAINS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4]
FRACTIONS = [0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
RATES = [0.001, 0.01, 0.05, 0.1, 0.5]
FINAL_ROUNDS = 1000
# Lists of the random stage, and the spread of its draws around the best fractions.
DRAWN_LISTS = {"max_depth": [8, 9, 10], "min_child_weight": [1, 2], "gamma": [1.1, 1.2, 1.3]}
DRAWN_SPREAD = 0.02
# Ranges of the wide random search over boosted trees. Spark has one least leaf size, so the
# narrower of the two ranges for it is left out.
WIDE_SPACE = {
    "max_bin": Uniform(2**3, 2**11, whole=True),
    "num_leaves": Uniform(2, 2**10, whole=True),
    "min_child_weight": Uniform(1, 60, whole=True),
    "learning_rate": Uniform(0.001, 0.5),
    "colsample_bytree": Uniform(0.2, 1),
    "max_depth": Uniform(5, 15, whole=True),
    "subsample": Uniform(0.2, 1),
    "min_split_gain": Uniform(0.01, 0.1),
}


# How far, and in what steps, the fine stages look around a coarse optimum.
FRACTION_REACH = (0.15, 0.10, 0.05)
LEAF_REACH = (0.20, 0.20, 0.02)
LEAF_CHILD_REACH, DEPTH_REACH, DEPTH_FINE_REACH = (1, 3), (2, 1), (1, 1)


def grid_around(centre: float, below: float, above: float, step: float, least: float, most: float) -> list[float]:
    """Evenly spaced values from ``centre - below`` to ``centre + above`` that lie in the range."""
    n = round((below + above) / step)
    values = (centre - below + i * step for i in range(n + 1))
    return sorted({round(v, 6) for v in values if least - 1e-9 <= v <= most + 1e-9})


def fractions_around(x: float) -> list[float]:
    """Sampling fractions near ``x``."""
    below, above, step = FRACTION_REACH
    return grid_around(x, below, above, step, step, 1.0)


def leaves_around(n: int) -> list[int]:
    """Leaf counts near ``n``, as a share of it."""
    below, above, step = (r * n for r in LEAF_REACH)
    return sorted({round(v) for v in grid_around(n, below, above, step, 2, 10 * n)})


def neighbours(n: int, below: int, above: int, least: int = 1) -> list[int]:
    return [int(v) for v in grid_around(n, below, above, 1, least, n + above)]


def depths_for(leaves: int) -> list[int]:
    """Depths near the least one that holds the leaves."""
    return neighbours(depth_for_leaves(leaves), *DEPTH_REACH, least=2)


def leafwise_stages() -> list[Stage]:
    """Rounds, leaves and child weight coarse then fine, depth, bins, fractions, rate."""
    return [
        Stage("rounds", rounds="num_boost_round", repeats=1),
        Stage("leaves", lambda b: {"num_leaves": LEAVES, "min_child_weight": LEAF_CHILD_WEIGHTS}),
        Stage(
            "leaves, fine",
            lambda b: {
                "num_leaves": leaves_around(b["num_leaves"]),
                "min_child_weight": neighbours(b["min_child_weight"], *LEAF_CHILD_REACH),
            },
        ),
        Stage("depth", lambda b: {"max_depth": depths_for(b["num_leaves"])}),
        Stage("bins", lambda b: {"max_bin": BINS}),
        Stage("fractions", lambda b: {"bagging_fraction": FRACTIONS, "feature_fraction": FRACTIONS}),
        Stage(
            "fractions, fine",
            lambda b: {
                "bagging_fraction": fractions_around(b["bagging_fraction"]),
                "feature_fraction": fractions_around(b["feature_fraction"]),
            },
        ),
        Stage("rate", lambda b: {"learning_rate": RATES, "num_boost_round": [FINAL_ROUNDS]}, rounds="num_boost_round"),
    ]


def depthwise_stages(spark: SparkSession, draws: int = 100, seed: int = 1) -> list[Stage]:
    """Rounds, depth and child weight coarse then fine, gain, fractions, random draws, rate."""
    return [
        Stage("rounds", rounds="n_estimators", repeats=1),
        Stage("depth", lambda b: {"max_depth": DEPTHS, "min_child_weight": DEPTH_CHILD_WEIGHTS}),
        Stage(
            "depth, fine",
            lambda b: {
                "max_depth": neighbours(b["max_depth"], *DEPTH_FINE_REACH),
                "min_child_weight": neighbours(b["min_child_weight"], *DEPTH_FINE_REACH),
            },
        ),
        Stage("gain", lambda b: {"gamma": GAINS}),
        Stage("fractions", lambda b: {"subsample": FRACTIONS, "colsample_bytree": FRACTIONS}),
        Stage(
            "fractions, fine",
            lambda b: {
                "subsample": fractions_around(b["subsample"]),
                "colsample_bytree": fractions_around(b["colsample_bytree"]),
            },
        ),
        Stage("random", candidates=lambda b: random_around(spark, b, draws, seed)),
        Stage("rate", lambda b: {"learning_rate": RATES, "n_estimators": [FINAL_ROUNDS]}, rounds="n_estimators"),
    ]


def random_around(spark: SparkSession, best: Params, draws: int, seed: int) -> list[Params]:
    """Random draws near the best fractions, with a few depths, child weights and gains."""
    near = {name: Normal(best[name], DRAWN_SPREAD, low=0.01, high=1.0) for name in ("subsample", "colsample_bytree")}
    space = {**DRAWN_LISTS, **near}
    return [{**best, **row.asDict()} for row in random_grid(spark, space, draws, seed).collect()]


def wide_random_stage(spark: SparkSession, draws: int = 1000, seed: int = 1) -> Stage:
    """Random search over wide ranges, in place of a search guided by a surrogate model."""

    def candidates(best: Params) -> list[Params]:
        return [{**best, **row.asDict()} for row in random_grid(spark, WIDE_SPACE, draws, seed).collect()]

    return Stage("wide random", candidates=candidates)
