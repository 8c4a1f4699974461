"""Model families and the translation of their usual parameter names to Spark ML."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from typing import Any

from pyspark.ml.classification import GBTClassifier, LogisticRegression

# The parameter names of boosted-tree libraries, with their Spark ML counterparts.
GBT_PARAMS = {
    "learning_rate": "stepSize",
    "n_estimators": "maxIter",
    "num_boost_round": "maxIter",
    "max_depth": "maxDepth",
    "max_bin": "maxBins",
    "subsample": "subsamplingRate",
    "bagging_fraction": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "feature_fraction": "featureSubsetStrategy",
    "min_data_in_leaf": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode",
    "min_child_weight": "minInstancesPerNode",
    "min_split_gain": "minInfoGain",
    "gamma": "minInfoGain",
}

# Parameters that name a choice Spark ML does not have.
WITHOUT_COUNTERPART = {
    "boosting",
    "boosting_type",
    "device",
    "is_unbalance",
    "lambda_l1",
    "lambda_l2",
    "metric",
    "nthread",
    "n_jobs",
    "objective",
    "reg_alpha",
    "reg_lambda",
    "scale_pos_weight",
    "silent",
    "subsample_freq",
    "verbose",
}

MAX_DEPTH = 30
#: Least and greatest values of the whole-number settings.
WHOLE = {
    "maxIter": (1, 2**31 - 1),
    "maxBins": (2, 2**31 - 1),
    "minInstancesPerNode": (1, 2**31 - 1),
    "maxDepth": (0, MAX_DEPTH),
}


def depth_for_leaves(leaves: int) -> int:
    """Smallest depth of a level-wise tree that can hold the leaves."""
    return max(1, math.ceil(math.log2(leaves)))


def gbt(params: Mapping[str, Any], weight: str | None = None, seed: int = 1) -> GBTClassifier:
    """Boosted trees.

    ``num_leaves`` bounds the depth together with ``max_depth``: Spark grows level by level,
    so the depth is the smaller of ``max_depth`` and the least depth that holds the leaves.
    Parameters without a counterpart are reported and left out; class weights come in
    through the ``weight`` column. Two names for the same setting, and values that Spark
    cannot take, are errors.
    """
    args: dict[str, Any] = {"seed": seed, "featuresCol": "features", "labelCol": "label", "maxMemoryInMB": 1024}
    params = dict(params)
    leaves = params.pop("num_leaves", None)
    if params.get("max_depth", 1) <= 0:
        params.pop("max_depth")
    if leaves is not None:
        params["max_depth"] = min(int(params.get("max_depth", MAX_DEPTH)), depth_for_leaves(int(leaves)))
    ignored = sorted(set(params) & WITHOUT_COUNTERPART)
    if ignored:
        warnings.warn(f"boosted trees on Spark have no counterpart for {ignored}", stacklevel=2)
    for name, value in params.items():
        if name in WITHOUT_COUNTERPART:
            continue
        if name not in GBT_PARAMS:
            raise ValueError(f"unknown boosted-tree parameter {name!r}")
        target = GBT_PARAMS[name]
        if target in args:
            raise ValueError(f"{name!r} sets {target}, which another parameter has set already")
        args[target] = _value(name, target, value)
    if weight is not None:
        args["weightCol"] = weight
    return GBTClassifier(**args)


def _value(name: str, target: str, value: Any) -> Any:
    """A parameter's value as Spark takes it; whole numbers are rounded down."""
    if target in WHOLE:
        low, high = WHOLE[target]
        if not low <= int(value) <= high:
            raise ValueError(f"{name} must be from {low} to {high}, not {value}")
        return int(value)
    if target == "featureSubsetStrategy":
        return "all" if float(value) >= 1 else str(float(value))
    if target == "subsamplingRate" and not 0 < float(value) <= 1:
        raise ValueError(f"{name} must be above 0 and at most 1, not {value}")
    return float(value)


def logistic(params: Mapping[str, Any], n_rows: int, weight: str | None = None) -> LogisticRegression:
    """Logistic regression with ``C`` as inverse strength of the penalty on unscaled features.

    ``C`` weighs the summed loss, Spark's ``regParam`` the mean loss, hence ``n_rows``.
    """
    params = dict(params)
    penalty = params.pop("penalty", "l2")
    strength = params.pop("C", 1.0)
    args: dict[str, Any] = {
        "featuresCol": "features",
        "labelCol": "label",
        "maxIter": int(params.pop("max_iter", 100)),
        "tol": float(params.pop("tol", 1e-4)),
        "fitIntercept": bool(params.pop("fit_intercept", True)),
        "elasticNetParam": {"l2": 0.0, "l1": 1.0}[penalty],
        "regParam": 1.0 / (float(strength) * max(n_rows, 1)),
        "standardization": False,
    }
    unknown = set(params) - WITHOUT_COUNTERPART - {"random_state", "solver"}
    if unknown:
        raise ValueError(f"unknown logistic parameters {sorted(unknown)}")
    if weight is not None:
        args["weightCol"] = weight
    return LogisticRegression(**args)
