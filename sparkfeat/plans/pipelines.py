"""End to end: tables to features, folds, models, scores and written results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from sparkfeat.functions.columns import col, unique_names
from sparkfeat.learning.estimators import gbt
from sparkfeat.learning.search import (
    Factory,
    Search,
    Stage,
    StageResult,
    staged_search,
    with_repeated_folds,
)
from sparkfeat.learning.training import (
    FeatureVectors,
    class_weights,
    feature_names,
    fit_folds_early,
    keep_matrix,
    positive_probability,
)
from sparkfeat.operators.assemble import number_columns
from sparkfeat.operators.evaluate import kfold, roc_auc, stratified_folds, stratified_split
from sparkfeat.plans.formulas import formula_matrix
from sparkfeat.plans.selected import SELECTED, Variant, wide_matrix
from sparkfeat.sources.checkpoints import ensure_checkpoint_dir
from sparkfeat.sources.schemas import ENTITY_KEY, LABEL
from sparkfeat.sources.sinks import timestamped, write_importance, write_matrix, write_predictions
from sparkfeat.sources.tables import split_labelled

# Boosted-tree settings of the three pipelines.
SIMPLE_TREES = {
    "n_estimators": 10000,
    "learning_rate": 0.02,
    "num_leaves": 34,
    "colsample_bytree": 0.9497036,
    "subsample": 0.8715623,
    "max_depth": 8,
    "min_split_gain": 0.0222415,
    "min_child_weight": 39.3259775,
}
SELECTED_TREES = {
    "n_estimators": 10000,
    "learning_rate": 0.02,
    "num_leaves": 20,
    "colsample_bytree": 0.9497036,
    "subsample": 0.8715623,
    "max_depth": 8,
    "min_split_gain": 0.0222415,
    "min_child_weight": 60,
}
FORMULA_TREES = {
    "n_estimators": 4000,
    "learning_rate": 0.03,
    "num_leaves": 30,
    "colsample_bytree": 0.8,
    "subsample": 0.9,
    "max_depth": 7,
    "min_split_gain": 0.01,
    "min_child_weight": 100,
}
FOLD_SEED = 1001
FORMULA_FOLD_SEED = 42
HOLD_OUT_SHARE = 0.33
# Fixed value: rounds without improvement after which training stops.
PATIENCE = 100


@dataclass(frozen=True)
class CrossValidated:
    """What a cross-validated run gives: scored rows, AUCs, importances."""

    out_of_fold: DataFrame
    train_mean: DataFrame
    test: DataFrame
    fold_auc: DataFrame
    auc: DataFrame
    importance: DataFrame


def cross_validate(
    matrix: DataFrame,
    params: Mapping[str, Any],
    k: int = 5,
    stratified: bool = False,
    features: Sequence[str] | None = None,
    seed: int = FOLD_SEED,
    parallelism: int = 2,
    patience: int = PATIENCE,
    balanced: bool = False,
) -> CrossValidated:
    """Train on ``k - 1`` folds, predict the held-out fold, and average the models on test rows.

    The number of trees in ``params`` is the most that may be grown: training stops where the
    held-out loss has not improved for ``patience`` rounds, and predicts at the best round.
    With ``balanced`` both classes weigh the same in total.
    """
    ensure_checkpoint_dir(matrix.sparkSession)
    names = list(features) if features is not None else feature_names(matrix)
    train, test = split_labelled(matrix, LABEL)
    vectors = FeatureVectors.fit(train, names)
    rows = vectors.transform(train, [ENTITY_KEY, LABEL]).withColumnRenamed(LABEL, "label")
    if stratified:
        rows = stratified_folds(rows, ENTITY_KEY, "label", k, seed)
    else:
        rows = rows.withColumn("fold", kfold(ENTITY_KEY, k, seed))
    rows = keep_matrix(class_weights(rows, "label") if balanced else rows)
    trees = gbt(params, weight="weight" if balanced else None)
    models = fit_folds_early(rows, trees, k, "fold", vectors.names, patience, parallelism)
    own = keep_matrix(models.out_of_fold(rows, [ENTITY_KEY, "label"]))
    return CrossValidated(
        out_of_fold=own,
        train_mean=models.mean_prediction(rows, [ENTITY_KEY]),
        test=models.mean_prediction(vectors.transform(test, [ENTITY_KEY]), [ENTITY_KEY]),
        fold_auc=roc_auc(own, "label", "prediction", ["fold"]),
        auc=roc_auc(own, "label", "prediction"),
        importance=models.importance(rows),
    )


def run_wide(
    tables: Mapping[str, DataFrame],
    directory: str,
    variant: Variant = SELECTED,
    params: Mapping[str, Any] | None = None,
    k: int = 5,
    stratified: bool | None = None,
) -> CrossValidated:
    """Build the wide matrix, store it, cross-validate on the stored copy, write the results."""
    spark = tables["application"].sparkSession
    simple = not variant.full_application
    path = timestamped(directory, "matrix")
    wide = wide_matrix(tables, variant)
    # Parquet columns must differ in more than case
    wide = wide.toDF(*unique_names(wide.columns))
    write_matrix(wide, path)
    settings = params or (SIMPLE_TREES if simple else SELECTED_TREES)
    result = cross_validate(spark.read.parquet(path), settings, k, simple if stratified is None else stratified)
    write_results(result, directory)
    return result


def write_results(result: CrossValidated, directory: str) -> None:
    write_predictions(result.test, timestamped(directory, "test_predictions"), ENTITY_KEY, "prediction")
    write_predictions(result.train_mean, timestamped(directory, "train_predictions"), ENTITY_KEY, "prediction")
    write_importance(result.importance, timestamped(directory, "importance"))


def run_formulas(
    tables: Mapping[str, DataFrame],
    formulas: Mapping[str, str],
    directory: str,
    params: Mapping[str, Any] | None = None,
    k: int = 5,
    encode: Sequence[str] | None = None,
) -> CrossValidated:
    """Evaluate the formulas, store them, cross-validate on the stored copy, write the results."""
    spark = tables["application"].sparkSession
    path = timestamped(directory, "formulas")
    write_matrix(formula_matrix(tables, formulas, encode), path)
    result = cross_validate(spark.read.parquet(path), params or FORMULA_TREES, k, seed=FORMULA_FOLD_SEED)
    write_results(result, directory)
    return result


def hold_out(df: DataFrame, flag: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """The two sides of a marked split, without the mark."""
    return df.filter(col(flag) == 0).drop(flag), df.filter(col(flag) == 1).drop(flag)


@dataclass(frozen=True)
class SearchData:
    """Train vectors with repeated folds, held-out and unlabelled vectors, feature names."""

    train: DataFrame
    held_out: DataFrame
    unlabelled: DataFrame
    names: tuple[str, ...]


def prepare_search(
    features: DataFrame, folds: int = 5, repeats: int = 5, test_share: float = HOLD_OUT_SHARE, seed: int = 1
) -> SearchData:
    """Number the columns, hold out a stratified share of the labelled rows, add fold columns.

    ``features`` has one row per applicant and is read several times: store it first.
    """
    numbered = number_columns(features, [ENTITY_KEY, LABEL])
    labelled, unlabelled = split_labelled(numbered, LABEL)
    names = feature_names(numbered)
    train, held_out = hold_out(stratified_split(labelled, ENTITY_KEY, LABEL, test_share, seed))
    vectors = FeatureVectors.fit(train, names)
    keep = [ENTITY_KEY, LABEL]
    rows = vectors.transform(train, keep).withColumnRenamed(LABEL, "label")
    return SearchData(
        train=keep_matrix(with_repeated_folds(rows, ENTITY_KEY, "label", folds, repeats)),
        held_out=vectors.transform(held_out, keep).withColumnRenamed(LABEL, "label"),
        unlabelled=vectors.transform(unlabelled, [ENTITY_KEY]),
        names=tuple(vectors.names),
    )


@dataclass(frozen=True)
class Tuned:
    """Every stage's scores, the best parameters, and the refitted model's scores."""

    stages: list[StageResult]
    best: dict[str, Any]
    held_out_auc: DataFrame
    predictions: DataFrame


def run_search(
    features: DataFrame,
    directory: str,
    stages: Sequence[Stage],
    start: Mapping[str, Any],
    factory: Factory = gbt,
    folds: int = 5,
    repeats: int = 5,
    parallelism: int = 2,
) -> Tuned:
    """Search parameters stage by stage, refit the best on train, score the rest and write it.

    ``features`` is any labelled matrix, such as all features of the library.
    """
    data = prepare_search(features, folds, repeats)
    work = Search(data.train, ENTITY_KEY, factory, folds, repeats, parallelism)
    results = staged_search(work, stages, dict(start))
    best = results[-1].scored.best
    model = factory(best).fit(data.train)
    checked = model.transform(data.held_out).select(ENTITY_KEY, "label", positive_probability().alias("prediction"))
    scored = model.transform(data.unlabelled).select(ENTITY_KEY, positive_probability().alias("prediction"))
    write_predictions(scored, timestamped(directory, "tuned_predictions"), ENTITY_KEY, "prediction")
    return Tuned(results, best, roc_auc(checked, "label", "prediction"), scored)
