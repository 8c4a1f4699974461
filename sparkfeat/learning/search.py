"""Parameter search: repeated cross-validation, best candidate, staged search."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from typing import Any
from uuid import uuid4

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.learning.training import FoldModels, boosting_rounds, fit_all
from sparkfeat.operators.evaluate import best_row, score_table, stratified_folds
from sparkfeat.sources.checkpoints import ensure_checkpoint_dir, stored

Params = dict[str, Any]
Factory = Callable[[Params], Estimator]


def with_repeated_folds(df: DataFrame, key: str, label: str, folds: int, repeats: int) -> DataFrame:
    """Add one stratified fold column ``fold_<r>`` per repeat, with the repeat as its seed.

    Rows are ranked on key and label alone, and the wide rows are joined once, by their
    unique key. Rows without a key get no fold.
    """
    narrow = df.select(col(key), col(label))
    for r in range(repeats):
        narrow = stratified_folds(narrow, key, label, folds, r, f"fold_{r}")
    return df.join(stored(narrow).drop(label), key, "left").select(*[col(c) for c in df.columns], *[f"fold_{r}" for r in range(repeats)])


def combinations(grid: Mapping[str, Sequence]) -> list[Params]:
    """The candidates of a grid, which are few: each of them stands for whole model fits."""
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


@dataclass(frozen=True)
class Search:
    """What every stage shares: the kept matrix, the model family and the fold layout.

    ``matrix`` has the key, ``label``, ``features`` and columns ``fold_0`` to
    ``fold_<repeats - 1>``; persist it before searching.
    """

    matrix: DataFrame
    key: str
    factory: Factory
    folds: int = 5
    repeats: int = 5
    parallelism: int = 2

    def predictions(self, candidate: int, params: Params, repeats: int) -> DataFrame:
        """Out-of-fold predictions of one candidate, all repeats; with fewer repeats than may run side by side, folds do too."""
        side_by_side = max(1, self.parallelism // repeats)

        def job(r: int) -> Callable[[], FoldModels]:
            return lambda: FoldModels.fit(self.matrix, self.factory(params), self.folds, f"fold_{r}", [], side_by_side)

        fitted = fit_all(self.matrix.sparkSession, [job(r) for r in range(repeats)], self.parallelism)
        parts = []
        for r, models in enumerate(fitted):
            scored = models.out_of_fold(self.matrix, [self.key, "label"], "pred")
            parts.append(
                scored.select(
                    F.lit(candidate).alias("candidate"),
                    F.lit(r).alias("repeat"),
                    col(f"fold_{r}").alias("fold"),
                    col(self.key),
                    "label",
                    "pred",
                )
            )
        return reduce(DataFrame.unionByName, parts)

    def score(self, candidates: Sequence[Params], repeats: int | None = None) -> Scored:
        """Score every candidate; those that are the same model to Spark are fitted once.

        One candidate is fitted at a time and its predictions go to the shared folder before
        the next, so neither models nor plans pile up, however many candidates there are.
        """
        spark = self.matrix.sparkSession
        tried = self.different(candidates)
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/search-{uuid4().hex}"
        for i, p in tried.items():
            self.predictions(i, p, repeats or self.repeats).write.mode("append").parquet(path)
        kept = spark.read.parquet(path)
        table = stored(score_table(kept, self.key, "label", "candidate", "repeat", "fold", "pred"))
        top = best_row(table, "candidate").first()["candidate"]
        best = kept.filter(F.col("candidate") == top).groupBy(col(self.key)).agg(F.avg("pred").alias("pred"))
        return Scored(tried, table, dict(candidates[top]), best, len(candidates) - len(tried))

    def different(self, candidates: Sequence[Params]) -> dict[int, Params]:
        """Candidates by number, without those whose translated settings have occurred before."""
        seen: set[tuple] = set()
        out = {}
        for i, p in enumerate(candidates):
            made = self.factory(p)
            settings = tuple(sorted((k.name, str(v)) for k, v in made.extractParamMap().items()))
            if settings not in seen:
                seen.add(settings)
                out[i] = dict(p)
        return out


@dataclass(frozen=True)
class Scored:
    """Candidates by number with their score table, the best one, and its averaged predictions.

    ``repeated`` counts the candidates left out because an earlier one is the same model.
    """

    candidates: dict[int, Params]
    table: DataFrame
    best: Params
    best_predictions: DataFrame
    repeated: int = 0

    def report(self) -> DataFrame:
        """One row per candidate that was fitted: its parameters as text and its scores."""
        rows = [(i, ", ".join(f"{k}={v}" for k, v in p.items())) for i, p in self.candidates.items()]
        names = self.table.sparkSession.createDataFrame(rows, "candidate int, params string")
        return names.join(self.table, "candidate")


@dataclass(frozen=True)
class Stage:
    """One step of a staged search: a grid around the best parameters so far.

    ``grid`` returns the parameters to vary; all others stay at their best value.
    ``candidates`` may be given instead, to draw them at random. With ``rounds`` the
    boosting rounds of each candidate are chosen first, ``rounds`` naming the parameter.
    """

    name: str
    grid: Callable[[Params], Mapping[str, Sequence]] = field(default=lambda best: {})
    candidates: Callable[[Params], list[Params]] | None = None
    rounds: str | None = None
    repeats: int | None = None


@dataclass(frozen=True)
class StageResult:
    name: str
    scored: Scored


def staged_search(search: Search, stages: Sequence[Stage], start: Params) -> list[StageResult]:
    """Search one group of parameters after the other, freezing the best before going on."""
    best = dict(start)
    results = []
    for stage in stages:
        if stage.candidates is not None:
            candidates = stage.candidates(best)
        else:
            candidates = combinations({**{k: [v] for k, v in best.items()}, **stage.grid(best)})
        if stage.rounds is not None:
            candidates = [
                {
                    **p,
                    stage.rounds: boosting_rounds(
                        search.matrix, search.factory(p), search.folds, "fold_0", parallelism=search.parallelism
                    ),
                }
                for p in candidates
            ]
        scored = search.score(candidates, stage.repeats)
        best = dict(scored.best)
        results.append(StageResult(stage.name, scored))
    return results
