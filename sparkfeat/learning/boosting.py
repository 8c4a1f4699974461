"""Second-order boosted trees: binned rows, gradient histograms as one grouped sum, best leaf first.

Several models grow side by side, one per fold, each on the rows of the other folds: a pass
over the rows serves all of them. The rows lie packed in blocks beside the tasks, with their margin
under every model, and a pass is one job that plans no query (the tasks' part is in ``histograms.py``).
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from types import SimpleNamespace
from typing import Any

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col
from sparkfeat.learning import histograms as tasks
from sparkfeat.learning.histograms import MISSING, Walk
from sparkfeat.sources.checkpoints import stored

#: Gradients are whole multiples of 1 / UNIT, so that their sums are the same in any order.
UNIT = 1 << 24
#: Trees whose margins are computed on the way before the blocks get new margins.
PENDING = 4
#: Trees after which blocks are packed anew from the cells, which bounds their lineage; a draw of rows takes one bit of a long each.
PACKED = 60
#: Trees that one projection of a score evaluates.
SCORED = 25
#: Rows with different codes whose margins are sent to all tasks at most; more are joined by a shuffle.
SENT = 100_000
#: Cells of a partition, and of a range of scores.
CELLS = 100_000
#: Bytes of sums that all tasks of a pass send home at most; more are added up and searched in tasks.
HOME = 16 << 20
#: Relative error of the quantiles that become bin edges.
QUANTILE_ERROR = 10_000

# The usual parameter names of boosted-tree libraries and the setting that each of them means.
NAMES = {
    "n_estimators": "rounds",
    "num_boost_round": "rounds",
    "learning_rate": "rate",
    "num_leaves": "leaves",
    "max_depth": "depth",
    "max_bin": "bins",
    "lambda_l1": "l1",
    "reg_alpha": "l1",
    "lambda_l2": "l2",
    "reg_lambda": "l2",
    "min_child_weight": "least_hessian",
    "min_sum_hessian_in_leaf": "least_hessian",
    "min_data_in_leaf": "least_rows",
    "min_child_samples": "least_rows",
    "min_split_gain": "least_gain",
    "gamma": "least_gain",
    "feature_fraction": "column_share",
    "colsample_bytree": "column_share",
    "bagging_fraction": "row_share",
    "subsample": "row_share",
    "scale_pos_weight": "positive_weight",
    "is_unbalance": "balanced",
    "random_state": "seed",
    "seed": "seed",
}
# Parameters that say how a library runs, not what it fits.
NOT_ABOUT_THE_MODEL = {
    "boosting", "boosting_type", "bagging_freq", "device", "metric", "n_jobs", "nthread", "objective", "silent", "subsample_freq", "verbose",
}


@dataclass(frozen=True)
class Boosting:
    """Settings of boosted trees; ``of`` takes the usual names. A depth of 0 or less is no bound."""

    rounds: int = 100
    rate: float = 0.1
    leaves: int = 31
    depth: int = -1
    bins: int = 255
    l1: float = 0.0
    l2: float = 0.0
    least_hessian: float = 1e-3
    least_rows: int = 20
    least_gain: float = 0.0
    column_share: float = 1.0
    row_share: float = 1.0
    positive_weight: float = 1.0
    balanced: bool = False
    seed: int = 1

    @staticmethod
    def of(params: Mapping[str, Any]) -> Boosting:
        """Settings by their usual names; two names for one setting, and unknown ones, are errors."""
        out: dict[str, Any] = {}
        for name, value in params.items():
            if name in NOT_ABOUT_THE_MODEL:
                continue
            if name not in NAMES:
                raise ValueError(f"unknown boosted-tree parameter {name!r}")
            target = NAMES[name]
            if target in out:
                raise ValueError(f"{name!r} sets {target}, which another parameter has set already")
            out[target] = type(getattr(Boosting, target))(value)
        made = Boosting(**out)
        if made.rounds < 1 or made.leaves < 2 or not 2 <= made.bins <= 32_000:
            raise ValueError("boosting takes at least one round, two leaves and two bins, and at most 32,000 bins")
        if min(made.l1, made.l2, made.least_hessian, made.least_rows, made.least_gain) < 0 or made.positive_weight <= 0:
            raise ValueError("penalties and least sizes are not negative, and the positive weight is above 0")
        if not (0 < made.column_share <= 1 and 0 < made.row_share <= 1):
            raise ValueError("shares of columns and rows are above 0 and at most 1")
        return made


@dataclass(frozen=True)
class Binning:
    """Lower edges of each feature's bins; the first bin has none."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str], bins: int) -> Binning:
        """Up to ``bins`` bins per feature: one per value where there are few values, else between quantiles.

        One pass counts the values roughly and takes the quantiles of all features; a second
        one lists the values of those that have few.
        """
        numbers = {c: col(c).cast("double") for c in features}
        shares = [i / bins for i in range(1, bins)]
        aggregates = []
        for i, x in enumerate(numbers.values()):
            aggregates += [F.approx_count_distinct(x).alias(f"n{i}"), F.percentile_approx(x, shares, QUANTILE_ERROR).alias(f"q{i}")]
        row = df.agg(*aggregates).first() if features else {}
        few = [i for i in range(len(features)) if row[f"n{i}"] <= 1.5 * bins]
        values: dict[int, list[float]] = {i: [] for i in few}
        if few:
            pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), numbers[features[i]].alias("x")) for i in few])).alias("p")
            for r in df.select(pairs).select("p.i", "p.x").filter("x is not null").distinct().collect():
                values[r["i"]].append(r["x"])
        edges = []
        for i in range(len(features)):
            own = sorted(values[i]) if i in values and len(values[i]) <= bins else sorted(set(row[f"q{i}"] or []))
            edges.append(tuple(own[1:] if i in values and len(values[i]) <= bins else own))
        return Binning(tuple(features), tuple(edges))

    def codes(self, df: DataFrame, keep: Sequence[Column]) -> DataFrame:
        """``keep`` and ``codes``: the bin of every feature, and ``MISSING`` for a missing cell."""
        inf = float("inf")
        ins = [f"__x{i}" for i in range(len(self.features))]
        outs = [f"__b{i}" for i in range(len(self.features))]
        kept = [c.alias(f"__k{i}") for i, c in enumerate(keep)]
        names = [df.select(c).columns[0] for c in keep]
        wide = df.select(*kept, *[col(c).cast("double").alias(n) for c, n in zip(self.features, ins)])
        used = [i for i, e in enumerate(self.edges) if e]
        if used:
            splits = [[-inf, *self.edges[i], inf] for i in used]
            wide = Bucketizer(
                splitsArray=splits, inputCols=[ins[i] for i in used], outputCols=[outs[i] for i in used], handleInvalid="keep"
            ).transform(wide)
        def code(i: int) -> Column:
            bucket = F.col(outs[i]) if self.edges[i] else F.lit(0)
            return F.when(F.col(ins[i]).isNull() | F.isnan(ins[i]), F.lit(MISSING)).otherwise(bucket).cast("smallint")
        codes = F.array(*[code(i) for i in range(len(ins))]) if ins else F.array().cast("array<smallint>")
        return wide.select(*[F.col(f"__k{i}").alias(n) for i, n in enumerate(names)], codes.alias("codes"))


@dataclass
class Split:
    feature: int
    code: int
    missing_left: bool
    gain: float
    left: int
    right: int


@dataclass
class Tree:
    """Nodes by number, the root being 0: the splits that were taken and the value of every node."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)

    def steps(self) -> Walk:
        """What ``histograms.leaves`` follows, and the values of the nodes by number."""
        values = np.zeros(max(self.values) + 1)
        values[list(self.values)] = list(self.values.values())
        return {n: (p.feature, p.code, p.missing_left, p.left, p.right) for n, p in self.splits.items()}, values

    def paths(self) -> dict[int, str]:
        """The turns that lead to each node."""
        out = {0: ""}
        for node in self.splits:  # a node is split before its children are
            for child, turn in ((self.splits[node].left, "L"), (self.splits[node].right, "R")):
                out[child] = out[node] + turn
        return out

    def value_of(self) -> str:
        """SQL for the value of the leaf that ``codes`` lead to; one text is parsed far faster than a column is put together."""
        return self.walk(lambda node: _double(self.values[node]))

    def walk(self, at: Callable[[int], str], node: int = 0) -> str:
        """SQL that gives ``at`` of the node that ``codes`` lead to."""
        split = self.splits.get(node)
        if split is None:
            return at(node)
        return f"if({goes_left(split)}, {self.walk(at, split.left)}, {self.walk(at, split.right)})"


def _double(x: float) -> str:
    return f"{x!r}D"


def goes_left(split: Split) -> str:
    code = f"get(codes, {split.feature})"
    below = f"{code} <= {split.code}"
    return below if split.missing_left else f"({below} and {code} <> {MISSING})"


def _sum(first: str, trees: Sequence[Tree]) -> str:
    return " + ".join([first, *[t.value_of() for t in trees]])


@dataclass(frozen=True)
class Forest:
    """A margin to begin with and trees whose values are added to it."""

    base: float
    trees: tuple[Tree, ...]
    binning: Binning

    def margin(self, df: DataFrame, keep: Sequence[str], out: str = "margin") -> DataFrame:
        """``keep`` and the margin of every row; the rows are stored after so many trees, which bounds the plans."""
        rows = self.binning.codes(df, [col(k) for k in keep]).withColumn("__margin", F.lit(self.base))
        for start in range(0, len(self.trees), SCORED):
            if start:
                rows = stored(rows)
            rows = rows.withColumn("__margin", F.expr(_sum("__margin", self.trees[start : start + SCORED])))
        return rows.select(*[col(k) for k in keep], F.col("__margin").alias(out))

    def importance(self) -> dict[str, float]:
        """The gain of each feature's splits as a share of all gains."""
        gains = dict.fromkeys(self.binning.features, 0.0)
        for tree in self.trees:
            for split in tree.splits.values():
                gains[self.binning.features[split.feature]] += split.gain
        total = sum(gains.values())
        return {f: g / total if total else 0.0 for f, g in gains.items()}


def probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def leaf_weight(g: float, h: float, s: Boosting) -> float:
    pull = max(abs(g) - s.l1, 0.0)
    return -s.rate * math.copysign(pull, g) / (h + s.l2) if h + s.l2 > 0 else 0.0


@dataclass
class _Growing:
    """A tree on the way: for every node met, its best split (if any has a gain) and its sums."""

    known: dict[int, dict[str, Any] | None] = field(default_factory=dict)
    depth: dict[int, int] = field(default_factory=lambda: {0: 0})
    children: dict[int, tuple[int, int]] = field(default_factory=dict)
    sums: dict[int, tuple[float, float, int]] = field(default_factory=dict)

    def wanted(self, s: Boosting) -> tuple[set[int], list[int]]:
        """Nodes whose best split must be known to go on, and the splits taken so far, best leaf first.

        Each step splits the leaf of the largest gain (ties: the smaller number). A node that
        is split gets its children's numbers for good; children that could still be split
        are asked for all at once, so a tree takes about as many passes as it is deep.
        """
        if 0 not in self.known:
            return {0}, []
        heap: list[tuple[float, int]] = []
        asked: set[int] = set()
        taken: list[int] = []

        def push(node: int) -> None:
            if node in self.known:
                best = self.known[node]
                if best is not None:
                    heapq.heappush(heap, (-best["gain"], node))
            elif (s.depth <= 0 or self.depth[node] < s.depth) and self.sums[node][2] >= 2 * max(s.least_rows, 1):
                asked.add(node)

        push(0)
        while heap and len(taken) < s.leaves - 1:
            _, node = heapq.heappop(heap)
            taken.append(node)
            best = self.known[node]
            if node not in self.children:
                left = 2 * len(self.children) + 1
                self.children[node] = (left, left + 1)
                self.depth[left] = self.depth[left + 1] = self.depth[node] + 1
                self.sums[left] = (best["gl"], best["hl"], best["nl"])
                g, h, n = self.sums[node]
                self.sums[left + 1] = (g - best["gl"], h - best["hl"], n - best["nl"])
            if len(taken) < s.leaves - 1:
                for child in self.children[node]:
                    push(child)
        return asked, taken

    def tree(self, taken: Sequence[int], s: Boosting) -> Tree:
        out = Tree()
        for node in taken:
            best, (left, right) = self.known[node], self.children[node]
            out.splits[node] = Split(best["feature"], best["code"], bool(best["missing_left"]), best["gain"], left, right)
        for node in {0, *[c for n in taken for c in self.children[n]]}:
            g, h, n = self.sums[node]
            out.values[node], out.rows[node] = leaf_weight(g, h, s), n
        return out


class Booster:
    """Trees of ``k`` models over one stored frame of binned rows.

    ``rows`` has the key, ``label`` (null for rows to be scored only), ``fold`` and ``codes``.
    Trees grow over ``cells``: labelled rows that agree in all of these are one, with their
    number ``n``. All rows of a cell have the same gradients, which are whole numbers, so
    their sums are those over the rows. Only a drawn share of rows (``row_share``) needs the
    rows one by one. Model ``j`` learns from labelled rows whose fold is not ``j``; without
    folds there is one model that learns from all. Cells are packed into blocks with one margin
    per model, which are kept by the executors; lost ones are packed again from the cells.
    """

    def __init__(self, df: DataFrame, key: str, label: str, features: Sequence[str], settings: Boosting, folds: int = 0, fold: str | None = None) -> None:
        self.settings, self.key, self.k = settings, key, max(folds, 1)
        self.binning = Binning.fit(df.filter(col(label).isNotNull()), features, settings.bins)
        fold_of = F.lit(None).cast("int") if not folds else col(fold).cast("int")
        y = col(label).cast("double")
        rows = self.binning.codes(df, [col(key), y.alias("label"), fold_of.alias("fold")])
        self.rows = stored(rows.toDF("key", "label", "fold", "codes"))
        known = self.rows.filter("label is not null")
        if settings.row_share < 1:
            self.cells = known.withColumn("n", F.lit(1).cast("long"))
            self.size = self.cells.count()
        else:
            cells = stored(known.groupBy("label", "fold", "codes").agg(F.count(F.lit(1)).alias("n")))
            self.size = cells.count()
            # few rows would lie in one partition, which every pass reads
            self.cells = stored(cells.repartition(max(df.sparkSession.sparkContext.defaultParallelism, self.size // CELLS)))
        self.bases, self.weights = self._start(self.cells)
        self.trees: list[list[Tree]] = [[] for _ in range(self.k)]
        self.pending = 0
        self._packed: DataFrame | None = None  # the cells that the blocks were made of
        self._first = 0  # the number of trees then
        self._kept: list[RDD] = []  # the blocks, and before them those that they may be computed from

    def _start(self, cells: DataFrame) -> tuple[list[float], list[float]]:
        """The log-odds of each model's rows, and what a positive row weighs in it."""
        s = self.settings
        sums = []
        for j in range(self.k):
            n = F.when(F.expr(self._seen_sql(j)), F.col("n"))
            sums += [F.coalesce(F.sum(x), F.lit(0)).alias(f"{a}{j}") for a, x in (("p", F.when(F.col("label") > 0, n)), ("n", n))]
        row = cells.agg(*sums).first()
        bases, weights = [], []
        for j in range(self.k):
            pos, neg = row[f"p{j}"], row[f"n{j}"] - row[f"p{j}"]
            weight = neg / pos if s.balanced and pos and neg else s.positive_weight
            weights.append(float(weight))
            bases.append(math.log(pos * weight / neg) if pos and neg else 0.0)
        return bases, weights

    def _seen_sql(self, j: int) -> str:
        return f"label is not null and coalesce(fold <> {j}, true)"

    def steps(self) -> list[list[Walk]]:
        """Of every model the trees that the blocks' margins lack."""
        return [[t.steps() for t in own[len(own) - self.pending :]] for own in self.trees]

    def blocks(self) -> RDD:
        """The packed cells with the margins of all trees but the pending ones."""
        number = len(self.trees[0])
        if self._packed is not self.cells or number - self._first >= PACKED:
            self.release()
            frame = self.cells.filter("label is not null").select("label", "fold", "n", "codes", *self._draws(number))
            packed = frame.mapInArrow(tasks.packing(len(self.binning.features), self.bases), "block binary").rdd
            done = [[t.steps() for t in own[: number - self.pending]] for own in self.trees]
            self._kept.append(packed.map(tasks.unpacking(done)).persist(StorageLevel.MEMORY_AND_DISK))
            self._packed, self._first = self.cells, number
        return self._kept[-1]

    def _draws(self, number: int) -> list[Column]:
        """One bit for each of the next trees: whether a row is drawn for it."""
        s = self.settings
        if s.row_share >= 1:
            return []
        bound = int(s.row_share * (1 << 20))
        drawn = [F.pmod(F.xxhash64(F.lit(s.seed), F.lit(number + i), "key"), F.lit(1 << 20)) < bound for i in range(PACKED)]
        return [F.aggregate(F.array(*drawn), F.lit(0).cast("long"), lambda bits, one: F.shiftleft(bits, 1).bitwiseOR(one.cast("long"))).alias("draws")]

    def settle(self) -> None:
        """Blocks with the margins of all trees."""
        if self.pending and self._kept:
            self._kept.append(self._kept[-1].map(tasks.adding(self.steps())).persist(StorageLevel.MEMORY_AND_DISK))
            for old in self._kept[:-2]:  # the last but one is needed until a pass has made the last
                old.unpersist()
            self._kept = self._kept[-2:]
        self.pending = 0

    def release(self) -> None:
        """Give back the memory of the blocks; they are packed anew when they are needed again."""
        for blocks in self._kept:
            blocks.unpersist()
        self._kept, self._packed = [], None

    def grow(self, rounds: int = 1) -> None:
        """One more tree for every model, ``rounds`` times."""
        for _ in range(rounds):
            if self.pending >= PENDING:
                self.settle()
            for j, tree in enumerate(self._next_trees()):
                self.trees[j].append(tree)
            self.pending += 1

    def _next_trees(self) -> list[Tree]:
        s, number = self.settings, len(self.trees[0])
        n_all = len(self.binning.features)
        drawn = random.Random(s.seed * 1_000_003 + number).sample(range(n_all), max(1, round(s.column_share * n_all))) if n_all else []
        drawn = sorted(drawn)
        growing = [_Growing() for _ in range(self.k)]
        while True:
            state = [g.wanted(s) for g in growing]
            asked = {j: nodes for j, (nodes, _) in enumerate(state) if nodes}
            if not asked:
                return [g.tree(taken, s) for g, (_, taken) in zip(growing, state)]
            found = self._best_splits(growing, asked, drawn)
            for j, nodes in asked.items():
                for node in nodes:
                    r = found.get((j, node))
                    if node == 0:
                        growing[j].sums[0] = (r["g"], r["h"], r["n"]) if r else (0.0, 0.0, 0)
                    growing[j].known[node] = r if r and r["gain"] is not None else None

    def _best_splits(self, growing: Sequence[_Growing], asked: Mapping[int, set[int]], drawn: Sequence[int]) -> dict[tuple[int, int], dict[str, Any]]:
        """Of every asked (model, node) that has rows: its sums and its best split, if any is allowed."""
        blocks, s = self.blocks(), SimpleNamespace(**asdict(self.settings))
        nodes = {j: sorted(own) for j, own in asked.items()}
        unfinished = {}
        for j in asked:
            known = growing[j]
            splits = {n: (b["feature"], b["code"], bool(b["missing_left"]), *known.children[n]) for n, b in known.known.items() if b and n in known.children}
            unfinished[j] = (splits, nodes[j])
        widths = [len(e) + 2 for e in self.binning.edges]
        bit = PACKED - 1 - (len(self.trees[0]) - self._first) if s.row_share < 1 else None
        sums = blocks.mapPartitions(tasks.summing(self.steps(), unfinished, drawn, widths, self.weights, UNIT, bit))
        size = sum(map(len, nodes.values())) * sum(widths[f] for f in drawn) * 3 * 8
        if size * blocks.getNumPartitions() <= HOME:
            total: dict[int, np.ndarray] = {}
            for key, x in sums.collect():
                total[key] = total[key] + x if key in total else x
            return tasks.best_of(total.items(), nodes, drawn, s, UNIT)
        out: dict[tuple[int, int], dict[str, Any]] = {}
        whole = sums.reduceByKey(np.add, min(len(nodes) * len(drawn), blocks.context.defaultParallelism))
        for part in whole.mapPartitions(tasks.searching(nodes, drawn, s, UNIT)).collect():
            tasks.better(out, part)
        return out


@dataclass(frozen=True)
class Boosted:
    """Fitted models with the rows they scored: ``key, label, fold, margins``."""

    forests: tuple[Forest, ...]
    rows: DataFrame
    key: str
    scores: tuple[float, ...] = ()

    def out_of_fold(self, out: str = "prediction") -> DataFrame:
        """Labelled rows, each scored by the model that has not seen it."""
        own = probability(F.get("margins", F.col("fold")))
        return self.rows.filter("label is not null and fold is not null").select(F.col("key").alias(self.key), "label", "fold", own.alias(out))

    def mean_prediction(self, out: str = "prediction", unlabelled_only: bool = False) -> DataFrame:
        """All rows, or those without a label, with the mean prediction of all models."""
        n = len(self.forests)
        mean = sum([probability(F.get("margins", F.lit(j))) for j in range(n)], F.lit(0.0)) / n
        rows = self.rows.filter("label is null") if unlabelled_only else self.rows
        return rows.select(F.col("key").alias(self.key), mean.alias(out))

    def importance(self) -> DataFrame:
        """``(feature, importance, fold)``, folds counted from 1; importances of a fold add up to 1."""
        rows = [(f, x, j + 1) for j, forest in enumerate(self.forests) for f, x in forest.importance().items()]
        return self.rows.sparkSession.createDataFrame(rows, "feature string, importance double, fold int")

    def nodes(self) -> DataFrame:
        """Every node of every tree: the turns (L, R) that lead to it, its split, if it has one, and its value."""
        rows = []
        for j, forest in enumerate(self.forests):
            for t, tree in enumerate(forest.trees):
                for node, path in tree.paths().items():
                    p = tree.splits.get(node)
                    split = (forest.binning.features[p.feature], p.code, p.missing_left, p.gain) if p else (None,) * 4
                    rows.append((j, t, path, *split, tree.values[node], tree.rows[node]))
        schema = "model int, tree int, path string, feature string, code int, missing_left boolean, gain double, value double, n_rows long"
        return self.rows.sparkSession.createDataFrame(rows, schema)


def _finished(booster: Booster, rounds: int, scores: Sequence[float] = ()) -> Boosted:
    """The models cut down to ``rounds`` trees, and all rows with the margins of those.

    Margins are worked out once for all rows of equal codes.
    """
    steps = [[t.steps() for t in own[:rounds]] for own in booster.trees]
    points = stored(booster.rows.select("codes").distinct().mapInArrow(tasks.scoring(len(booster.binning.features), booster.bases, steps), "codes array<smallint>, margins array<double>"))
    points = F.broadcast(points) if points.count() <= SENT else points
    forests = tuple(Forest(b, tuple(t[:rounds]), booster.binning) for b, t in zip(booster.bases, booster.trees))
    rows = booster.rows.join(points, "codes").select("key", "label", "fold", "margins")
    booster.release()
    return Boosted(forests, stored(rows), booster.key, tuple(scores))


def fit_boosted(
    df: DataFrame, key: str, label: str, features: Sequence[str], params: Mapping[str, Any] | Boosting, folds: int = 0, fold: str | None = None
) -> Boosted:
    """Fit all rounds. With ``folds``, one model per value of the column ``fold``; else one of all labelled rows.

    Rows without a label are scored, not learned from. Missing cells need no filling: each
    split sends them where they fit better. Trees do not depend on how rows are partitioned.
    """
    settings = params if isinstance(params, Boosting) else Boosting.of(params)
    booster = Booster(df, key, label, features, settings, folds, fold)
    booster.grow(settings.rounds)
    return _finished(booster, settings.rounds)


def round_scores(booster: Booster, rounds: int) -> list[float]:
    """The exact AUC of held-out rows after each of the last ``rounds`` trees, averaged over the folds.

    One pass works out the margins after every tree. Equal scores of a task are one, they are
    dealt by ranges of about ``CELLS`` cells, and each range is sorted in a task; ties count half.
    """
    total = len(booster.trees[0])
    if rounds > booster.pending:
        raise ValueError("the margins of settled trees are not kept")
    blocks, steps = booster.blocks(), booster.steps()
    cuts = np.zeros(0)
    if (ranges := booster.size // CELLS) > 1:
        some = np.sort(np.concatenate([np.zeros(0), *blocks.mapPartitions(tasks.points(steps)).collect()]))
        cuts = np.unique(some[np.linspace(0, len(some) - 1, ranges + 1).astype(int)[1:-1]]) if len(some) else cuts
    ranges, groups = len(cuts) + 1, booster.k * rounds
    dealt = blocks.mapPartitions(tasks.ranging(steps, rounds, cuts)).groupByKey(min(groups * ranges, max(blocks.context.defaultParallelism, ranges)))
    found = dict(dealt.mapValues(tasks.wins).collect())
    out = []
    for at in range(min(rounds, total)):
        groups_of = [[found[key] for i in range(ranges) if (key := (j * rounds + at) * ranges + i) in found] for j in range(booster.k)]
        known = [auc for own in groups_of if (auc := tasks.auc_of(own)) is not None]
        out.append(sum(known) / len(known) if known else 0.0)
    return out


def fit_until_best(
    df: DataFrame, key: str, label: str, features: Sequence[str], params: Mapping[str, Any] | Boosting, folds: int, fold: str, patience: int = 50
) -> Boosted:
    """Fit until the mean held-out AUC has not risen for ``patience`` rounds, and keep the best round.

    Every model grows on from the trees it has, a few at a time, so no tree is fitted twice,
    and no more than ``PENDING - 1`` trees beyond those that the decision needs. What is grown
    beyond counts for nothing: the scores end with the decision.
    """
    settings = params if isinstance(params, Boosting) else Boosting.of(params)
    booster = Booster(df, key, label, features, settings, folds, fold)
    scores: list[float] = []
    while len(scores) < settings.rounds:
        step = min(PENDING, settings.rounds - len(scores))
        booster.settle()
        booster.grow(step)
        scores += round_scores(booster, step)
        if len(scores) - best_round(scores, patience) >= patience:
            break
    best = best_round(scores, patience)
    return _finished(booster, best, scores[: best + patience])


def best_round(scores: Sequence[float], patience: int) -> int:
    """Number of the last rise, the search ending where ``patience`` rounds bring none."""
    best = 0
    for i, score in enumerate(scores):
        if score > scores[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def with_rounds(settings: Boosting, rounds: int) -> Boosting:
    return replace(settings, rounds=rounds)
