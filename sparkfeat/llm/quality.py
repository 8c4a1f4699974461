"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, kept

#: Size of the hashed feature space; the place after the last is the bias.
DIMS = 1 << 18
#: Labelled documents that training takes at most, shards that learn side by side, passes.
MAX_TRAIN, SHARDS, PASSES = 8_000, 4, 6
#: Distinct words whose hashes a task remembers.
REMEMBERED = 200_000

MARKS = ".,;:!?\"'()[]{}<>|#*$%&/\\-_=+~^`@"
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def shape(word: str) -> str:
    """How a word is written: its case, its length class, the marks around it."""
    core = word.strip(MARKS)
    if not core:
        kind = "-"
    elif core.isdigit():
        kind = "9"
    elif len(core) > 1 and core.isupper():
        kind = "A"
    elif core.islower():
        kind = "a"
    elif core[0].isupper() and (len(core) == 1 or core[1:].islower()):
        kind = "Aa"
    else:
        kind = "x"
    size = min(len(core), 24).bit_length()
    return f"{kind}{size}{word[len(word.rstrip(MARKS)):][:3]}"


class Featurizer:
    """Hashed n-grams of a text: words (1, 2) and word shapes (1, 2, 3).

    A shape also tells whether the word equals one of the two before it, so that n-grams see
    repetition. The value of an n-gram is its share of the text's n-grams of that kind, so a
    text's score is a sum of mean weights and does not depend on its length.
    """

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _code(self, word: str) -> int:
        plain = zlib.crc32(word.lower().strip(MARKS).encode("utf-8", "surrogatepass"))
        return plain << 32 | zlib.crc32(shape(word).encode("utf-8", "surrogatepass"))

    def _codes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._code(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def grams(self, text: str | None) -> list[np.ndarray]:
        """Places of all n-grams of each kind, in order and with repeats; none for a blank text."""
        words = (text or "").split()
        if not words:
            return []
        codes = self._codes(words)
        w = codes >> np.uint64(32)
        s = codes & np.uint64(0xFFFFFFFF)
        s[1:] |= (w[1:] == w[:-1]).astype(np.uint64) << np.uint64(33)
        s[2:] |= (w[2:] == w[:-2]).astype(np.uint64) << np.uint64(34)
        out = []
        for salt, (base, n) in enumerate(((w, 1), (w, 2), (s, 1), (s, 2), (s, 3))):
            size = len(base) - n + 1
            if size < 1:
                continue
            h = base[:size] * MIXERS[0] + np.uint64(salt)
            for k in range(1, n):
                h = (h ^ (h >> np.uint64(31))) * MIXERS[k] + base[k : size + k]
            h = (h ^ (h >> np.uint64(29))) * MIXERS[1]
            out.append(((h >> np.uint64(24)) & np.uint64(DIMS - 1)).astype(np.int64))
        return out

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The text as sorted places and values, the bias last."""
        index, value = [], []
        for at in self.grams(text):
            place, count = np.unique(at, return_counts=True)
            index.append(place)
            value.append(count / len(at))
        index.append(np.array([DIMS]))
        value.append(np.ones(1))
        return np.concatenate(index).astype(np.int32), np.concatenate(value).astype(np.float32)


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader state of a logistic model."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01

    @staticmethod
    def empty() -> Ftrl:
        return Ftrl(np.zeros(DIMS + 1), np.zeros(DIMS + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - label) * x
        n = self.n[at]
        np.add.at(self.z, at, g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w)
        np.add.at(self.n, at, g * g)


def sigmoid(t: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(t, -35.0), 35.0)))


@dataclass
class QualityModel:
    """Weights of the n-grams and the bias; scores any text."""

    weights: np.ndarray

    def score(self, text: Column) -> Column:
        """Probability of label 1 for the whole text; a null or blank text gets that of the bias."""
        weights = self.weights

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            features = Featurizer()
            for texts in batches:
                sums = [float(weights[DIMS]) + sum(float(weights[g].mean()) for g in features.grams(t)) for t in texts]
                yield pd.Series([sigmoid(x) for x in sums], dtype="float64")

        return scores(text)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_train: int) -> DataFrame:
    """``(id, label, text)`` of at most ``max_train`` labelled documents, chosen by a hash of the id.

    The bounded list of ids is broadcast, so texts stay where they are until they are chosen.
    An id with several labels takes the lowest, an id with several texts the smallest text.
    """
    chosen = (
        labels.filter(col(label_col).isNotNull() & col(id_col).isNotNull())
        .groupBy(col(id_col).alias("__id"))
        .agg(F.min(col(label_col)).cast("double").alias("__label"))
        .orderBy(F.md5(F.col("__id").cast("string")), "__id")
        .limit(max_train)
    )
    texts = docs.select(col(id_col).alias("__id"), F.coalesce(col(text_col), F.lit("")).alias("__text"))
    return texts.join(F.broadcast(chosen), "__id").groupBy("__id").agg(F.min("__label").alias("label"), F.min("__text").alias("text"))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
    shards: int = SHARDS,
    passes: int = PASSES,
) -> QualityModel:
    """Train on at most ``max_train`` labelled documents (a bound, chosen by hash of the id).

    The n-gram vectors are stored once. In each pass every shard learns its own rows in the
    order of a hash, starting from the common state, and the shards' changes are averaged;
    what reaches the driver is at most one row per hashed place, as Arrow columns. Null ids, null labels and
    ids without a document are not learned from; without any row every score is 0.5.
    """
    schema = "place array<int>, value array<float>"

    @F.pandas_udf(schema)
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Featurizer()
        for texts in batches:
            yield pd.DataFrame([features.vector(t) for t in texts], columns=["place", "value"])

    order = F.xxhash64("__id")
    rows = training_rows(docs, labels, id_col, text_col, label_col, max_train)
    rows = kept(rows.select("label", order.alias("order"), F.pmod(order, F.lit(shards)).alias("shard"), vectors("text").alias("v")))
    state = Ftrl.empty()
    for _ in range(passes):
        start = docs.sparkSession.sparkContext.broadcast((state.z.tobytes(), state.n.tobytes()))
        moves = rows.select("shard", "order", "label", "v.place", "v.value").groupBy("shard").applyInPandas(
            _pass(start, state), "place int, z double, n double"
        )
        total = moves.groupBy("place").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()
        at = total.column("place").to_numpy()
        state.z[at] += total.column("z").to_numpy() / shards
        state.n[at] += total.column("n").to_numpy() / shards
        start.destroy()
    return QualityModel(state.weights().astype(np.float32))


def _pass(start: Broadcast, settings: Ftrl):
    """One shard's pass over its rows; gives by how much each touched place has moved."""
    alpha, beta, l1, l2 = settings.alpha, settings.beta, settings.l1, settings.l2

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = (np.frombuffer(x) for x in start.value)
        own = Ftrl(z.copy(), n.copy(), alpha, beta, l1, l2)
        for row in rows.sort_values("order").itertuples():
            own.learn(np.asarray(row.place), np.asarray(row.value, dtype=np.float64), row.label)
        at = np.flatnonzero(own.n != n)
        return pd.DataFrame({"place": at.astype(np.int32), "z": own.z[at] - z[at], "n": own.n[at] - n[at]})

    return learn
