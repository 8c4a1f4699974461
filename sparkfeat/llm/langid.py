"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, kept, unit_hash

#: Hashed n-grams, centroids per language, texts per language that they are fitted on (about; chosen by hash).
DIMS, CENTROIDS, FIT_PER_LANGUAGE = 4096, 4, 1000
ROUNDS = 8
#: Members of a language that may lie beyond its rejection distance.
REJECTED_SHARE = 0.001
UNKNOWN = "und"
#: Characters and texts that are counted at once.
PIECE, GROUP = 1 << 20, 64
SPACE = 32

RESULT = "lang string, score double, rejected boolean"


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Counts of hashed character bigrams and trigrams of lower-cased letters; all else is a space."""

    def __init__(self) -> None:
        self.letters = letter_table()

    def _codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        return np.where(self.letters[codes], codes, SPACE)

    def _hashes(self, c: np.ndarray) -> np.ndarray:
        """Places of the n-grams that end at the third character or later; those with two spaces in a row are left out."""
        a, b, d = c[:-2], c[1:-1], c[2:]
        double = (b == SPACE) & (d == SPACE)
        two = (b * 0x9E3779B1 + d * 0x85EBCA77)[~double]
        wide = ~(double | ((a == SPACE) & (b == SPACE)))
        three = (a * 0xC2B2AE3D + b * 0x27D4EB2F + d * 0x165667B1 + 1)[wide]
        h = np.concatenate([two, three])
        return ((h ^ (h >> 17)) >> 3) & (DIMS - 1)

    def counts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Counts per text and place, and whether the text has a letter."""
        out = np.zeros((len(texts), DIMS), dtype=np.float32)
        lettered = np.zeros(len(texts), dtype=bool)
        for row, text in enumerate(texts):
            text = text or ""
            for start in range(0, len(text), PIECE):
                left = "  " if start == 0 else text[start - 2 : start]
                codes = self._codes(left + text[start : start + PIECE] + (" " if start + PIECE >= len(text) else ""))
                lettered[row] |= bool((codes[2:] != SPACE).any())
                out[row] += np.bincount(self._hashes(codes), minlength=DIMS)
        return out, lettered


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a row without n-grams stays zero."""
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from far-apart rows; gives at most ``k`` normalised centroids."""
    first = int(np.argmax(x @ x.mean(axis=0)))
    seeds = [first]
    near = x @ x[first]
    while len(seeds) < min(k, len(x)) and near.min() < 1 - 1e-6:
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    centres = x[seeds].copy()
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) for j in range(len(centres))])
        sums = sums[np.linalg.norm(sums, axis=1) > 0]
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


@dataclass
class LanguageModel:
    """Weights of the n-grams, and per centroid its language and the cosine below which it rejects."""

    idf: np.ndarray
    languages: list[str]
    centres: np.ndarray
    least: np.ndarray

    def predict(self, text: Column) -> Column:
        """``lang, score, rejected`` of the whole text; ``und`` with score 0 where there is no letter."""
        idf, languages, centres, least = self.idf, self.languages, self.centres, self.least

        @F.pandas_udf(RESULT)
        def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            grams = Grams()
            for texts in batches:
                rows = []
                for i in range(0, len(texts), GROUP):
                    counts, lettered = grams.counts(texts.iloc[i : i + GROUP].tolist())
                    cosine = weighted(counts, idf) @ centres.T if len(languages) else np.zeros((len(counts), 1))
                    best = cosine.argmax(axis=1)
                    for row, j in enumerate(best):
                        known = lettered[row] and len(languages) > 0
                        score = float(min(max(cosine[row, j], 0.0), 1.0)) if known else 0.0
                        rows.append((languages[j], score, bool(score < least[j])) if known else (UNKNOWN, 0.0, True))
                yield pd.DataFrame(rows, columns=["lang", "score", "rejected"])

        return nearest(text)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each place occurs: one row per place and task, then added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, seen, n = Grams(), np.zeros(DIMS + 1, dtype=np.int64), 0
        for frame in batches:
            texts = frame["text"].tolist()
            for i in range(0, len(texts), GROUP):
                counts, _ = grams.counts(texts[i : i + GROUP])
                seen[:DIMS] += (counts > 0).sum(axis=0)
                n += len(counts)
        seen[DIMS] = n
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"place": at, "n": seen[at]})

    total = np.zeros(DIMS + 1, dtype=np.int64)
    for row in texts.mapInPandas(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[row["place"]] = row["n"]
    return total[:DIMS], int(total[DIMS])


def train_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    centroids: int = CENTROIDS,
    per_language: int = FIT_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the texts with a language; other columns are not looked at.

    Document frequencies are counted over all these texts. The centroids of each language are
    fitted on about ``per_language`` of its texts, chosen by a hash of the id and text, in one
    task per language. Rows without language or text are not learned from; with none
    left the model answers ``und`` to everything.
    """
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("lang is not null and text is not null")
    seen, n = _document_frequencies(rows.select("text"))
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    draw = unit_hash([F.col("id"), F.col("text")], "languages")
    chosen = rows.join(F.broadcast(kept(sizes)), "lang").filter(draw * F.col("size") < per_language)

    @F.pandas_udf("place array<int>, value array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams = Grams()
        for texts in batches:
            out = []
            for i in range(0, len(texts), GROUP):
                for x in weighted(grams.counts(texts.iloc[i : i + GROUP].tolist())[0], idf):
                    at = np.flatnonzero(x)
                    out.append((at.astype(np.int32), x[at]))
            yield pd.DataFrame(out, columns=["place", "value"])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("draw")
        x = np.zeros((len(frame), DIMS), dtype=np.float32)
        for row, (at, value) in enumerate(zip(frame["place"], frame["value"])):
            x[row, at] = value
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "k": [], "least": [], "centre": []})
        centres = cluster(x, centroids)
        cosine = x @ centres.T
        own, best = cosine.argmax(axis=1), cosine.max(axis=1)
        least = [float(np.quantile(best[own == j], REJECTED_SHARE)) * 0.9 if (own == j).any() else 0.0 for j in range(len(centres))]
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "k": range(len(centres)), "least": least, "centre": list(centres)})

    fitted = (
        chosen.select("lang", draw.alias("draw"), vectors("text").alias("v"))
        .select("lang", "draw", "v.place", "v.value")
        .groupBy("lang")
        .applyInPandas(fit, "lang string, k int, least double, centre array<float>")
    )
    found = sorted(fitted.collect(), key=lambda r: (r["lang"], r["k"]))
    centres = np.array([r["centre"] for r in found], dtype=np.float32).reshape(len(found), DIMS)
    return LanguageModel(idf, [r["lang"] for r in found], centres, np.array([r["least"] for r in found]))
