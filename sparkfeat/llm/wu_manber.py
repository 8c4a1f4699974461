"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfeat.llm.common import col, fresh_path, free_name, kept

#: Words of a window.
WINDOW = 10
#: Bytes of benchmark text that are searched for at once; more go in further passes.
BLOCK_BYTES = 8 << 20
#: End positions that one search pointer covers, words searched at once, candidates compared at once.
LANE, PART_WORDS, PART_CANDIDATES = 256, 1 << 21, 1 << 21

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)

#: Bytes of words stay (A-Z lower-cased), all others become a space: digits, letters and whatever is not ASCII.
WORD_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


@dataclass
class Tables:
    """Search tables for the windows of one length.

    ``shift`` says how far the end of the window may move when it stands on a block of words,
    ``bucket`` and ``order`` list the windows that end with a block of a given hash.
    """

    length: int
    block: int
    starts: np.ndarray
    shift: np.ndarray
    bucket: np.ndarray
    order: np.ndarray

    @staticmethod
    def build(flat: np.ndarray, starts: np.ndarray, length: int) -> Tables:
        block = min(2, length)
        places = length - block + 1
        size = 1 << max(10, min(22, int(4 * len(starts) * places).bit_length()))
        shift = np.full(size, places, dtype=np.int16)
        last = None
        for end in range(block - 1, length):
            last = _hash(flat, starts + end, block, size)
            np.minimum.at(shift, last, length - 1 - end)
        order = np.argsort(last, kind="stable")
        bucket = np.zeros(size + 1, dtype=np.int64)
        np.cumsum(np.bincount(last, minlength=size), out=bucket[1:])
        return Tables(length, block, starts, shift, bucket, order)

    def search(self, ids: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start position, window number) of every occurrence in ``ids``; id 0 matches nothing.

        One pointer per lane of end positions moves by the shift table, all pointers at once.
        """
        size = len(self.shift)
        at = np.arange(self.length - 1, len(ids), LANE, dtype=np.int64)
        stop = np.minimum(at + LANE, len(ids))
        ends = []
        while len(at):
            move = self.shift[_hash(ids, at, self.block, size)]
            ends.append(at[move == 0])
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        found = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
        return self._confirm(found, ids, flat)

    def _confirm(self, ends: np.ndarray, ids: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.bucket[h := _hash(ids, ends, self.block, len(self.shift))]
        count = self.bucket[h + 1] - low
        begins, windows = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        total = np.cumsum(count)
        done = 0
        while done < len(ends):
            base = total[done - 1] if done else 0
            upto = max(done + 1, int(np.searchsorted(total, base + PART_CANDIDATES, side="right")))
            n = count[done:upto]
            first = np.repeat(ends[done:upto] - self.length + 1, n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window = self.order[np.repeat(low[done:upto], n) + step]
            for k in range(self.length):
                same = ids[first + k] == flat[self.starts[window] + k]
                first, window = first[same], window[same]
            begins.append(first)
            windows.append(window)
            done = upto
        return np.concatenate(begins), np.concatenate(windows)


def _hash(ids: np.ndarray, ends: np.ndarray, block: int, size: int) -> np.ndarray:
    h = ids[ends].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if block == 2:
        h ^= ids[ends - 1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((h >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)


class Patterns:
    """All windows of some benchmark items, ready to be searched for."""

    def __init__(self, items: Sequence[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({i for i, _ in items if i is not None})
        place = {n: k for k, n in enumerate(self.names)}
        flat: list[int] = []
        known: dict[tuple[int, ...], tuple[int, int]] = {}
        starts: dict[int, list[int]] = {}
        owners: dict[int, list[set[int]]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            base = len(flat)
            flat.extend(ids)
            for i in range(len(ids) - length + 1 if ids else 0):
                key = tuple(ids[i : i + length])
                if key not in known:
                    known[key] = (length, len(starts.setdefault(length, [])))
                    starts[length].append(base + i)
                    owners.setdefault(length, []).append(set())
                if name is not None:
                    owners[length][known[key][1]].add(place[name])
        self.flat = np.array(flat, dtype=np.int32)
        self.tables = [Tables.build(self.flat, np.array(s, dtype=np.int64), n) for n, s in sorted(starts.items())]
        self.owners = []
        for n in sorted(starts):
            edges = np.cumsum([0] + [len(o) for o in owners[n]])
            members = np.array([k for o in owners[n] for k in sorted(o)], dtype=np.int64)
            self.owners.append((edges, members))

    def find(self, texts: Sequence[str | None]) -> Iterator[tuple[int, list[int], list[str]]]:
        """Per text: number of words, hit words as flat ``start, end`` pairs, names of the items found."""
        part: list[list[bytes]] = []
        held = 0
        for text in texts:
            part.append(words_of(text))
            held += len(part[-1])
            if held >= PART_WORDS:
                yield from self._find(part)
                part, held = [], 0
        yield from self._find(part)

    def _find(self, texts: list[list[bytes]]) -> Iterator[tuple[int, list[int], list[str]]]:
        n = np.array([len(t) for t in texts], dtype=np.int64)
        first = np.cumsum(n + 1) - n - 1
        ids = np.zeros(int((n + 1).sum()), dtype=np.int32)  # a 0 after each text keeps windows apart
        for begin, words in zip(first.tolist(), texts):
            ids[begin : begin + len(words)] = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        depth = np.zeros(len(ids) + 1, dtype=np.int64)
        owned: list[set[int]] = [set() for _ in texts]
        touched: set[int] = set()
        for table, (edges, members) in zip(self.tables, self.owners):
            begins, windows = table.search(ids, self.flat)
            np.add.at(depth, begins, 1)
            np.add.at(depth, begins + table.length, -1)
            docs = np.searchsorted(first, begins, side="right") - 1
            pairs = np.unique(docs * max(1, len(table.starts)) + windows) if len(docs) else docs
            for pair in pairs.tolist():
                doc, window = divmod(pair, len(table.starts))
                owned[doc].update(members[edges[window] : edges[window + 1]].tolist())
                touched.add(doc)
        covered = np.cumsum(depth[:-1]) > 0
        for k, begin in enumerate(first.tolist()):
            spans: list[int] = []
            if k in touched:
                mark = np.concatenate([[0], covered[begin : begin + len(texts[k])].astype(np.int8), [0]])
                spans = np.flatnonzero(np.diff(mark)).tolist()
            yield len(texts[k]), spans, [self.names[i] for i in sorted(owned[k])]


def merge_spans(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Union of two lists of ``start, end`` pairs, touching ones joined."""
    out: list[int] = []
    for start, end in sorted(list(zip(a[::2], a[1::2])) + list(zip(b[::2], b[1::2]))):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _searcher(blob, text: Column, before: Column | None) -> Column:
    """A column with what is found, joined with what earlier passes have found.

    ``blob`` is the broadcast of pickled patterns, loaded once for each task.
    """
    if before is None:

        @F.pandas_udf(FOUND)
        def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            patterns = pickle.loads(blob.value)
            for texts in batches:
                yield pd.DataFrame(patterns.find(texts), columns=FOUND.names)

        return search(text)

    @F.pandas_udf(FOUND)
    def search_on(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        patterns = pickle.loads(blob.value)
        for texts, found in batches:
            rows = zip(patterns.find(texts), found["spans"], found["items"])
            out = [(n, merge_spans(s, list(t)), sorted({*i, *j})) for (n, s, i), t, j in rows]
            yield pd.DataFrame(out, columns=FOUND.names)

    return search_on(text, before)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[bytes]:
    """The pickled patterns of the benchmark's different rows in blocks of about ``block_bytes``.

    A task builds each block's tables; the driver holds one blob at a time.
    """
    rows = kept(benchmark.select(col(item_col).cast("string").alias("item"), col(text_col).alias("text")).distinct())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = [(None if pd.isna(i) else i, t) for batch in batches for i, t in zip(batch["item"], batch["text"])]
        yield pd.DataFrame({"blob": [cloudpickle.dumps(Patterns(items, window))]})

    for k in range(n):
        made = rows.filter(part == k).coalesce(1).mapInPandas(build, "blob binary").first()
        yield bytes(made["blob"]) if made else cloudpickle.dumps(Patterns([], window))


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    out: str = "found",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with one more column ``out``: which benchmark windows occur in the whole text.

    The struct holds ``n_words``, ``spans`` (hit words as flat ``start, end`` pairs, in order,
    not touching) and ``items`` (ids, as sorted strings, of items with an occurring window). A
    window is ``window`` consecutive words of an item, or the whole item if it has fewer words,
    but not none. A null or empty text has no words; an empty benchmark hits nothing; rows of
    a null item id hit words but are not listed; repeated items count once. All columns of
    ``docs`` pass through, and ``out`` may not be one of them.

    The windows of the different rows are searched in blocks of bounded size, one broadcast each. With more than
    one block the rows are stored in the shared folder between passes, so no task ever holds
    two blocks.
    """
    if free_name(docs, out) != out:
        raise ValueError(f"the documents already have a column {out!r}")
    spark = docs.sparkSession
    before = None
    for patterns in _blocks(benchmark, item_col, item_text_col, window, block_bytes):
        blob = spark.sparkContext.broadcast(patterns)
        if before is not None:
            path = fresh_path(spark, "passages")
            docs.write.parquet(path)
            docs, before = spark.read.parquet(path), col(out)
        docs = docs.select(*[col(c) for c in docs.columns if c != out], _searcher(blob, col(text_col), before).alias(out))
        before = col(out)
    return docs


def hit_words(found: Column) -> Column:
    """How many words the spans of ``find_passages`` cover."""
    ends = F.filter(found["spans"], lambda _, i: i % 2 == 1)
    starts = F.filter(found["spans"], lambda _, i: i % 2 == 0)
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return total(ends) - total(starts)
