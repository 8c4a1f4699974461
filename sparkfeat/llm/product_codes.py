"""Product quantisation of integer vectors with norm-of-sum bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import kept
from sparkfeat.llm.vector_blocks import (
    STEP, changed, first_vectors, moved_to, named, nearest_two, own_distance, pack, unpack, usable,
)

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Relative slack of the bounds, which are rounded numbers; distances themselves are whole numbers.
SLACK = 1e-12


class Bounds:
    """Of every part of every vector of a block: its code, and two bounds with their round stamps.

    ``upper`` bounds the distance to the part's own entry and was exact in round ``upper_at``;
    ``lower`` bounds that to any other entry and was exact in round ``lower_at``. Both are
    rounded outwards.
    """

    def __init__(self, n: int, parts: int) -> None:
        self.code = np.zeros((parts, n), np.uint8)
        self.upper_at = np.zeros((parts, n), np.uint8)
        self.lower_at = np.zeros((parts, n), np.uint8)
        self.upper = np.zeros((parts, n), np.float32)
        self.lower = np.zeros((parts, n), np.float32)

    def _arrays(self) -> tuple[np.ndarray, ...]:
        return self.code, self.upper_at, self.lower_at, self.upper, self.lower

    @staticmethod
    def loads(blob: bytes, parts: int) -> Bounds:
        n = len(blob) // (11 * parts)
        own, at = Bounds(0, parts), 0
        for name, kind in (("code", np.uint8), ("upper_at", np.uint8), ("lower_at", np.uint8), ("upper", np.float32), ("lower", np.float32)):
            size = parts * n
            setattr(own, name, np.frombuffer(blob, kind, size, offset=at).reshape(parts, n).copy())
            at += size * np.dtype(kind).itemsize
        return own

    def dumps(self) -> bytes:
        return b"".join(a.tobytes() for a in self._arrays())

    def tighten(self, part: int, rows: np.ndarray, upper: np.ndarray, now: int) -> None:
        self.upper[part, rows] = np.nextafter((upper * (1 + SLACK)).astype(np.float32), np.float32(np.inf))
        self.upper_at[part, rows] = now

    def rescanned(self, part: int, rows: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, now: int) -> None:
        self.code[part, rows] = own
        self.tighten(part, rows, upper, now)
        self.lower[part, rows] = np.nextafter((lower * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))
        self.lower_at[part, rows] = now


def displacements(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each entry lies now from where it was in each round, and how far the farthest of the others does.

    ``history`` is (round, part, entry, position). The net move is at most the sum of the
    moves between, and less wherever an entry turned back.
    """
    net = np.sqrt(((history[-1] - history) ** 2).sum(-1).astype(np.float64)) * (1 + SLACK)
    k = net.shape[-1]
    if k == 1:
        return net, np.zeros_like(net)
    top = np.sort(net, axis=-1)
    others = np.where(np.argmax(net, axis=-1)[..., None] == np.arange(k), top[..., -2:-1], top[..., -1:])
    return net, others


def rescan(x: np.ndarray, state: bytes | None, history: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """A block's next bounds, the change of the entries' sums and counts, and how many parts were rescanned.

    A part whose upper bound stays below its lower bound keeps its entry. Otherwise the upper
    bound is made exact, and only if that does not help all entries are compared.
    """
    now = len(history) - 1
    _, parts, k, d = history.shape
    cut = x.reshape(len(x), parts, d)
    sums = np.zeros((parts, k, d + 1), np.int64)
    bounds = Bounds(len(x), parts) if state is None else Bounds.loads(state, parts)
    net, others = displacements(history)
    scans = 0
    for p in range(parts):
        books = history[-1, p]
        rows, before = np.arange(len(x)), None
        if state is not None:
            own = bounds.code[p].astype(np.int64)
            lower = bounds.lower[p] - others[bounds.lower_at[p], p, own]
            upper = bounds.upper[p] + net[bounds.upper_at[p], p, own]
            rows = np.flatnonzero(~(upper * (1 + SLACK) < lower * (1 - SLACK)))
            exact = np.sqrt(own_distance(cut[rows, p], books, own[rows]).astype(np.float64))
            bounds.tighten(p, rows, exact, now)
            rows = rows[~(exact * (1 + SLACK) < lower[rows] * (1 - SLACK))]
            before = own[rows]
        if not len(rows):
            continue
        scans += len(rows)
        own, upper, lower = nearest_two(cut[rows, p], books)
        bounds.rescanned(p, rows, own, upper, lower, now)
        with_one = np.column_stack([cut[rows, p], np.ones(len(rows), np.int64)])
        if before is None:
            np.add.at(sums[p], own, with_one)
        else:
            other = own != before
            np.add.at(sums[p], own[other], with_one[other])
            np.subtract.at(sums[p], before[other], with_one[other])
    return bounds.dumps(), sums, scans


def _step(history: np.ndarray) -> Column:
    _, parts, _, d = history.shape

    @F.pandas_udf(STEP)
    def step(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for xs, widths, states in batches:
            out = []
            for x, width, state in zip(xs, widths, states):
                blob, sums, _ = rescan(unpack(x, width, parts * d), state, history)
                out.append((blob, *changed(sums)))
            yield pd.DataFrame(out, columns=["state", "slots", "sums"])

    return step("x", "width", "state")


def _coded(books: np.ndarray) -> Column:
    parts, _, d = books.shape

    @F.pandas_udf("struct<code:array<string>,error:array<bigint>>")
    def coded(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for xs, widths, states in batches:
            out = []
            for x, width, state in zip(xs, widths, states):
                own = Bounds.loads(state, parts).code
                cut = unpack(x, width, parts * d).reshape(-1, parts, d)
                error = sum(own_distance(cut[:, p], books[p], own[p]) for p in range(parts))
                digits = np.ascontiguousarray(own.T).tobytes().hex()
                out.append(([digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)], error))
            yield pd.DataFrame(out, columns=["code", "error"])

    return coded("x", "width", "state")


def common_length(rows: DataFrame, parts: int) -> int | None:
    """The commonest length of ``vec`` that ``parts`` divides (of equally common ones the longest)."""
    sizes = rows.groupBy(F.size("vec").alias("length")).count().filter(F.col("length") % parts == 0)
    first = sizes.orderBy(F.desc("count"), F.desc("length")).first()
    return None if first is None else first["length"]


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """``(rows, codebooks)``: ``id, label, code, error`` of every kept vector; codebooks by part, entry, position.

    Components are ``floor(scale * x)``, all distances and means exact. Each part's codebook
    starts as that part of the ``entries`` smallest ids. A round assigns every part to its
    nearest entry (ties: the smaller number) and moves every used entry to the floor of its
    parts' mean; a last assignment follows. ``code`` is two hex digits per part, ``error``
    the squared distances summed over the parts.

    Null vectors and those with null, NaN or infinite components are dropped, and so are those
    whose length is not the commonest one that ``parts`` divides. A null id starts no entry;
    repeated rows each count, and equal ids start in the order of their vectors. Of fewer
    vectors than ``entries``, each starts an entry; an empty table gives no rows and no
    codebooks. Components beyond 2**27 raise an ArithmeticError.
    """
    if not (1 <= entries <= 256 and 0 <= rounds < 256):
        raise ValueError("codes and round stamps are single bytes")
    rows = named(vectors, id_col, vec_col, label_col).filter(usable(F.col("vec")))
    types = dict(rows.dtypes)
    length = common_length(rows, parts)
    rows = rows.filter(F.size("vec") == F.lit(length or 0))
    first = first_vectors(rows.filter("id is not null"), [F.col("id")], entries, scale)
    if not len(first):
        empty = vectors.sparkSession.createDataFrame([], f"id {types['id']}, label {types['label']}, code string, error bigint")
        return empty, np.zeros((parts, 0, 0), np.int64)
    d = length // parts
    history = first.reshape(len(first), parts, d).transpose(1, 0, 2)[None]
    blocks = pack(rows, scale, "codes")
    totals = np.zeros((parts, len(first), d + 1), np.int64)
    for _ in range(rounds):
        for slot, change in blocks.step(_step(history)).items():
            totals.reshape(-1)[slot] += change
        books = [moved_to(history[-1, p], totals[p, :, :d], totals[p, :, d]) for p in range(parts)]
        history = np.concatenate([history, np.stack(books)[None]])
    blocks.step(_step(history))
    found = blocks.joined().select("ids", "labels", _coded(history[-1]).alias("c"))
    zipped = F.arrays_zip("ids", "labels", F.col("c.code").alias("code"), F.col("c.error").alias("error"))
    flat = kept(found.select(F.inline(zipped)).toDF("id", "label", "code", "error"))
    blocks.forget()
    return flat, history[-1]
