"""Exact k-means of integer vectors with heap-ordered bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import kept
from sparkfeat.llm.vector_blocks import (
    STEP, changed, first_vectors, moved_to, named, nearest_two, own_distance, pack, unpack, usable,
)

CLUSTERS, ROUNDS, LENGTH, SCALE = 16, 3, 64, 64
#: Relative slack of the bounds, which are rounded numbers; distances themselves are whole numbers.
SLACK = 1e-12


@dataclass
class Heaps:
    """For each cluster a heap of ``(key, row)`` over the vectors of a block that it holds.

    A vector's key is its gap (lower bound of the distance to any other centroid, less the
    upper bound of that to its own) at its last exact scan, plus the drift that the cluster had
    accumulated then. It is certain of its cluster while the key exceeds the drift of now.
    """

    heaps: list[list[tuple[float, int]]]

    @staticmethod
    def empty(k: int) -> Heaps:
        return Heaps([[] for _ in range(k)])

    @staticmethod
    def loads(blob: bytes, k: int) -> Heaps:
        sizes = np.frombuffer(blob, np.int32, k)
        n = int(sizes.sum())
        keys = np.frombuffer(blob, np.float64, n, offset=4 * k).tolist()
        rows = np.frombuffer(blob, np.int32, n, offset=4 * k + 8 * n).tolist()
        ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        return Heaps([list(zip(keys[a:b], rows[a:b])) for a, b in zip(ends, ends[1:])])

    def dumps(self) -> bytes:
        flat = [entry for heap in self.heaps for entry in heap]
        keys = np.array([e[0] for e in flat], np.float64)
        rows = np.array([e[1] for e in flat], np.int32)
        return np.array([len(h) for h in self.heaps], np.int32).tobytes() + keys.tobytes() + rows.tobytes()

    def expired(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take out all vectors whose gap the drift has used up: their rows and their clusters."""
        rows, own = [], []
        for c, (heap, limit) in enumerate(zip(self.heaps, drift.tolist())):
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
                own.append(c)
        return np.array(rows, np.int64), np.array(own, np.int64)

    def put(self, rows: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, drift: np.ndarray) -> None:
        gap = lower - upper - SLACK * (1.0 + upper + np.where(np.isinf(lower), 0.0, lower))
        for row, c, key in zip(rows.tolist(), own.tolist(), (gap + drift[own]).tolist()):
            heapq.heappush(self.heaps[c], (key, row))

    def clusters(self) -> np.ndarray:
        own = np.empty(sum(map(len, self.heaps)), np.int64)
        for c, heap in enumerate(self.heaps):
            own[[row for _, row in heap]] = c
        return own


def rescan(x: np.ndarray, state: bytes | None, centers: np.ndarray, drift: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """A block's next state, the change of each cluster's sums and count, and how many vectors were rescanned.

    Without a state all vectors are scanned, and the change is their whole sums.
    """
    k, d = centers.shape
    sums = np.zeros((k, d + 1), np.int64)
    if state is None:
        heaps, rows, before = Heaps.empty(k), np.arange(len(x)), None
    else:
        heaps = Heaps.loads(state, k)
        rows, before = heaps.expired(drift)
    if len(rows):
        own, upper, lower = nearest_two(x[rows], centers)
        heaps.put(rows, own, upper, lower, drift)
        with_one = np.column_stack([x[rows], np.ones(len(rows), np.int64)])
        if before is None:
            np.add.at(sums, own, with_one)
        else:
            other = own != before
            np.add.at(sums, own[other], with_one[other])
            np.subtract.at(sums, before[other], with_one[other])
    return heaps.dumps(), sums, len(rows)


def _step(centers: np.ndarray, drift: np.ndarray) -> Column:
    d = centers.shape[1]

    @F.pandas_udf(STEP)
    def step(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for xs, widths, states in batches:
            out = []
            for x, width, state in zip(xs, widths, states):
                blob, sums, _ = rescan(unpack(x, width, d), state, centers, drift)
                out.append((blob, *changed(sums)))
            yield pd.DataFrame(out, columns=["state", "slots", "sums"])

    return step("x", "width", "state")


def _measured(centers: np.ndarray) -> Column:
    k, d = centers.shape

    @F.pandas_udf("struct<cluster:array<int>,distance:array<bigint>>")
    def measured(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for xs, widths, states in batches:
            out = []
            for x, width, state in zip(xs, widths, states):
                own = Heaps.loads(state, k).clusters()
                out.append((own.astype(np.int32), own_distance(unpack(x, width, d), centers, own)))
            yield pd.DataFrame(out, columns=["cluster", "distance"])

    return measured("x", "width", "state")


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For each cluster, by how much a gap shrinks at most: its own move and the largest of the others."""
    move = np.sqrt(((after - before) ** 2).sum(1).astype(np.float64)) * (1 + SLACK)
    if len(move) == 1:
        return move
    order = np.argsort(move)
    largest = np.full(len(move), move[order[-1]])
    largest[order[-1]] = move[order[-2]]
    return (move + largest) * (1 + SLACK)


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    salt: str = "1:",
) -> tuple[DataFrame, np.ndarray]:
    """``(rows, centroids)``: ``id, cluster, distance`` of every kept vector, and the final centroids.

    Components are ``floor(scale * x)``, all distances and means exact. Centroids start as the
    ``k`` vectors with the smallest SHA-256 of ``salt`` and id. A round assigns every vector to
    the nearest centroid (ties: the smaller number) and moves every centroid that has vectors
    to the floor of their mean; a last assignment follows. Only vectors whose bound has
    expired are compared with all centroids again; sums change by the vectors that moved.

    Vectors of another length, null ones and those with null, NaN or infinite components are
    dropped. A row with a null id is assigned like the others but starts no centroid;
    repeated rows each count. Of fewer vectors than ``k``, each starts a centroid; an empty
    table gives no rows and no centroids. Components beyond 2**27 raise an ArithmeticError.
    """
    rows = named(vectors, id_col, vec_col).filter(usable(F.col("vec"), length))
    seeds = rows.filter("id is not null")
    centers = first_vectors(seeds, [F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)], k, scale)
    schema = f"id {dict(rows.dtypes)['id']}, cluster int, distance bigint"
    if not len(centers):
        return vectors.sparkSession.createDataFrame([], schema), centers
    blocks = pack(rows, scale, "centroids")
    k, d = centers.shape
    totals, drift = np.zeros((k, d + 1), np.int64), np.zeros(k)
    for _ in range(rounds):
        for slot, change in blocks.step(_step(centers, drift)).items():
            totals[slot // (d + 1), slot % (d + 1)] += change
        after = moved_to(centers, totals[:, :d], totals[:, d])
        drift = drift + drifts(centers, after)
        centers = after
    blocks.step(_step(centers, drift))
    found = blocks.joined().select("ids", _measured(centers).alias("m"))
    zipped = F.arrays_zip("ids", F.col("m.cluster").alias("cluster"), F.col("m.distance").alias("distance"))
    flat = kept(found.select(F.inline(zipped)).toDF("id", "cluster", "distance"))
    blocks.forget()
    return flat, centers


def inertias(rows: DataFrame) -> dict[int, int]:
    """The distances of each cluster, summed; at most one row per cluster comes to the driver."""
    return {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
