"""Integer vectors in packed blocks, and block states that are joined to them without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, fresh_path

#: Vectors of a block at most.
ROWS = 1024
#: Largest component (as an integer) whose squared distances are sure to fit 64 bits.
LARGEST = 1 << 27


def usable(vec: Column, length: int | None = None) -> Column:
    """True for vectors without null, NaN or infinite components (and of ``length``, where given)."""
    whole = vec.isNotNull() & (F.size(vec) > 0)
    if length is not None:
        whole = vec.isNotNull() & (F.size(vec) == length)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(whole & finite, F.lit(False))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of every component."""
    ints = np.floor(np.asarray(values, dtype=np.float64) * scale)
    if ints.size and np.abs(ints).max() > LARGEST:
        raise ArithmeticError(f"a component beyond {LARGEST} after scaling: its squared distances may not fit 64 bits")
    return ints.astype(np.int64)


def pack(vectors: DataFrame, scale: int, name: str) -> BlockTable:
    """``id, label, vec`` (all usable, of one length) as blocks of integers.

    Each task packs the rows that it reads, so rows that share an id or a label lie in
    different blocks. Blocks are then spread by their number, once.
    """
    types = dict(vectors.dtypes)
    schema = f"block long, ids array<{types['id']}>, labels array<{types['label']}>, width int, x binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids, labels, vec = (part.column(n) for n in ("id", "label", "vec"))
                x = scaled(vec.flatten().to_numpy(zero_copy_only=False), scale)
                small = np.int16 if np.abs(x).max() < 1 << 15 else np.int32
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([at], pa.int64()),
                        pa.ListArray.from_arrays(ends, ids),
                        pa.ListArray.from_arrays(ends, labels),
                        pa.array([np.dtype(small).itemsize], pa.int32()),
                        pa.array([x.astype(small).tobytes()], pa.binary()),
                    ],
                    names=["block", "ids", "labels", "width", "x"],
                )
                at += 1

    rows = vectors.select("id", "label", "vec")
    return BlockTable(rows.mapInArrow(blocks, schema), max(1, rows.rdd.getNumPartitions()), name)


class BlockTable:
    """Blocks, and the newest state of each, as tables bucketed by the block's number.

    Both sides of their join lie in the same buckets, so a round reads the vectors, reads
    the states and writes new states, and shuffles nothing. Files lie in the shared folder,
    so a lost executor loses none of them.
    """

    def __init__(self, blocks: DataFrame, buckets: int, name: str) -> None:
        self.spark, self.buckets, self.name = blocks.sparkSession, buckets, name
        self.tables: list[str] = []
        self.blocks = self._write(blocks.repartition(buckets, "block"))
        self.state: DataFrame | None = None

    def _write(self, rows: DataFrame) -> DataFrame:
        table = f"{self.name}_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, "block").option("path", fresh_path(self.spark, self.name))
        writer.saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def joined(self) -> DataFrame:
        """Each block with its newest state."""
        if self.state is None:
            return self.blocks.withColumn("state", F.lit(None).cast("binary"))
        return self.blocks.join(self.state.select("block", "state").hint("merge"), "block")

    def step(self, work: Column) -> dict[int, int]:
        """Replace every state by ``work`` (a struct of ``state, slots, sums``); returns the total of each slot."""
        done = self.joined().select("block", work.alias("done"))
        self.state = self._write(done.select("block", "done.state", "done.slots", "done.sums"))
        moves = self.state.select(F.explode(F.arrays_zip("slots", "sums")).alias("m"))
        totals = moves.groupBy("m.slots").agg(F.sum("m.sums").alias("total"))
        return {r["slots"]: r["total"] for r in totals.collect()}

    def forget(self) -> None:
        """Take the tables out of the catalog; their files stay in the shared folder."""
        for table in self.tables:
            self.spark.sql(f"drop table if exists {table}")


#: What a step gives for each block.
STEP = "struct<state:binary,slots:array<int>,sums:array<bigint>>"


def unpack(x: bytes, width: int, length: int) -> np.ndarray:
    return np.frombuffer(x, dtype=np.int16 if width == 2 else np.int32).reshape(-1, length).astype(np.int64)


def changed(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the sums that are not zero."""
    flat = sums.ravel()
    at = np.flatnonzero(flat)
    return at.astype(np.int32), flat[at]


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every center."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centers).max(initial=0)))
    if x.shape[1] * most * most < 1 << 50:  # then every sum is a whole number that doubles hold
        a, b = x.astype(np.float64), centers.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centers], axis=1)


def own_distance(x: np.ndarray, centers: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to its own center."""
    return ((x - centers[own]) ** 2).sum(1)


def nearest_two(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest center of every row (ties: the smaller number) and the distances (not squared) to it and to the next."""
    d = distances(x, centers)
    own = d.argmin(1)
    rows = np.arange(len(x))
    upper = np.sqrt(d[rows, own].astype(np.float64))
    if len(centers) == 1:
        return own, upper, np.full(len(x), np.inf)
    d[rows, own] = np.iinfo(np.int64).max
    return own, upper, np.sqrt(d.min(1).astype(np.float64))


def moved_to(centers: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each center replaced by ``floor(total / count)``; those of no vectors stay."""
    return np.where(counts[:, None] > 0, totals // np.maximum(counts, 1)[:, None], centers)


def first_vectors(vectors: DataFrame, order: list[Column], k: int, scale: int) -> np.ndarray:
    """The integer components of the ``k`` first vectors in the given order (ties: the smaller vector)."""
    rows = vectors.orderBy(*order, "vec").limit(k).select("vec").collect()
    return np.array([scaled(np.array(r["vec"], dtype=np.float64), scale) for r in rows], dtype=np.int64)


def named(df: DataFrame, id_col: str, vec_col: str, label_col: str | None = None) -> DataFrame:
    """``id, label, vec``, whatever other columns there are."""
    label = F.lit(None).cast("int") if label_col is None else col(label_col)
    return df.select(col(id_col).alias("id"), label.alias("label"), col(vec_col).alias("vec"))
