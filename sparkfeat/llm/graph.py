"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import kept

#: Edges for each task of a round, and tasks of a round at least, so that few edges do not become very many tiny files.
EDGES_PER_TASK, LEAST_TASKS = 50_000, 8


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges run from a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.coalesce(tasks).unionByName(least.select("a", F.col("m").alias("b")).coalesce(tasks)).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the smallest node reachable.

    Each round halves the depth of a component, so a chain of n nodes takes about log2(n)
    rounds; the rounds end when the edges no longer change. Rows combine before each
    shuffle and a node of very many edges is on the splittable side of a join. A round runs in
    as many tasks as its edges need. Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = kept(edges)
    before = _state(edges)
    while before[0]:
        tasks = max(LEAST_TASKS, -(-before[0] // EDGES_PER_TASK))
        edges = kept(_small_star(_large_star(edges.coalesce(tasks)).coalesce(tasks), tasks).coalesce(tasks))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
