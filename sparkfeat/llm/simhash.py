"""SimHash near-duplicates: fingerprints, pigeonhole blocks, groups of linked documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import LOWER, col, free_name, kept
from sparkfeat.llm.graph import components

SEED = 42
BITS = 64
#: Hashes that are unpacked to bits at once.
CHUNK = 1 << 15
#: Buckets up to this many fingerprints are compared pair by pair; larger ones by neighbours.
PAIRED = 32


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the text's word shingles as a signed 64-bit number.

    A-Z are lower-cased, words are runs without ASCII white space, repeated shingles count
    as often as they occur. A text of fewer words is one shingle; one without words gives 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[width - 1 :])], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    """The fingerprint as a column, computed in Arrow batches.

    It is marked as if it could change, so that the null check of a join on it does not
    compute it a second time.
    """

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return prints.asNondeterministic()(text)


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``max_bits + 2`` blocks: any close pair has two blocks in common."""
    n = max_bits + 2
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _piece(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _mask(blocks: list[tuple[int, int]]) -> int:
    mask = sum(((1 << w) - 1) << low for low, w in blocks)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _signed_bit(k: int) -> int:
    return 1 << k if k < 63 else -(1 << 63)


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs at ``max_bits`` differing bits or fewer.

    ``prints`` holds distinct fingerprints ``fp``. The bits are cut into ``max_bits + 2``
    blocks; a close pair agrees in two of them at least, so fingerprints are joined on every
    pair of blocks and the distance is verified. A bucket with many fingerprints (a family of
    near copies) is not compared pair by pair: its members are linked through shared
    neighbours. Two fingerprints are within d bits just when some value is within
    ceil(d / 2) bits of one and floor(d / 2) of the other, so each member emits the values
    around it, and a small group forms at each value. No pair is lost either way.
    """
    blocks = _blocks(max_bits)
    pairs = list(combinations(range(len(blocks)), 2))
    keys = F.array(
        *[
            F.struct(
                F.lit(n).alias("part"),
                F.col("fp").bitwiseAND(F.lit(_mask([blocks[i], blocks[j]]))).alias("bucket"),
            )
            for n, (i, j) in enumerate(pairs)
        ]
    )
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.part", "k.bucket")
    sizes = keyed.groupBy("part", "bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = kept(keyed.join(sizes, ["part", "bucket"]))
    small = shared.filter(F.col("size") <= PAIRED)
    near = (
        small.alias("x")
        .join(small.alias("y"), ["part", "bucket"])
        .filter("x.fp < y.fp")
        .filter(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits)
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    return near.unionByName(_around(shared.filter(F.col("size") > PAIRED), blocks, pairs, max_bits)).distinct()


def _around(crowded: DataFrame, blocks: list, pairs: list, max_bits: int) -> DataFrame:
    """Links inside crowded buckets through values near two members; exact for 1 or 2 bits.

    Bits of the shared blocks agree, so only the other blocks' bits are flipped. A value has
    no more members around it than bits to flip plus one, so its group is small.
    """
    if max_bits > 2:
        raise ValueError("crowded buckets are linked through single flips, which reach 2 bits")
    values = None
    for n, pair in enumerate(pairs):
        free = [low + k for i, (low, w) in enumerate(blocks) if i not in pair for k in range(w)]
        flips = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed_bit(k)).cast("bigint") for k in free])
        values = F.when(F.col("part") == n, flips) if values is None else values.when(F.col("part") == n, flips)
    stars = (
        crowded.select("part", "fp", F.explode(values).alias("flip"))
        .groupBy("part", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
        .agg(F.collect_set("fp").alias("members"))
        .filter(F.size("members") > 1)
    )
    member = F.explode("members").alias("b")
    if max_bits < 2:  # two members around one value may differ in two bits: keep verified links only
        wide = stars.select(F.explode("members").alias("a"), "members").select("a", member)
        return wide.filter("a < b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return stars.select(F.array_min("members").alias("a"), member).filter("a <> b")


def groups_of(rows: DataFrame, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fp, root, least, winners`` for every fingerprint of the rows ``(doc_id, fp)``.

    ``link`` gives the edges of the distinct fingerprints. ``root`` names the component, ``least`` is its smallest id (null if all are) and
    ``winners`` counts its rows that have that id.
    """
    held = rows.groupBy("fp", "doc_id").agg(F.count("*").alias("n"))
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n"))
    prints = kept(held.groupBy("fp").agg(lowest.alias("low")).select("fp", F.col("low.doc_id").alias("first"), "low.n"))
    roots = components(link(prints.select("fp"))).withColumnRenamed("node", "fp")
    linked = kept(prints.join(roots, "fp"))
    sums = linked.groupBy("root", "first").agg(F.sum("n").alias("n"))
    lowest = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "n"))
    best = sums.groupBy("root").agg(lowest.alias("low")).select("root", F.col("low.first").alias("least"), F.col("low.n").alias("winners"))
    named = linked.join(best, "root").select("fp", "root", "least", "winners")
    alone = prints.join(roots, "fp", "left_anti")
    return named.unionByName(
        alone.select("fp", F.col("fp").alias("root"), F.col("first").alias("least"), F.col("n").alias("winners"))
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is the SimHash in 16 hex digits. Documents whose fingerprints differ in
    ``max_bits`` bits or fewer are linked, and ``component_id`` is the smallest id that links
    lead to, itself included. A null or blank text has fingerprint zero and is linked like
    any other. Rows with a null id take part and get their component's smallest id (null if
    it has none); repeated rows stay repeated; an empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    rows = kept(docs.select(col(id_col).alias("doc_id"), fingerprint_column(col(text_col), shingle).alias("fp")))
    out = rows.join(groups_of(rows, lambda p: links(p, max_bits)), "fp")
    digits = F.lower(F.lpad(F.hex("fp"), BITS // 4, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), F.col("least").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One document of each group of near duplicates, with all columns of ``docs``.

    The row with the group's smallest id stays; if several rows have it (repeated rows, or a
    group without any id), one of them. Null and blank texts are one group. The fingerprints
    are computed a second time for the rows that are joined, which is cheaper than to store
    the texts once more.
    """
    rows = kept(docs.select(col(id_col).alias("doc_id"), fingerprint_column(col(text_col), shingle).alias("fp")))
    groups = groups_of(rows, lambda p: links(p, max_bits))
    return one_of_each(docs, id_col, fingerprint_column(col(text_col), shingle), groups)


def one_of_each(docs: DataFrame, id_col: str, print_of: Column, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, by the result of ``groups_of`` and the column of fingerprints."""
    fp, root, least, winners = (free_name(docs, n) for n in ("__fp", "__root", "__least", "__winners"))
    groups = kept(groups.toDF(fp, root, least, winners))
    named = docs.withColumn(fp, print_of).join(groups, fp)
    won = named.filter(col(id_col).eqNullSafe(col(least)))
    names = [col(c) for c in docs.columns]
    if groups.filter(col(winners) > 1).isEmpty():
        return won.select(*names)
    single = won.filter(col(winners) == 1).select(*names)
    return single.unionByName(won.filter(col(winners) > 1).dropDuplicates([root]).select(*names))
