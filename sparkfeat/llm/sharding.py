"""Sharding by extendible hashing: only buckets over the byte limit split on a further bit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, free_name, kept

#: Bits of a code: 32 from the key, 28 from key and text.
BITS = 60
#: Bits counted beyond those that even shards would need, and bits of each further round.
MARGIN, STEP = 4, 8
#: Directory cells (of about 40 bytes) that are broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 100_000


def hash_code(key: Column, text: Column) -> Column:
    """The 60-bit hash whose leading bits index the directory.

    It starts with bits of the key alone and goes on with bits of key and text, so rows that
    share a key (or have none) still split.
    """
    k = F.coalesce(key.cast("string"), F.lit(""))
    own, both = F.md5(k), F.md5(F.concat(k, F.lit("\x1f"), F.coalesce(text, F.lit(""))))
    digits = F.concat(F.substring(own, 1, 8), F.substring(both, 1, 7))
    return F.conv(digits, 16, 10).cast("bigint")


def _prefix(code: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", code, (F.lit(BITS) - depth).cast("int"))


def _nodes(rows: DataFrame, shallow: int, deep: int) -> DataFrame:
    """Bytes, rows and code range of every bucket at depths ``shallow`` to ``deep``.

    Rows combine to the deepest buckets first, which then add up to the shallower ones.
    """
    cells = rows.groupBy(_prefix(F.col("code"), deep).alias("cell")).agg(
        F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    levels = F.explode(F.sequence(F.lit(shallow), F.lit(deep))).alias("depth")
    up = F.call_function("shiftright", F.col("cell"), (F.lit(deep) - F.col("depth")).cast("int"))
    return (
        cells.select("*", levels)
        .groupBy("depth", up.alias("prefix"))
        .agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    )


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The shards of rows ``(code, size)``: per round ``(depth of the cells, shards)``.

    A shard ``(depth, prefix, size, n, single)`` is the shortest hash prefix whose rows fit
    ``limit`` bytes, or whose rows all have one code (``single``: no bit can split it). The
    first round counts to the depth that even shards need and a few bits more; only buckets
    that are still too full are counted deeper.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    rows = rows.select("code", "size", F.lit(1).cast("bigint").alias("n"), F.col("code").alias("low"), F.col("code").alias("high"))
    shallow, deep = 0, min(BITS, int(total // limit).bit_length() + MARGIN)
    rounds = []
    pair = Window.partitionBy("depth", F.call_function("shiftright", F.col("prefix"), F.lit(1)))
    while True:
        parent_fits = (F.sum("size").over(pair) <= limit) | (F.min("low").over(pair) == F.max("high").over(pair))
        nodes = _nodes(rows, shallow, deep).select(
            "*",
            ((F.col("size") <= limit) | (F.col("low") == F.col("high"))).alias("fits"),
            # What is counted in a later round has a parent that was too full.
            (F.when(F.col("depth") == shallow, False).otherwise(parent_fits)).alias("parent_fits"),
        )
        nodes = kept(nodes.filter(~F.col("parent_fits") & (F.col("fits") | (F.col("depth") == deep))))
        leaves = nodes.filter("fits").select("depth", "prefix", "size", "n", (F.col("low") == F.col("high")).alias("single"))
        rounds.append((deep, leaves))
        full = nodes.filter("not fits").select("prefix")
        if full.isEmpty():
            return rounds
        cell = _prefix(F.col("code"), deep)
        rows = kept(rows.join(full, cell == full["prefix"], "left_semi"))
        shallow, deep = deep + 1, min(BITS, deep + STEP)


def _cells(leaves: DataFrame, deep: int) -> DataFrame:
    """Every cell of depth ``deep`` with the shard it belongs to."""
    spread = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(deep) - F.col("depth")).cast("int"))
    first = F.col("prefix") * spread
    return leaves.select("*", F.explode(F.sequence(first, first + spread - 1)).alias("cell"))


def assign_shards(
    docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", out: str = "shard"
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``label, size, n``.

    ``label`` is the shard's hash prefix as bits (empty while one shard holds all), ``size``
    and ``n`` are the bytes of text and the rows of the whole shard. A shard holds at most
    ``limit`` bytes unless it is one row that is longer. Rows of a null id or text hash like
    empty strings; a null or empty text has 0 bytes. Rows with the same id and the same text
    have the same code: where they exceed the limit together they are dealt by number to
    shards named ``label-k``. An empty table stays empty. All columns of ``docs`` pass
    through and ``out`` may not be one of them.
    """
    if limit < 1:
        raise ValueError("a shard needs at least one byte")
    if free_name(docs, out) != out:
        raise ValueError(f"the documents already have a column {out!r}")
    code = hash_code(col(id_col), col(text_col))
    size = F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("bigint")
    rounds = directory(kept(docs.select(code.alias("code"), size.alias("size"))), limit)
    code_col = free_name(docs, "__code")
    rows = docs.withColumn(code_col, code)
    found = []
    for deep, leaves in rounds:
        own = free_name(docs, f"__shard_{deep}")
        shard = F.struct(
            F.right(F.lpad(F.bin("prefix"), BITS, "0"), F.col("depth")).alias("label"), "size", "n", "single"
        )
        cells = _cells(leaves, deep).select(F.col("cell").alias(own + "_cell"), shard.alias(own))
        small = leaves.agg(F.sum(F.expr(f"pow(2, {deep} - depth)"))).first()[0] or 0
        cells = F.broadcast(cells) if small <= BROADCAST_CELLS else cells
        rows = rows.join(cells, _prefix(F.col(code_col), deep) == F.col(own + "_cell"), "left").drop(own + "_cell")
        found.append(own)
    shard = F.coalesce(*[col(c) for c in found])
    crowd = (shard["size"] > limit) & (shard["n"] > 1)
    names = [col(c) for c in docs.columns]
    plain = F.struct(shard["label"].alias("label"), shard["size"].alias("size"), shard["n"].alias("n"))
    crowded = [leaves.filter((F.col("size") > limit) & (F.col("n") > 1)) for _, leaves in rounds]
    if all(c.isEmpty() for c in crowded):
        return rows.select(*names, plain.alias(out))
    twins = _deal(rows.filter(crowd).select(*names, shard.alias(out)), out, limit)
    return rows.filter(~crowd).select(*names, plain.alias(out)).unionByName(twins)


def _deal(twins: DataFrame, out: str, limit: int) -> DataFrame:
    """Rows that share a code, dealt to as many shards as their bytes need.

    They are stored first, so that each keeps its partition; numbers run within a partition
    and go on from those before it, and no task sees all rows of a code.
    """
    part, order = free_name(twins, "__part"), free_name(twins, "__order")
    names = [col(c) for c in twins.columns if c != out]
    rows = kept(twins).withColumn(part, F.spark_partition_id()).withColumn(order, F.monotonically_increasing_id())
    label = col(out)["label"]
    here = rows.groupBy(label.alias("label"), col(part).alias("p")).agg(F.count("*").alias("held"))
    before = Window.partitionBy("label").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select(
        F.col("label").alias("__label"), F.col("p").alias("__p"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("__off")
    )
    local = F.row_number().over(Window.partitionBy(part, label).orderBy(order)) - 1
    numbered = rows.withColumn(order, local).join(
        offsets, (label == F.col("__label")) & (col(part) == F.col("__p"))
    )
    one = F.expr(f"`{out}`.size div `{out}`.n")
    each = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / one))
    k = F.floor((col(order) + F.col("__off")) / each)
    n = F.least(each, col(out)["n"] - k * each)
    dealt = F.struct(
        F.concat(label, F.lit("-"), k.cast("string")).alias("label"), (n * one).alias("size"), n.alias("n")
    )
    return numbered.select(*names, dealt.alias(out))
