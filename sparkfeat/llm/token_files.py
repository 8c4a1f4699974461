"""Token ids in Parquet list columns that can be read selectively."""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfeat.llm.common import col

#: Bytes of a row group, rows of a page at most (the grain of the page index).
ROW_GROUP_BYTES, PAGE_ROWS = 16 << 20, 1000
#: Runs whose ids a worker remembers (twice as many at most), bytes of text encoded at once, runs joined for one call.
REMEMBERED, PART_BYTES, JOINED = 150_000, 4 << 20, 1000
#: Rows of a batch between Spark and Python while token lists are written.
BATCH_ROWS = 1000

#: Suffix of the tokens that end a word, in tokenizers that have one.
WORD_END = "</w>"

#: A Latin word with marks after it: letters and marks are encoded apart, the letters without case.
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?|\-()\"#*$%&/=+]*)$"


class Memory:
    """Ids by piece in two generations: what is not used while the young one fills up is forgotten."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, pieces: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The ids of each piece, and the places of those that must be learned (None so far)."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, pieces))
        new = []
        for i in [i for i, x in enumerate(found) if x is None]:
            known = self.old.get(pieces[i])
            if known is None:
                new.append(i)
            else:
                found[i] = self.young[pieces[i]] = known
        return found, new


def gather(flat: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``codes`` of ``flat`` one after the other (piece k has ``size[k]`` numbers), and their sizes."""
    start = np.cumsum(size) - size
    n = size[codes]
    at = np.arange(n.sum()) + np.repeat(start[codes] - (np.cumsum(n) - n), n)
    return flat[at], n


class Encoder:
    """Encodes texts with a tokenizers file.

    ``by_words`` is for tokenizers that drop white space, ignore case and encode each run of
    letters and each run of marks on its own: texts are then cut into words, and the ids of
    each different run are looked up once and remembered. Texts that may hold one of the
    file's own control strings are always encoded as a whole.
    """

    def __init__(self, definition: str, by_words: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_words = by_words
        self.control = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids of tokens that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _ids(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of runs of letters or marks: many are encoded as one text and cut where a word ends."""
        out: list[bytes] = []
        parts = [pieces[i : i + JOINED] for i in range(0, len(pieces), JOINED)]
        found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, e in zip(parts, found):
            ids = np.array(e.ids, dtype="<u4")
            edges = [0, *(np.flatnonzero(self.last[ids]) + 1).tolist()]
            if len(edges) != len(part) + 1:  # some piece is not one run to this tokenizer
                out += self._ids(part)
                continue
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
        return out

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, one after the other, and how many each has."""
        cut = pc.extract_regex(words, PLAIN)
        letters, marks = pc.utf8_lower(pc.struct_field(cut, "letters")), pc.struct_field(cut, "marks")
        plain = cut.is_valid().to_numpy(zero_copy_only=False)
        # Each word is two pieces: letters and marks, or the whole of an odd word and nothing.
        first = pc.if_else(cut.is_valid(), letters, words)
        coded = pa.concat_arrays([first, pc.fill_null(pc.if_else(cut.is_valid(), marks, ""), "")]).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each first
        raw, new = self.memory.look_up(pieces)
        if new:
            odd = set(words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False))
            for places, encode in (
                ([i for i in new if pieces[i] and pieces[i] not in odd], self._piece_ids),
                ([i for i in new if not pieces[i] or pieces[i] in odd], self._ids),
            ):
                for i, ids in zip(places, encode([pieces[i] for i in places])):
                    raw[i] = self.memory.young[pieces[i]] = ids
        flat = np.frombuffer(b"".join(raw), dtype="<u4")
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        two = coded.indices.to_numpy().reshape(2, -1).T.ravel()
        out, n = gather(flat, size, two)
        return out, n[0::2] + n[1::2]

    def encode(self, texts: pa.Array, end: np.ndarray) -> pa.Array:
        """The ids of each text as a list, with ``end`` after them; a null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        room = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // PART_BYTES
        cuts = np.flatnonzero(np.diff(room, prepend=-1, append=-1)) if len(texts) else [0, 0]
        parts = [self._encode(texts.slice(a, b - a), end) for a, b in zip(cuts, cuts[1:])]
        return pa.concat_arrays(parts) if len(parts) != 1 else parts[0]

    def _encode(self, texts: pa.Array, end: np.ndarray) -> pa.Array:
        whole = np.full(len(texts), not self.by_words)
        for control in self.control if self.by_words else []:
            whole |= pc.match_substring(texts, control).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        split = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        flat, size = self._word_ids(coded.dictionary)
        ids, n = gather(flat, size, coded.indices.to_numpy())
        offsets = split.offsets.to_numpy()
        ends = np.concatenate([[0], np.cumsum(n)])[offsets - offsets[0]]
        if whole.any():
            held = [ids[a:b] for a, b in zip(ends, ends[1:])]
            odd = np.flatnonzero(whole)
            for i, raw in zip(odd, self._ids(texts.take(pa.array(odd)).to_pylist())):
                held[i] = np.frombuffer(raw, dtype="<u4")
            ids, ends = np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])
        after = ends + len(end) * np.arange(len(ends))
        out = np.empty(after[-1], dtype="<u4")
        mine = np.ones(len(out), dtype=bool)
        for k, x in enumerate(end):
            out[after[1:] - len(end) + k] = x
            mine[after[1:] - len(end) + k] = False
        out[mine] = ids
        return pa.ListArray.from_arrays(pa.array(after, pa.int32()), pa.array(out.view("<i4")))


def _worker_encoder(definition: str, by_words: bool) -> Encoder:
    """The worker process's encoder, kept from task to task with the words it remembers."""
    state = sys.modules.setdefault("sparkfeat_worker_state", types.ModuleType("sparkfeat_worker_state"))
    known = state.__dict__.setdefault("encoders", {})
    key = (zlib.crc32(definition.encode()), by_words)
    if key not in known:
        known[key] = Encoder(definition, by_words)
    return known[key]


def token_ids(text: Column, definition: str, by_words: bool, end_id: int | None) -> Column:
    """The ids of the whole text as a list, with ``end_id`` after them unless it is None."""
    end = np.array([] if end_id is None else [end_id], dtype="<u4")

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _worker_encoder(definition, by_words)
        for texts in batches:
            yield encoder.encode(texts, end)

    return encode(text)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    by_words: bool = False,
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write ``doc_id, n_tokens, ids`` in ascending order of the id, one file per range of ids.

    ``encoding`` is ``dictionary`` (ids packed to the bits that a row group's distinct ids
    need) or ``delta`` (differences packed in blocks). Row groups and pages are kept small
    and every column has a page index, so a reader of some ids, or of the metadata columns
    alone, skips the other pages. Ranges are cut by id and then by a hash of the text, so an
    id with very many rows is spread over files; rows of the same id are in the order of that
    hash. Nulls come first; a null text is empty and holds only the end id.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"no encoding {encoding!r}")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), F.xxhash64(col(text_col)).alias("order"))
    ranged = rows.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order")
    coded = ranged.select("doc_id", token_ids(F.col("text"), definition, by_words, end_id).alias("ids"))
    writer = coded.select("doc_id", F.size("ids").alias("n_tokens"), "ids").write.options(
        **{
            "compression": "zstd",
            "parquet.block.size": str(row_group_bytes),
            "parquet.page.row.count.limit": str(page_rows),
            "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
            "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        }
    )
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        writer.parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Batches of at most ``n`` rows between Spark and Python in jobs that run meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(n, int(before)) if int(before) > 0 else n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, start``: where each document's ids begin in the whole sequence; no ids are read."""
    rows = spark.read.parquet(path).select("doc_id", "n_tokens", "_metadata.file_name", "_metadata.row_index")
    return with_starts(rows).select("doc_id", "n_tokens", "start")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` of the ids from ``first`` to ``last``; pages outside are not read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows


def with_starts(rows: DataFrame) -> DataFrame:
    """Rows ``(file_name, row_index, n_tokens, ...)`` with ``start``, the tokens of all rows before.

    Sums run inside each file and go on from the files before it; only one number per file
    is added up in one place.
    """
    n = F.col("n_tokens").cast("bigint")
    files = rows.groupBy("file_name").agg(F.sum(n).alias("total"))
    before = Window.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file_name", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("file_name").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("local", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    return local.join(offsets, "file_name").withColumn("start", F.col("offset") + F.col("local")).drop("offset", "local")


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit numbers."""

    @F.arrow_udf("long")
    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            flat = memoryview(lists.values.to_numpy().astype("<i4", copy=False)).cast("B")
            ends = (lists.offsets.to_numpy() * 4).tolist()
            yield pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())

    return crc(ids)
