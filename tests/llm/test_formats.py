"""Token files and chat windows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkfeat.llm import token_files
from sparkfeat.llm.chat import escape, format_windows, read_windows, unescape
from sparkfeat.llm.queries import AWKWARD, QUERIES
from sparkfeat.llm.token_files import Encoder, read_metadata, read_tokens, write_tokens
from tests.llm.conftest import docs_frame

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "it's DON'T we'll 'S x's",
    "Σας ΟΔΟΣ İx ŸÿÞ ß ẞ",
    "a<|endoftext|>b <|startoftext|>",
    "́b é Å x y\tz\r\n\x0b",
    "日本語 123 4a5b 😀",
    "",
    "   \n",
    'foo-bar (baz) "q" a/b=c+d',
    "ﬁ ǅ ŉ ª º",
    "x\x1cy\x85z",
    "word, Word. WORD!! word",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_word_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    monkeypatch.setattr(token_files, "PART_BYTES", 40)
    monkeypatch.setattr(token_files, "JOINED", 3)
    encoder = Encoder(open(FILE, encoding="utf-8").read(), by_words=True)
    texts = ODD * 3 + [None]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for end in ([], [1], [7, 8]):
        got = encoder.encode(pa.array(texts), np.array(end, dtype="<u4"))
        assert got.to_pylist() == [ids + end for ids in want]
    assert encoder.encode(pa.array([], pa.string()), np.array([1], dtype="<u4")).to_pylist() == []
    assert encoder.encode(pa.array([None, None], pa.string()), np.array([1], dtype="<u4")).to_pylist() == [[1], [1]]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_round_trip(spark, awkward, tokenizer, tmp_path, encoding):
    rows = [(i + 10, t, "en", "a") for i, t in enumerate(ODD)]
    df = awkward.unionByName(docs_frame(spark, rows))
    path = str(tmp_path / encoding)
    write_tokens(df, path, FILE, by_words=True, encoding=encoding, page_rows=5)
    want = sorted((r.doc_id is not None, r.doc_id or 0, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in df.collect())
    files = sorted((tmp_path / encoding).glob("part-*.parquet"))
    got = [(i is not None, i or 0, ids) for f in files for i, ids in zip(*(pq.read_table(f)[c].to_pylist() for c in ("doc_id", "ids")))]
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)
    assert sorted(got) == want
    column = pq.ParquetFile(files[-1]).metadata.row_group(0).column(2)
    assert column.has_offset_index and ("DICTIONARY" in str(column.encodings)) == (encoding == "dictionary")
    if encoding == "delta":
        assert "DELTA_BINARY_PACKED" in column.encodings
    part = read_tokens(spark, path, 4, 6)
    assert sorted(r.doc_id for r in part.collect()) == [4, 5, 5, 6]
    assert "GreaterThanOrEqual(doc_id,4)" in part._jdf.queryExecution().toString()
    meta = read_metadata(spark, path)
    starts = sorted((r.start, r.n_tokens) for r in meta.collect())
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts]).tolist()[:-1]]
    schemas = [x for x in meta._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]]
    assert schemas and all("ids" not in x.split(">")[0] for x in schemas)


def test_files_of_no_rows(spark, none, tmp_path):
    write_tokens(none, str(tmp_path / "x"), FILE)
    assert read_metadata(spark, str(tmp_path / "x")).count() == 0
    with pytest.raises(ValueError):
        write_tokens(none, str(tmp_path / "y"), FILE, encoding="other")


def test_token_query_against_the_tokenizer(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want, at = {}, 0
    for i, text in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_token_files"](spark, sf).collect()} == want


def test_escapes_are_reversible(spark):
    texts = [AWKWARD, "&lt; &amp;amp; <|end|>", "<|user|>a[b]c", "", "&", "é😀 &lsqb;"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", escape(F.col("text")).alias("e"))
    for r in df.select("text", "e", unescape(F.col("e")).alias("back")).collect():
        assert r.back == r.text and not set("<>[]") & set(r.e)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, first string, at int")


def check(df, budget, history):
    """Windows keep every turn once, in order, fit the budget, and learn each answer once."""
    windows = format_windows(df, budget=budget, history=history)
    read = {(r.conv_id, r.first_turn): r for r in read_windows(windows).collect()}
    rows = {}
    for r in df.collect():
        rows.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    by_conv = {}
    for w in sorted(windows.collect(), key=lambda w: (w.conv_id is not None, w.conv_id or 0, w.first_turn)):
        by_conv.setdefault(w.conv_id, []).append(w)
        assert w.tokens <= budget or w.over_budget
        assert not w.over_budget or w.n_new == 1 or (w.first_turn == 0 and w.n_new == 2)
        assert w.n_repeated <= history + 1
    assert set(by_conv) == set(rows)
    for conv, own in rows.items():
        own.sort()
        told = [t for w in by_conv[conv] for t in read[conv, w.first_turn].turns]
        assert [(t.role, t.text) for t in told] == [r[2:] for r in own]
        learned = [x for w in by_conv[conv] for x in read[conv, w.first_turn].learned]
        assert learned == [r[3] for r in own if r[2] == "assistant"]
        if own[0][2] == "system":
            assert all("<|system|>" in w.text for w in by_conv[conv])
    return windows


def test_windows(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(12):
        first = rng.random() < 0.5
        for turn in range(rng.randint(1, 200 if conv == 5 else 12)):
            role = "system" if first and turn == 0 else rng.choice(["user", "assistant", "<|end|>"])
            rows.append((conv, turn, role, " ".join(rng.choice(["a", "<b>", "[INST]", "é"]) for _ in range(rng.randint(0, 30)))))
    df = conversations(spark, rows)
    for budget, history in ((60, 2), (20, 1), (100_000, 3), (40, 0)):
        windows = check(df, budget, history)
        if budget == 100_000:
            assert windows.count() == 12 and windows.filter("n_repeated > 0").count() == 0
        elif history:
            assert windows.filter("n_repeated > 0").count() > 0


def test_windows_of_awkward_rows(spark):
    rows = [
        (1, 0, None, None),
        (1, None, "assistant", "no number"),
        (1, 1, "assistant", "same"),
        (1, 1, "assistant", "same"),
        (1, 1, "user", ""),
        (None, 0, "user", "nobody's"),
        (None, None, "assistant", None),
        (2, 5, "assistant", "w " * 20_000),
        (3, 0, "system", "s " * 100),
        (3, 1, "user", "hi"),
        (3, 2, "assistant", AWKWARD),
    ]
    check(conversations(spark, rows), 50, 2)
    assert format_windows(conversations(spark, [])).count() == 0


def test_chat_query_against_plain(spark):
    sf = "/root/testdata/sf0.001"
    convs = {-1: [(0, "user", AWKWARD), (1, "assistant", AWKWARD)]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for conv, turns in convs.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learned), sha(learned))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op8_chat"](spark, sf).collect()}
    assert got == want
