from __future__ import annotations

import random
import re
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from sparkfeat.llm import simhash
from sparkfeat.llm.graph import components
from sparkfeat.llm.simhash import drop_near_duplicates, fingerprint, links, near_duplicates

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, max_bits):
    """Smallest member per fingerprint, by comparing all pairs."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(prints, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def signed(p):
    return p - 2**64 if p >= 2**63 else p


def family(seed, n, size):
    """Fingerprints of which many are one or two flips from a common one."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(size):
            p = centre
            for _ in range(rng.randint(0, 2)):
                p ^= 1 << rng.randrange(64)
            out.add(p)
    return [signed(p) for p in out]


def test_fingerprint_against_plain():
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "one two", "A b C"]
    texts += [" ".join(rng.choice(["Ä", "the", "OF", "x", "é😀"]) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    for width in (1, 3, 5):
        for t in texts:
            assert fingerprint(t, width) % 2**64 == plain_fingerprint(t, width)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(500))
    whole = fingerprint(text, 3)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(text, 3) == whole


def test_links_in_sparse_and_crowded_buckets(spark):
    for bits, size in ((2, 10), (2, 150), (1, 150), (0, 5)):
        prints = family(bits + size, 50, size)
        df = spark.createDataFrame([(p,) for p in prints], "fp long")
        got = {r.node: r.root for r in components(links(df, bits)).collect()}
        want = classes(prints, bits)
        groups = {}
        for p in prints:
            groups.setdefault(got.get(p, p), set()).add(p)
        wanted = {}
        for p, r in want.items():
            wanted.setdefault(r, set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_awkward_rows(awkward, none):
    got = near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[1].fingerprint == "0" * 16
    assert sorted(r.component_id for r in got if r.doc_id is None) == [1, 5]
    assert all(by_id[i].component_id == i for i in (4, 6, 7, 8))
    assert near_duplicates(none).count() == 0


def test_one_row_of_each_group_stays(awkward, none, spark):
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 8]
    assert drop_near_duplicates(none).count() == 0
    unnamed = awkward.filter(F.col("doc_id").isNull()).unionByName(awkward.filter(F.col("doc_id").isNull()))
    assert drop_near_duplicates(unnamed).count() == 2


def test_queries_against_all_pairs(spark):
    from sparkfeat.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t, 3) for i, t in docs.items()}
    groups = classes(sorted(set(prints.values())), 2)
    least = {}
    for i, p in prints.items():
        least[groups[p]] = min(i, least.get(groups[p], i))
    want = {i: (f"{p:016x}", least[groups[p]]) for i, p in prints.items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, sf).collect()}
    assert got == want
