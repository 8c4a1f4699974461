"""Centroid clustering and vector codes against plain steps over all vectors."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from sparkfeat.llm import centroids, product_codes, vector_blocks
from sparkfeat.llm.centroids import cluster_vectors, inertias
from sparkfeat.llm.product_codes import compress_vectors, displacements

SCHEMA = "vec_id long, embedding array<double>, label int, id long, vec string, cluster int, state string"


def frame(spark, rows):
    """Vectors from (id, vector, label), with extra columns named like the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def whole(vec, scale):
    return [int(np.floor(scale * x)) for x in vec]


def usable(vec, length=None):
    return bool(vec) and (length is None or len(vec) == length) and all(x is not None and np.isfinite(x) for x in vec)


def squared(a, b):
    return sum((p - q) ** 2 for p, q in zip(a, b))


def plain_lloyd(points, centers, rounds):
    def assign():
        return [min(range(len(centers)), key=lambda k: (squared(p, centers[k]), k)) for p in points]

    for _ in range(rounds):
        own = assign()
        for k in range(len(centers)):
            mine = [p for p, o in zip(points, own) if o == k]
            if mine:
                centers[k] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    return own, [squared(p, centers[o]) for p, o in zip(points, own)], centers


def mixed_rows(seed, n, length):
    rng = random.Random(seed)
    hubs = [[rng.gauss(0, 0.3) for _ in range(length)] for _ in range(6)]
    rows = [(i, [h + rng.gauss(0, 0.1) for h in rng.choice(hubs)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(7, list(rows[7][1]), 1)] * 3 + [(None, list(rows[9][1]), 0), (n + 1, [0.25] * length, None), (n + 2, [0.25] * length, 1)]
    rows += [(n + 3, None, 1), (n + 4, [], 1), (n + 5, [None] + [0.5] * (length - 1), 1)]
    rows += [(n + 6, [float("nan")] * length, 0), (n + 7, [float("inf")] + [0.0] * (length - 1), 0)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_against_plain_steps(spark, monkeypatch, seed):
    monkeypatch.setattr(vector_blocks, "ROWS", 40)
    rows = mixed_rows(seed, 260, 64) + [(900, [0.5] * 63, 1), (901, [0.5] * 65, 1)]
    got, centers = cluster_vectors(frame(spark, rows), rounds=5)
    kept = [(i, whole(v, 64)) for i, v, _ in rows if usable(v, 64)]
    seeds = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:16]
    own, far, want = plain_lloyd([v for _, v in kept], [v for _, v in seeds], 5)
    assert centers.tolist() == want
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted([(i, o, d) for (i, _), o, d in zip(kept, own, far)], key=key)
    assert inertias(got) == {k: sum(d for o, d in zip(own, far) if o == k) for k in set(own)}


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_against_plain_steps(spark, monkeypatch, seed):
    monkeypatch.setattr(vector_blocks, "ROWS", 40)
    rows = mixed_rows(seed, 200, 24) + [(900, [0.5] * 16, 1), (901, [0.5] * 23, 1)]
    got, books = compress_vectors(frame(spark, rows), label_col="label")
    kept = [(i, whole(v, 4096), label) for i, v, label in rows if usable(v, 24)]
    first = [v for _, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: r[:2])[:16]]
    code, error = [""] * len(kept), [0] * len(kept)
    for p in range(8):
        cut = slice(3 * p, 3 * p + 3)
        own, far, want = plain_lloyd([v[cut] for _, v, _ in kept], [v[cut] for v in first], 6)
        assert books[p].tolist() == want
        code = [c + f"{o:02x}" for c, o in zip(code, own)]
        error = [e + d for e, d in zip(error, far)]
    key = lambda r: tuple((x is None, x or 0) for x in r[:2]) + r[2:]
    want = [(i, label, c, e) for (i, _, label), c, e in zip(kept, code, error)]
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted(want, key=key)


def test_large_components_are_exact_and_larger_ones_refused(spark):
    rows = [(i, [1.0e6 + i, -1.0e6 * (i % 3)], None) for i in range(30)]
    got, centers = cluster_vectors(frame(spark, rows), k=4, length=2)
    points = [whole(v, 64) for _, v, _ in rows]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in enumerate(points))[:4]
    own, far, want = plain_lloyd(points, [v for _, v in seeds], 3)
    assert centers.tolist() == want
    assert sorted(tuple(r) for r in got.collect()) == sorted(zip(range(30), own, far))
    with pytest.raises(Exception, match="a component beyond"):
        cluster_vectors(frame(spark, [(1, [1e30, 0.0], None)]), length=2)


def test_few_vectors_and_none(spark):
    empty = frame(spark, [])
    rows, centers = cluster_vectors(empty)
    assert rows.collect() == [] and rows.columns == ["id", "cluster", "distance"] and len(centers) == 0
    rows, books = compress_vectors(empty, label_col="label")
    assert rows.collect() == [] and rows.columns == ["id", "label", "code", "error"] and books.size == 0
    same = frame(spark, [(3, [0.5] * 64, 1)] * 5)
    rows, centers = cluster_vectors(same)
    assert [tuple(r) for r in rows.collect()] == [(3, 0, 0)] * 5 and centers.shape == (5, 64)
    rows, books = compress_vectors(same)
    assert {r["code"] for r in rows.collect()} == {"00" * 8} and books.shape == (8, 5, 8)
    rows, centers = cluster_vectors(same, k=1)
    assert [tuple(r) for r in rows.collect()] == [(3, 0, 0)] * 5


def test_states_are_joined_without_a_shuffle(spark):
    rows = frame(spark, [(i, [float(i % 5), float(i % 7)], None) for i in range(500)])
    table = vector_blocks.pack(vector_blocks.named(rows, "vec_id", "embedding").repartition(4), 64, "plan")
    start = np.array([[0, 0], [64, 64], [128, 0]])
    table.step(centroids._step(start, np.zeros(3)))
    plan = table.joined()._jdf.queryExecution().executedPlan().toString()
    table.forget()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_only_expired_vectors_are_scanned_again():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(-40, 40, (300, 8)) + 400 * k for k in range(5)])
    centers = np.array([[400 * k + 5] * 8 for k in range(5)])
    state, _, first = centroids.rescan(x, None, centers, np.zeros(5))
    after = centers + rng.integers(-3, 4, centers.shape)
    state, sums, again = centroids.rescan(x, state, after, centroids.drifts(centers, after))
    assert first == len(x) and again == 0 and not sums.any()
    far = centers + 350
    _, _, moved = centroids.rescan(x, state, far, centroids.drifts(centers, after) + centroids.drifts(after, far))
    assert moved > 0


def test_net_moves_are_tighter_than_added_ones():
    """An entry that moves away and back has not moved, so nothing is scanned."""
    base = np.arange(2 * 4 * 3).reshape(2, 4, 3) * 1000
    away = base + 700
    history = np.stack([base, away, base])
    net, _ = displacements(history)
    assert net[0].max() == 0 and net[1].min() > 0
    rng = np.random.default_rng(1)
    x = np.concatenate([base[:, k].reshape(-1) + rng.integers(-9, 9, (50, 6)) for k in range(4)])
    state, _, first = product_codes.rescan(x, None, history[:1])
    _, sums, again = product_codes.rescan(x, state, history)
    assert first == 2 * len(x) and again == 0 and not sums.any()
