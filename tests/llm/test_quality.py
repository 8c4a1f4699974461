"""Quality classifier and robust outliers."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import outliers
from sparkfeat.llm.outliers import STATS, base_stats, covariance_estimates, quality_rules
from sparkfeat.llm.quality import DIMS, Featurizer, Ftrl, sigmoid, shape, train_quality
from tests.llm.conftest import docs_frame


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_base_statistics_against_plain(spark, awkward):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "b", "#", "😀", "é|", "\n", "x\n", "\t"]) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [None, "", " \x0b\x0c\r\n", "a a a", "a a a a", "a b c a b c", "a\nb\na\n \n ", "   "]
    texts += [r.text for r in awkward.collect()]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", base_stats(F.col("text")).alias("b")).collect():
        assert tuple(r.b) == plain_stats(r.text), r.text


def plain_mcd(x, share, steps, floor):
    """Concentration steps from median and median deviation alone; mean and covariance."""
    m = np.median(x, axis=0)
    c = np.diag(np.maximum(np.median(abs(x - m), axis=0) * 1.4826, floor) ** 2)
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c + np.eye(len(m)) * floor**2), x - m)
        near = x[d <= np.quantile(d, share)]
        m, c = near.mean(axis=0), np.cov(near.T, bias=True) * outliers.CONSISTENCY
    d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c + np.eye(len(m)) * floor**2), x - m)
    near = x[d <= outliers.CENTRAL]
    return near.mean(axis=0), np.cov(near.T, bias=True) * outliers.CONSISTENCY_LAST


def test_estimates_against_plain_steps(spark):
    rng = np.random.default_rng(6)
    frames, want = [], {}
    for g in (1, 2):
        a = rng.normal(size=(5, 5)) * 0.4 + np.eye(5)
        good = rng.normal(size=(600, 5)) @ a + g
        bad = rng.normal(size=(120, 5)) * 0.1 + 15
        x = np.vstack([good, bad])
        want[g] = plain_mcd(x, outliers.SUBSET, outliers.STEPS, outliers.FLOOR)
        frames += [(g, *map(float, row)) for row in x]
    df = spark.createDataFrame(frames, "g long, " + ", ".join(f"{s} double" for s in STATS))
    for r in covariance_estimates(df, 2).collect():
        mean, cov = want[r.g]
        assert np.allclose([r[f"m_{i}"] for i in range(5)], mean, atol=0.15)
        w = np.zeros((5, 5))
        for i in range(5):
            for j in range(i + 1):
                w[i, j] = r[f"w_{i}_{j}"]
        got = np.linalg.inv(w.T @ w) - np.eye(5) * outliers.FLOOR**2
        assert np.allclose(got, cov, atol=0.35 * np.abs(cov).max())
        far = w @ (np.full(5, 15.0) - [r[f"m_{i}"] for i in range(5)])
        assert far @ far > outliers.CUTOFF


def prose(rng, n):
    return " ".join("".join(rng.choice("aeiou") + rng.choice("bcdlmnrst") for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_outliers_go_and_plain_texts_stay(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(60, 400)), "en", f"s{i % 2}") for i in range(500)]
    rows += [(1000 + i, prose(rng, 80).replace(" ", "### "), "en", "s0") for i in range(40)]
    rows += [(2000 + i, prose(rng, 120), None, None) for i in range(5)]
    got = {r.doc_id: r for r in quality_rules(docs_frame(spark, rows)).collect()}
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(40))
    assert sum(got[i].kept for i in range(500)) >= 495
    assert all(got[2000 + i].kept for i in range(5))


def test_rules_of_awkward_rows(awkward, none):
    rows = quality_rules(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert all(r.distance is None and not r.kept for r in rows if r.base_failed)
    assert quality_rules(none).count() == 0


def test_few_documents_are_all_kept(spark):
    rng = random.Random(9)
    got = quality_rules(docs_frame(spark, [(i, prose(rng, 60 + 400 * i), "en", "a") for i in range(3)])).collect()
    assert all(r.kept and r.distance is None for r in got)


def test_learner_against_dense_formula():
    rng = np.random.default_rng(0)
    model = Ftrl(np.zeros(4), np.zeros(4), alpha=0.5, beta=1.0, l1=0.01, l2=0.1)
    z, n = np.zeros(4), np.zeros(4)
    for _ in range(50):
        at, y = np.sort(rng.choice(4, 2, replace=False)), float(rng.integers(2))
        x = rng.random(2)
        w = np.array([0 if abs(z[k]) <= 0.01 else -(z[k] - np.sign(z[k]) * 0.01) / ((1 + n[k] ** 0.5) / 0.5 + 0.1) for k in at])
        p = sigmoid(w @ x)
        for k, v, wk in zip(at, x, w):
            g = (p - y) * v
            s = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / 0.5
            z[k] += g - s * wk
            n[k] += g * g
        model.learn(at, x, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_features():
    f = Featurizer()
    for blank in (None, "", " \n"):
        assert f.grams(blank) == []
        assert f.vector(blank)[0].tolist() == [DIMS]
    at, value = f.vector("one two one")
    assert at[-1] == DIMS and value.sum() == pytest.approx(1 + 5)
    assert [shape(w) for w in ("Word,", "WORD!!", "12", "###", "x")] == ["Aa3,", "A3!!", "92", "-0###", "a1"]


def test_classifier_learns_and_scores_anything(spark, awkward, none):
    rng = random.Random(11)
    rows = [(i, prose(rng, 60), "en", "a") for i in range(120)]
    rows += [(200 + i, (prose(rng, 60).upper() + "!!").replace(" ", "!! "), "en", "a") for i in range(60)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(r[0], int(r[0] < 200)) for r in rows if r[0] % 5] + [(None, 1), (3, None), (999, 0)], "doc_id long, quality int")
    model = train_quality(docs, labels)
    got = docs.filter("doc_id % 5 = 0").select("doc_id", model.score(F.col("text")).alias("s")).collect()
    assert all((r.s >= 0.3) == (r.doc_id < 200) for r in got)
    odd = awkward.select("text", model.score(F.col("text")).alias("s")).collect()
    assert len(odd) == awkward.count() and all(0 <= r.s <= 1 for r in odd)
    assert len({r.s for r in odd if not (r.text or "").strip()}) == 1
    blind = train_quality(none, labels)
    assert {r.s for r in docs.select(blind.score(F.col("text")).alias("s")).collect()} == {0.5}


def test_training_is_the_same_whatever_the_partitions(spark):
    rng = random.Random(12)
    docs = docs_frame(spark, [(i, prose(rng, 20), "en", "a") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    a = train_quality(docs, labels, max_train=40, passes=2)
    b = train_quality(docs.repartition(7), labels.repartition(3), max_train=40, passes=2)
    assert np.allclose(a.weights, b.weights, atol=1e-5)


def test_held_out_quality(spark):
    from sparkfeat.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op9_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
