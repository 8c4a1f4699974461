"""Languages against a plain TF-IDF and nearest-centroid version that works text by text with dictionaries."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkfeat.llm.langid import CENTROIDS, DIMS, REJECTED_SHARE, ROUNDS, train_languages
from tests.llm.conftest import docs_frame

WORDS = {
    "en": "the and of to in that it was for with house water light green river stone".split(),
    "de": "der und die das nicht mit auf für haus wasser licht grün fluss stein über schön".split(),
    "fr": "le la les des une est pour dans avec maison eau lumière vert rivière pierre été".split(),
}


def places(text):
    chars = [ord(c) if c.isalpha() else 32 for c in "  " + (text or "").lower() + " "]
    out = Counter()
    mix = lambda h: ((h ^ (h >> 17)) >> 3) % DIMS
    for a, b, d in zip(chars, chars[1:], chars[2:]):
        if not (b == 32 and d == 32):
            out[mix(b * 0x9E3779B1 + d * 0x85EBCA77)] += 1
            if not (a == 32 and b == 32):
                out[mix(a * 0xC2B2AE3D + b * 0x27D4EB2F + d * 0x165667B1 + 1)] += 1
    return out


def unit(v):
    size = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / size for k, x in v.items()} if size else {}


def dot(a, b):
    return sum(x * b.get(k, 0.0) for k, x in a.items())


def total(vectors):
    out = Counter()
    for v in vectors:
        out.update(v)
    return out


def centroids_of(vectors):
    mean = total(vectors)
    near = lambda seeds: [max(dot(v, s) for s in seeds) for v in vectors]
    seeds = [max(vectors, key=lambda v: dot(v, mean))]
    while len(seeds) < CENTROIDS and min(near(seeds)) < 1 - 1e-6:
        cos = near(seeds)
        seeds.append(vectors[cos.index(min(cos))])
    for _ in range(ROUNDS):
        own = [max(range(len(seeds)), key=lambda j: (dot(v, seeds[j]), -j)) for v in vectors]
        seeds = [unit(total([v for v, o in zip(vectors, own) if o == j])) for j in range(len(seeds))]
        seeds = [s for s in seeds if s]
    return seeds


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for i in range(90):
        lang = list(WORDS)[i % 3]
        own = rng.sample(WORDS[lang], 9)
        out.append((i, " ".join(rng.choice(own) for _ in range(rng.randint(8, 30))) + rng.choice([".", "!", " 12"]), lang, "s"))
    return out + [(90, None, "en", "s"), (91, "no language", None, "s")]


def test_predictions_against_plain_centroids(spark, rows):
    model = train_languages(docs_frame(spark, rows))
    learned = [(t, lang) for _, t, lang, _ in rows if t is not None and lang is not None]
    seen = total([dict.fromkeys(places(t), 1) for t, _ in learned])
    idf = {k: math.log((1 + len(learned)) / (1 + seen.get(k, 0))) + 1 for k in range(DIMS)}
    assert [model.idf[k] for k in range(DIMS)] == pytest.approx([idf[k] for k in range(DIMS)], rel=1e-5)
    vector = lambda t: unit({k: math.log1p(n) * idf[k] for k, n in places(t).items()})

    centres = []
    for j, lang in enumerate(model.languages):
        centre = {k: float(x) for k, x in enumerate(model.centres[j]) if x}
        assert sum(x * x for x in centre.values()) == pytest.approx(1, rel=1e-4)
        centres.append((lang, centre, model.least[j]))
    for lang in WORDS:
        want = centroids_of([vector(t) for t, own in learned if own == lang])
        mine = [c for name, c, _ in centres if name == lang]
        assert len(mine) == len(want)
        assert all(max(dot(c, w) for c in mine) > 0.99 for w in want)

    tests = [*[t for _, t, _, _ in rows], "", "12 !?", "x", "日本語 だけ", "the house und das haus", "la maison " * 50, "zzz qqq jjj"]
    got = docs_frame(spark, [(i, t, None, None) for i, t in enumerate(tests)]).select("doc_id", model.predict(F.col("text")).alias("m"))
    got = {r.doc_id: r.m for r in got.collect()}
    for i, text in enumerate(tests):
        if not any(c.isalpha() for c in text or ""):
            assert (got[i].lang, got[i].score, got[i].rejected) == ("und", 0.0, True)
            continue
        scores = [(dot(vector(text), c), name, least) for name, c, least in centres]
        best = max(scores)
        assert got[i].score == pytest.approx(max(best[0], 0.0), abs=1e-4)
        close = {name for s, name, _ in scores if s > best[0] - 1e-4}
        assert got[i].lang in close
        if all(abs(s - least) > 1e-4 for s, _, least in scores):
            assert got[i].rejected == (best[0] < best[2])
    right = sum(got[i].lang == lang for i, (_, t, lang, _) in enumerate(rows) if t is not None and lang is not None)
    assert right == len(learned)
    assert 0 <= REJECTED_SHARE < 0.01
