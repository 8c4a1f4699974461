from __future__ import annotations

import random
import re
import time

import pytest

from sparkfeat.llm.license_scan import TEMPLATES, Spans, bigrams, scan_licenses, size_bounds, unit_ranges

BSD = TEMPLATES["BSD-2-Clause"].replace("1. Re", "\n\n1. Re").replace("2. Re", "\n\n2. Re")
GPL = TEMPLATES["GPL-3.0 notice"].replace("This program is distributed", "\n\nThis program is distributed")
MIT = TEMPLATES["MIT text"].replace("without limitation", "without\nlimitation")
OTHER = "\n".join(f"value {i} goes to place {i * 7} of row {i * 11}" for i in range(60))


def test_notices_over_paragraphs_and_inside_lines(spark):
    texts = {
        "GPL-3.0 notice": f"{GPL}\n\n{OTHER}",
        "BSD-2-Clause": f"{OTHER}\n\n{BSD}\n\n{OTHER}",
        "MIT text": f"{OTHER} {MIT} {OTHER}",
        "MIT": "It is small. Released under the MIT License. Ask us for the rest of what was made here.",
        "": OTHER,
        "Unlicense": f"{OTHER}\n{TEMPLATES['Unlicense']}\n{OTHER}",
    }
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "want string, text string")
    got = {r.want: [(m.license, m.unit) for m in r.licenses] for r in scan_licenses(df).collect()}
    unit = lambda n: "line" if n == "Unlicense" else "words"
    assert got == {n: [(n, unit(n))] if n else [] for n in texts}


def plain_stretches(text, templates, threshold, known):
    """Every start with every end, then the choice of those that lie apart."""
    words = re.findall("[a-z0-9]+", text.lower())
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = []
    for k, name in enumerate(sorted(templates)):
        own = set(bigrams(templates[name]))
        most = size_bounds(len(own), threshold)[1]
        for i in range(len(pairs)):
            best = None
            for j in range(i, len(pairs)):
                seen = set(pairs[i : j + 1])
                score = 2.0 * len(seen & own) / (len(seen) + len(own))
                if len(seen) <= most and pairs[i] in own and pairs[j] in own and score >= threshold and (best is None or score > best[1]):
                    best = (len(seen & own), score, k, i, j + 2)
            found += [best] if best else []
    taken = list(known)
    out = []
    for s in sorted(found, key=lambda s: (-s[0], -s[1], s[3], -s[2])):
        if all(2 * (min(s[4], e) - max(s[3], b)) < s[4] - s[3] for b, e in taken):
            taken.append((s[3], s[4]))
            out.append(s)
    return sorted(out, key=lambda s: s[3])


@pytest.mark.parametrize("seed", range(12))
def test_stretches_against_every_start_and_end(seed):
    rng = random.Random(seed)
    templates = {n: " ".join(rng.choice("a b c d e f".split()) for _ in range(size)) for n, size in (("x", 4), ("y", 9), ("z", 30))}
    spans = Spans([bigrams(templates[n]) for n in sorted(templates)], [size_bounds(len(bigrams(templates[n])), 0.8) for n in sorted(templates)], 0.8)
    for _ in range(15):
        parts = [rng.choice([*templates.values(), "q r s", "a b", " ".join(rng.choice("a b c d e f g".split()) for _ in range(20))]) for _ in range(6)]
        text = " ".join(parts)
        known = [(s, s + rng.randint(1, 30)) for s in (rng.randrange(60) for _ in range(rng.randint(0, 3)))]
        assert spans.apart(text, known) == plain_stretches(text, templates, 0.8, known)


@pytest.mark.parametrize("repeated", ["of the software ", "All rights reserved. ", "Released under the MIT License.\n", "licensed under cc by "])
def test_long_repeats_take_time_in_proportion(repeated):
    names = sorted(TEMPLATES)
    grams = [bigrams(TEMPLATES[n]) for n in names]
    spans = Spans(grams, [size_bounds(len(g), 0.8) for g in grams], 0.8)
    text = (TEMPLATES["MIT text"] + "\n" + repeated * (1_000_000 // len(repeated))).lower()
    start = time.time()
    found = spans.apart(text, unit_ranges(text, [("line", 0)]))
    assert time.time() - start < 30
    want = 1_000_000 // len(repeated) if repeated.strip() in TEMPLATES.values() else 0
    assert abs(len(found) - want) <= 2


def test_ranges_of_units():
    text = "a b\nc\n\nd e f"
    assert unit_ranges(text, [("line", 0), ("line", 1), ("line", 3), ("paragraph", 0), ("paragraph", 1), ("text", 0)]) == [
        (0, 2), (2, 3), (3, 6), (0, 3), (3, 6), (0, 6),
    ]
