"""License scans: units of a text compared with licence templates by the Dice coefficient of word bigrams."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, free_name, let

#: Least Dice coefficient of a match.
THRESHOLD = 0.8

MATCHES = "array<struct<license:string,similarity:double,unit:string,position:int>>"

# Notices and texts of well-known licences.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template."""
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can reach the threshold against ``n``.

    At most the smaller set is shared, so Dice is at most 2 min / (a + n).
    """
    fits = [a for a in range(1, int(n * 2 / threshold) + 2) if 2 * min(a, n) / (a + n) >= threshold]
    return fits[0], fits[-1]


def _unit_bigrams(unit: Column) -> Column:
    """Distinct word bigrams of a unit; words are runs of a-z and 0-9 after lower-casing."""
    words = F.filter(F.split(F.lower(unit), "[^a-z0-9]+", -1), lambda w: w != "")
    pairs = lambda w: F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1))
    )
    return let(words, lambda w: F.array_distinct(pairs(w)))


def units_of(text: Column) -> Column:
    """Lines, paragraphs of several lines, and the whole of a text of several paragraphs, with their numbers."""
    named = lambda kind: lambda x, i: F.struct(F.lit(kind).alias("unit"), i.alias("position"), x.alias("text"))
    lines = F.split(text, "\n", -1)
    paragraphs = F.split(text, "\n[ \t\r]*\n", -1)
    several = F.filter(F.transform(paragraphs, named("paragraph")), lambda u: F.contains(u["text"], F.lit("\n")))
    whole = F.filter(F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("position"), text.alias("text"))), lambda _: F.size(paragraphs) > 1)
    return F.concat(F.transform(lines, named("line")), several, whole)


def unit_ranges(text: str, units: list[tuple[str, int]]) -> list[tuple[int, int]]:
    """First word of each of some units of ``units_of``, and the word after its last; each kind is counted once."""
    starts: dict[str, list[int]] = {}
    for kind in {k for k, _ in units}:
        parts = {"line": lambda: text.split("\n"), "paragraph": lambda: re.split("\n[ \t\r]*\n", text), "text": lambda: [text]}[kind]()
        starts[kind] = [0, *accumulate(len(re.findall("[a-z0-9]+", t)) for t in parts)]
    return [(starts[kind][i], starts[kind][i + 1]) for kind, i in units]


class Taken:
    """Ranges of words, found by a word that they hold: one table per power of two of their length."""

    def __init__(self) -> None:
        self.levels: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def add(self, start: int, end: int) -> None:
        level = max(end - start, 1).bit_length()
        table = self.levels.setdefault(level, {})
        for place in range(start >> level, (end >> level) + 1):
            table.setdefault(place, []).append((start, end))

    def hold_half_of(self, start: int, end: int) -> bool:
        """Whether one of them holds half of the given range at least; it then reaches the range's middle."""
        middle = (start + end) // 2
        return any(
            2 * (min(end, e) - max(start, b)) >= end - start
            for level, table in self.levels.items()
            for place in {middle >> level, (middle + 1) >> level}
            for b, e in table.get(place, ())
        )


class Spans:
    """Stretches of words of a text that match a template, wherever they begin and end."""

    def __init__(self, grams: list[list[str]], bounds: list[tuple[int, int]], threshold: float):
        self.bounds, self.threshold = bounds, threshold
        self.sets = [set(g) for g in grams]
        names = sorted(set().union(*self.sets))
        words = sorted({w for g in names for w in g.split()})
        self.word = {w: i + 1 for i, w in enumerate(words)}
        self.gram = np.full((len(words) + 1) ** 2, -1, dtype=np.int32)
        for i, g in enumerate(names):
            a, b = g.split()
            self.gram[self.word[a] * (len(words) + 1) + self.word[b]] = i
        self.member = np.array([[g in own for own in self.sets] for g in names], dtype=np.int64)
        # 2 shared / (own + size) has to reach the threshold, with the fewest bigrams of its own
        self.shared = np.array([threshold * (lo + len(g)) / 2 - 1e-9 for (lo, _), g in zip(bounds, grams)])

    def find(self, text: str) -> list[tuple[int, float, int, int, int]]:
        """``shared, similarity, template, first word, end`` of the best stretch from each word that begins one.

        The text is read from its end, with the different bigrams of what has been read in order
        of their next place: a stretch only changes where it gets a new one. From each start no
        more of them are tried than a match can have besides the template's own, so the work
        grows with the words, however often they repeat.
        """
        words = re.findall("[a-z0-9]+", text)
        ids = np.fromiter((self.word.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        at = self.gram[ids[:-1] * (len(self.word) + 1) + ids[1:]]
        present = np.unique(at[at >= 0])
        wanted = np.flatnonzero(self.member[present].sum(axis=0) >= self.shared).tolist()
        if not wanted:
            return []
        number: dict[str, int] = {}
        codes = [number.setdefault(f"{a} {b}", len(number)) for a, b in zip(words, words[1:])]
        owned = [[g in self.sets[k] for g in number] for k in wanted]
        spare = [2 * len(self.sets[k]) * (1 / self.threshold - 1) + 1e-9 for k in wanted]
        inside = (at >= 0).tolist()
        out = []
        ahead: dict[int, int] = {}
        for i in range(len(codes) - 1, -1, -1):
            code = codes[i]
            ahead.pop(code, None)
            ahead[code] = i
            if not inside[i]:
                continue
            for k, own, most_other in zip(wanted, owned, spare):
                if not own[code]:
                    continue
                size, most = len(self.sets[k]), self.bounds[k][1]
                both = seen = 0
                best = None
                for g in reversed(ahead):
                    seen += 1
                    if seen > most:
                        break
                    if own[g]:
                        both += 1
                        score = 2.0 * both / (seen + size)
                        if score >= self.threshold and (best is None or score > best[1]):
                            best = (both, score, k, i, ahead[g] + 2)
                    elif seen - both > most_other:
                        break
                if best:
                    out.append(best)
        return out

    def apart(self, text: str, known: list[tuple[int, int]]) -> list[tuple[int, float, int, int, int]]:
        """Stretches of which no half lies in a known range or a better stretch; those that share most come first.

        The result is in order of place.
        """
        taken, out = Taken(), []
        for start, end in known:
            taken.add(start, end)
        for s in sorted(self.find(text), key=lambda s: (-s[0], -s[1], s[3], -s[2])):
            if not taken.hold_half_of(s[3], s[4]):
                taken.add(s[3], s[4])
                out.append(s)
        return sorted(out, key=lambda s: s[3])


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    out: str = "licenses",
) -> DataFrame:
    """``docs`` with an array column ``out`` of matches ``license, similarity, unit, position``.

    Every line, paragraph and the whole text are units; a unit is compared with the templates
    whose size allows the threshold, and its best template is a match if it reaches it (the
    last by name among equals). Then all stretches of words are searched, across and inside
    units, so a notice in the middle of a line or over some paragraphs is found too: a match
    has the unit ``words`` and the number of its first word. Of overlapping stretches the one
    that shares most bigrams counts, and none of which half lies in another match. A unit of fewer than two words has no bigram and matches
    nothing; a null or empty text has no matches; repeated rows each get theirs. The
    templates are a short list given by the caller, held in the plan. All columns pass
    through and ``out`` may not be one of them.
    """
    if free_name(docs, out) != out:
        raise ValueError(f"the documents already have a column {out!r}")
    names = [n for n in sorted(templates) if bigrams(templates[n])]
    if not names:
        return docs.select("*", F.array().cast(MATCHES).alias(out))
    grams = [bigrams(templates[n]) for n in names]
    bounds = [size_bounds(len(g), threshold) for g in grams]
    most = max(hi for _, hi in bounds)
    by_size = [[k for k, (lo, hi) in enumerate(bounds) if lo <= n <= hi] for n in range(most + 1)]
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    candidates = literal(by_size, "array<array<int>>")
    of_template = literal(grams, "array<array<string>>")
    name_of = literal(names, "array<string>")

    def dice(own: Column) -> Column:
        return F.transform(
            F.get(candidates, F.size(own)),
            lambda k: F.struct(
                (
                    F.lit(2.0)
                    * F.size(F.array_intersect(own, F.get(of_template, k)))
                    / (F.size(own) + F.size(F.get(of_template, k)))
                ).alias("similarity"),
                F.get(name_of, k).alias("license"),
            ),
        )

    def best(unit: Column) -> Column:
        top = let(_unit_bigrams(unit["text"]), lambda own: F.array_max(dice(own)))
        return F.struct(top.alias("top"), unit["unit"].alias("unit"), unit["position"].alias("position"))

    units = units_of(F.coalesce(col(text_col), F.lit("")))
    found = F.filter(F.transform(units, best), lambda m: m["top"]["similarity"] >= threshold)
    matches = F.transform(
        found,
        lambda m: F.struct(
            m["top"]["license"].alias("license"), m["top"]["similarity"].alias("similarity"), m["unit"].alias("unit"), m["position"].alias("position")
        ),
    )
    spans = Spans(grams, bounds, threshold)

    @F.pandas_udf(MATCHES)
    def stretches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, found in batches:
            rows = []
            for text, units in zip(texts, found):
                known = unit_ranges(text, [(u["unit"], u["position"]) for u in units])
                rows.append([{"license": names[k], "similarity": s, "unit": "words", "position": i} for _, s, k, i, _ in spans.apart(text, known)])
            yield pd.Series(rows, dtype=object)

    lowered = F.lower(F.coalesce(col(text_col), F.lit("")))
    more = stretches.asNondeterministic()(lowered, col(out))
    return docs.select("*", matches.alias(out)).select(*[col(c) for c in docs.columns], F.concat(col(out), more).alias(out))
