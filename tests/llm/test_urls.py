"""URL rules against a plain comparison of every url with every rule."""

from __future__ import annotations

import random
import re

import pytest

from sparkfeat.llm import url_filter
from sparkfeat.llm.url_filter import Rule, filter_urls

SCHEMA = "page_id long, url string, host string, path string, rule string, short string, digest string, __host string"


def frame(spark, urls):
    return spark.createDataFrame([(*r, "h", "p", "r", "s", "d", "x") for r in urls], SCHEMA)


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [
        (len(r.host) + len(r.path), len(r.host), r.verdict == "block", r.host + r.path, r.verdict)
        for r in rules
        if r.host and r.path is not None and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


RULES = [
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"), Rule("block", "b.c", ""), Rule("allow", "a.b.c", "/x"), Rule("block", "c", "/x/yyy"),
    Rule("allow", "b.c", "/x/é"), Rule("allow", "dup", "/"), Rule("block", "dup", "/"), Rule("block", "", "/"), Rule("block", None, "/"),
]


def urls(seed):
    rng = random.Random(seed)
    hosts = ["net", "NET", "xnet", "a.example.net", "example.net", "example.com", "c", "b.c", "a.b.c", "ab.c", "z.a.B.c", "fr.org", "dup",
             "", ".", ".net", "net.", "x@net:80", "é.net", "..b.c"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/2?x=/en/", "/x", "/x/yyy/z#/de/", "/x/é", "?q=/x", "#/en/", "/EN/", "//", "/x\n/y"]
    out = [(i, rng.choice(["http", "https", ""]) + "://" + rng.choice(hosts) + rng.choice(paths)) for i in range(300)]
    out += [(5, "http://a.example.net/en/1")] * 3 + [(None, "http://net/"), (None, None), (6, None), (7, ""), (8, "mailto:a@net/"), (9, "a://b://net/")]
    return out + [(10, "http://" + "a." * 20_000 + "net/" + "en/" * 20_000), (11, "http://net" + "/" * 100_000), (12, "://net/")]


@pytest.mark.parametrize("most", [100_000, 0])
def test_against_all_rules(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "BROADCAST", most)
    rows = urls(1)
    got = filter_urls(frame(spark, rows), RULES)
    assert got.columns == [*SCHEMA.replace(",", "").split()[::2], "url_rule"]
    found = [(r["page_id"], *r["url_rule"]) for r in got.collect()]
    want = [(i, *plain(u, RULES)) for i, u in rows]
    key = lambda r: tuple((x is None, x or "") if not isinstance(x, int) else (False, str(x)) for x in r)
    assert sorted(found, key=key) == sorted(want, key=key)


def test_no_rules_and_no_pages(spark):
    rows = [(1, "http://net/"), (2, None)]
    for rules in ([], [Rule("block", None, "/")]):
        got = [(r["page_id"], r["url_rule"]["rule"], r["url_rule"]["verdict"]) for r in filter_urls(frame(spark, rows), rules).collect()]
        assert sorted(got) == [(1, None, "allow"), (2, None, "allow")]
    assert filter_urls(frame(spark, []), RULES).collect() == []


def test_equal_short_hashes_are_told_apart(spark, monkeypatch):
    """With one hex digit most expressions collide; whole digests must decide."""
    monkeypatch.setattr(url_filter, "SHORT", 1)
    rows = urls(2)
    found = sorted((str(r["page_id"]), str(r["url_rule"]["rule"])) for r in filter_urls(frame(spark, rows), RULES).collect())
    assert found == sorted((str(i), str(plain(u, RULES)[2])) for i, u in rows)


def test_only_built_in_functions(spark):
    plan = filter_urls(frame(spark, [(1, "http://net/")]), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
