"""URL rules by host suffix and path prefix, joined on short hashes (native)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, free_name, kept, let

UPPER, PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that are joined on.
SHORT = 8
#: Rules up to this number are broadcast; more are joined by a shuffle with salted keys.
BROADCAST, SALTS = 100_000, 32
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, PLAIN), F.lit(""))


def path_of(url: Column) -> Column:
    """What lies between the host and the next ``?`` or ``#``; empty if there is none."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _digest(host: Column, path: Column) -> Column:
    """A host holds no ``/`` and a path begins with one, so their text tells both apart; the length guards other rules."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """``digest, short, labels, path_length, rule, rank`` of the rules ``verdict, host, path``.

    Of rules for the same host and path one that blocks wins (then the smaller verdict).
    """
    host = F.translate(F.col("host"), UPPER, PLAIN)
    usable = rules.filter("host is not null and path is not null and verdict is not null and host <> ''")
    one = usable.groupBy(host.alias("host"), "path").agg(
        F.min(F.struct((F.col("verdict") != "block").alias("mild"), "verdict")).alias("v")
    )
    digest = _digest(F.col("host"), F.col("path"))
    return one.select(
        digest.alias("digest"),
        F.substring(digest, 1, SHORT).alias("short"),
        _labels(F.col("host")).alias("labels"),
        F.length("path").alias("path_length"),
        F.concat("host", "path").alias("rule"),
        F.col("v.verdict").alias("verdict"),
        F.length("host").alias("host_length"),
    )


def _shapes(table: DataFrame) -> list[tuple[int, int]]:
    """The different (labels of the host, length of the path) of all rules."""
    return [(r["labels"], r["path_length"]) for r in table.select("labels", "path_length").distinct().orderBy("labels", "path_length").collect()]


def _prefixed(path: Column, sizes: Sequence[int], suffix: Column) -> Column:
    return F.array(*[F.when(F.length(path) >= n, _digest(suffix, F.substring(path, 1, n))) for n in sizes])


def _expressions(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """Digests of the host's suffixes with the path's prefixes, for the shapes that rules have and the url reaches.

    A host suffix is cut once per number of labels and a path prefix once per length.
    """
    by_labels: dict[int, list[int]] = {}
    for labels, size in shapes:
        by_labels.setdefault(labels, []).append(size)
    parts = []
    for labels, sizes in by_labels.items():
        digests = partial(_prefixed, path, sizes)
        suffix = let(F.substring_index(host, ".", -labels), digests)
        parts.append(F.when(_labels(host) >= labels, suffix).otherwise(F.array().cast("array<string>")))
    return F.filter(F.concat(*parts), lambda d: d.isNotNull())


def _matches(keys: DataFrame, table: DataFrame, shapes: Sequence[tuple[int, int]], n_rules: int) -> DataFrame:
    """``host, path`` with each rule that fits: expressions and rules meet on short hashes, whole digests confirm."""
    found = keys.select("host", "path", F.explode(_expressions(F.col("host"), F.col("path"), shapes)).alias("whole"))
    found = found.withColumn("short", F.substring("whole", 1, SHORT))
    if n_rules <= BROADCAST:
        met = found.join(F.broadcast(table), "short")
    else:  # a rule for a whole top-level domain meets very many urls
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = found.withColumn("salt", F.pmod(F.hash("host", "path"), F.lit(SALTS))).join(salted, ["short", "salt"])
    return met.filter("whole = digest")


def filter_urls(
    pages: DataFrame, rules: DataFrame | Sequence[Rule], url_col: str = "url", out: str = "url_rule", default: str = DEFAULT
) -> DataFrame:
    """``pages`` with ``out``: a struct of ``host, path, rule, verdict``.

    A rule fits its host and all subdomains of it, if the url's path begins with the rule's
    path. The longest rule that fits wins; of equally long ones the one with the longer
    host. ``rule`` is its host and path (null if none fits) and ``verdict`` its verdict, else
    ``default``. Of equal rules with different verdicts one that blocks wins.

    Every row is kept once, with all its columns, in whatever order. A null url, or one
    without ``://``, has an empty host and path, which no rule fits. Repeated rows and
    null ids do not matter, as rows are joined by host and path. Rules with a null or an
    empty host, or a null path or verdict, fit nothing; without rules all urls get ``default``.

    Each different host and path is expanded once, into the shapes (labels of the host,
    length of the path) that rules have, so a url that very many rows share is looked up
    once. Up to ``BROADCAST`` rules (counted) go to every executor; more are joined by salted keys.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    table = kept(rule_table(rules))
    url = col(url_col)
    verdict_type = "host string, path string, rule string, verdict string"
    keys = pages.select(host_of(url).alias("host"), path_of(url).alias("path")).distinct()
    shapes = _shapes(table)
    if shapes:
        best = F.max(F.struct(F.length("rule").alias("size"), "host_length", "rule", "verdict"))
        judged = _matches(keys, table, shapes, table.count()).groupBy("host", "path").agg(best.alias("b"))
        judged = judged.select("host", "path", "b.rule", "b.verdict")
    else:
        judged = spark.createDataFrame([], verdict_type)
    host, path, found_host, found_path, rule, verdict = (
        free_name(pages, n) for n in ("__host", "__path", "__found_host", "__found_path", "__rule", "__verdict")
    )
    parsed = pages.withColumns({host: host_of(url), path: path_of(url)})
    judged = judged.toDF(found_host, found_path, rule, verdict)
    fits = (col(host) == col(found_host)) & (col(path) == col(found_path))
    names = [col(c) for c in pages.columns if c.lower() != out.lower()]
    return parsed.join(judged, fits, "left").select(
        *names,
        F.struct(
            col(host).alias("host"),
            col(path).alias("path"),
            col(rule).alias("rule"),
            F.coalesce(col(verdict), F.lit(default)).alias("verdict"),
        ).alias(out),
    )
