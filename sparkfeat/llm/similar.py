"""Near duplicates by the exact Jaccard similarity of word shingles, found by SimHash and through rare shared shingles."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.llm.common import LOWER, col, fresh_path, kept
from sparkfeat.llm.graph import components
from sparkfeat.llm.simhash import PAIRED, fingerprint_column, groups_of, links, one_of_each

SHINGLE, SIMILAR = 5, 0.8
#: Words of the shingles that SimHash fingerprints are made of, and bits in which linked fingerprints differ at most.
PRINTED, BITS = 3, 2
SEED = 42
#: Shingles that a pair must share among its rarest ones before it is compared as a whole.
NEEDED = 4
#: One text in so many is sampled to find frequent shingles; from so many sampled texts on a shingle counts as
#: frequent; as many of them are sent to the tasks at most. They only decide the order, never a result.
SAMPLED, FREQUENT, MOST_FREQUENT = 16, 4, 200_000

#: 64-bit words of a text's sketch, which marks a bit for each of its shingles.
WORDS = 16
#: Up to so many keys of texts are sent to all tasks, more are shuffled.
SENT_KEYS = 100_000

ORDERED = "struct<size:int,tokens:array<bigint>>"


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct 64-bit hashes of the text's word shingles, ascending.

    Words are those of ``fingerprint``. A text of fewer words is one shingle; all texts
    without words have one and the same.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(1, dtype=np.int64)
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w, SEED) for w in words], dtype=np.uint64)
    n = len(hashes) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out.view(np.int64))


def rarest_first(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The tokens in an order common to all texts: by hash, the frequent ones last by their rank."""
    if not len(frequent):
        return tokens
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    hot = frequent[at] == tokens
    return np.concatenate([tokens[~hot], tokens[hot][np.argsort(rank[at[hot]], kind="stable")]])


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _sets(text: Column, shingle: int) -> Column:
    @F.pandas_udf("binary")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_set(t, shingle).tobytes() for t in texts], dtype=object)

    return sets.asNondeterministic()(text)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """``WORDS`` numbers in which each shingle sets one bit."""
    bits = np.zeros(WORDS * 64, dtype=np.uint8)
    bits[(tokens & (WORDS * 64 - 1))] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _sketches(text: Column, shingle: int) -> Column:
    @F.pandas_udf("array<bigint>")
    def sketches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sketch(shingle_set(t, shingle)) for t in texts], dtype=object)

    return sketches.asNondeterministic()(text)


def _once(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """One row ``fp, text`` for each of the distinct ``keys``; only these texts are shuffled if the keys are few."""
    keys = kept(keys)
    few = keys.count() <= SENT_KEYS
    return texts.join(F.broadcast(keys) if few else keys, "fp", "left_semi").dropDuplicates(["fp"])


def _frequent(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many sampled texts, ascending, and their ranks by frequency."""

    @F.pandas_udf("array<bigint>")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series([shingle_set(t, shingle) for t in part], dtype=object)

    sample = texts.filter(F.pmod("fp", F.lit(SAMPLED)) == 0).dropDuplicates(["fp"])
    counts = sample.select(F.explode(tokens("text")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    top = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(MOST_FREQUENT)
    found = top.select("token").toArrow().column("token").to_numpy()
    order = np.argsort(found)
    return found[order], (len(found) - order).astype(np.int64)


def _rare_tokens(texts: DataFrame, shingle: int, similar: Fraction) -> DataFrame:
    """``fp, place, token``: of each text the shingles that a similar one shares ``NEEDED`` of, and their places."""
    blob = texts.sparkSession.sparkContext.broadcast(_frequent(texts, shingle))
    num, den = similar.numerator, similar.denominator

    @F.pandas_udf(ORDERED)
    def ordered(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        frequent, rank = blob.value
        for part in batches:
            size, rare = [], []
            for t in part:
                own = shingle_set(t, shingle)
                size.append(len(own))
                rare.append(rarest_first(own, frequent, rank)[: len(own) - -(-num * len(own) // den) + NEEDED])
            yield pd.DataFrame({"size": size, "tokens": rare})

    found = texts.select("fp", ordered.asNondeterministic()("text").alias("p"))
    cells = found.select("fp", "p.size", F.posexplode("p.tokens").alias("at", "token"))
    return cells.select("fp", (F.shiftleft(F.col("size").cast("bigint"), 32) + F.col("at")).alias("place"), "token")


def _size(place: Column) -> Column:
    """Shingles of the text; a place is that number and the shingle's position, in one number."""
    return F.shiftright(place, 32)


def _at(place: Column) -> Column:
    return place.bitwiseAND(F.lit(0xFFFFFFFF))


def _written(df: DataFrame) -> DataFrame:
    """The rows stored once as Parquet in the shared folder, which takes a third of a checkpoint's space."""
    path = fresh_path(df.sparkSession, "shingles")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _least_shared(size: Column, similar: Fraction, as_shorter: bool) -> Column:
    """Shingles that a set shares at least with a similar one that is no shorter (or no longer) than itself."""
    share = 2 * similar / (1 + similar) if as_shorter else similar
    return F.ceil(size * float(share) - 1e-6)


def _pair_shares(a: Column, b: Column, similar: Fraction) -> Column:
    """Shingles that two similar sets of these places share at least."""
    return F.ceil((_size(a) + _size(b)) * float(similar / (1 + similar)) - 1e-6)


def _reaches(a: Column, b: Column, similar: Fraction, shared: int) -> Column:
    """Whether two sets can have their ``shared``-th common shingle at these places, by what is left after it.

    Of the shingles that these sizes ask for, all but ``shared`` must follow the place in each of the sets.
    """
    least = _pair_shares(a, b, similar)
    return (_at(a) < _size(a) - least + shared) & (_at(b) < _size(b) - least + shared)


def _early(place: Column, similar: Fraction, as_shorter: bool, shared: int) -> Column:
    """Whether ``_reaches`` can hold at this place for any other set that is no shorter (or no longer)."""
    return _at(place) < _size(place) - _least_shared(_size(place), similar, as_shorter) + shared


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similar: Fraction) -> DataFrame:
    """The pairs ``(a, b)`` whose whole shingle sets are similar."""
    num, den = similar.numerator, similar.denominator
    keys = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    sets = kept(_once(texts, keys).select("fp", _sets(F.col("text"), shingle).alias("own")))

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            a, b = np.frombuffer(a, dtype=np.int64), np.frombuffer(b, dtype=np.int64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(den * both >= num * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    left, right = (sets.select(F.col("fp").alias(n), F.col("own").alias(f"own_{n}")) for n in ("a", "b"))
    return kept(pairs.join(left, "a").join(right, "b").filter(alike("own_a", "own_b")).select("a", "b"))


def _spare(size: Column, similar: Fraction) -> Column:
    """First shingles of a text (those of ``_rare_tokens``) less all of its shingles: not above 0."""
    return F.least(F.lit(0), F.lit(NEEDED) - F.ceil(size * float(similar) - 1e-6)).cast("bigint")


def _must_share(a: Column, b: Column, similar: Fraction) -> Column:
    """First shingles that two similar texts of these places have in common at least.

    They share ``similar / (1 + similar)`` of the sum of their sizes, so of one text no more than the rest of its size
    is missing in the other. The text whose first shingles end earlier in the common order has those that are not
    missing among the first ones of the other text, too.
    """
    return _pair_shares(a, b, similar) + F.least(_spare(_size(a), similar), _spare(_size(b), similar))


def _met(left: Column, right: Column, similar: Fraction, shared: int) -> Column:
    """Whether a token that two texts (structs of ``fp, place, met``) have at these places can make them a candidate.

    So many shingles must be left after the token in both texts as their two sizes ask for; sizes must allow the
    similarity at all, and of each text's first shingles so many (``met``) must occur in other texts as similar ones
    have in common.
    """
    a, b = left["place"], right["place"]
    fits = F.least(_size(a), _size(b)) >= F.greatest(_size(a), _size(b)) * float(similar) - 1e-6
    return fits & (F.least(left["met"], right["met"]) >= _must_share(a, b, similar)) & _reaches(a, b, similar, shared)


def _differ_little(left: Column, right: Column, similar: Fraction) -> Column:
    """Whether two texts (structs with ``place, bits``) may have as many shingles in common as similar ones.

    Each bit of one sketch that the other lacks stands for a shingle, at least, that the other text lacks.
    """
    least = _pair_shares(left["place"], right["place"], similar)

    def missing(x: Column, y: Column) -> Column:
        return reduce(add, [F.bit_count(x["bits"][k].bitwiseAND(F.bitwise_not(y["bits"][k]))) for k in range(WORDS)])

    return (missing(left, right) <= _size(left["place"]) - least) & (missing(right, left) <= _size(right["place"]) - least)


def _whole(a: Column, b: Column, similar: Fraction) -> Column:
    """Shingles that two texts (places) must share among their first ones."""
    return F.least(F.lit(NEEDED), F.ceil(F.greatest(_size(a), _size(b)) * float(similar) - 1e-6)).cast("int")


def _candidates(rows: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Distinct ``(a, b)`` of rows ``a, b, counted, whole``, one per shared token, that share ``whole`` tokens.

    ``counted`` is 1 for tokens that count. ``hot`` has all first tokens ``(fp, tokens)`` of the texts with crowded ones,
    of which a row's own ``hot`` says how many both can share at most. Pairs of such texts are looked up there and must
    have ``must`` first tokens in common.
    """
    each = rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "counted", "whole", *([] if hot is None else ["hot", "must"]))
    sums = [F.sum("counted").alias("n"), F.max("whole").alias("whole")]
    if hot is None:
        return kept(each.groupBy("a", "b").agg(*sums).filter("n >= whole").select("a", "b"))
    sums += [F.max(c).alias(c) for c in ("hot", "must")]
    pairs = _written(each.groupBy("a", "b").agg(*sums).filter("n + hot >= whole").drop("hot"))
    listed = pairs.join(hot.toDF("a", "hot_a"), "a", "left").join(hot.toDF("b", "hot_b"), "b", "left")
    both = F.size(F.array_intersect("hot_a", "hot_b")) >= F.greatest("whole", "must")
    enough = F.when(F.col("hot_a").isNotNull() & F.col("hot_b").isNotNull(), both).otherwise(F.col("n") >= F.col("whole"))
    return kept(listed.filter(enough).select("a", "b"))


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    return rows.select("token", F.struct("fp", "place", "comp", "hot", "met", *more).alias(name))


def sketched_links(texts: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR, bits: int = BITS) -> DataFrame:
    """Edges ``(a, b)`` of texts (``fp, text``) that SimHash finds and whose shingle sets are similar.

    Texts of one fingerprint are linked to one of them, which is linked to those of other
    fingerprints that differ in ``bits`` bits or fewer.
    """
    prints = texts.select("fp", fingerprint_column(F.col("text"), PRINTED).alias("print"))
    prints = kept(prints.groupBy("fp").agg(F.first("print").alias("print")))
    one = kept(prints.groupBy("print").agg(F.min("fp").alias("a")))
    same = prints.join(one, "print").filter("a <> fp").select("a", F.col("fp").alias("b"))
    near = links(one.select(F.col("print").alias("fp")), bits).toDF("p", "q")
    across = near.join(one.toDF("p", "a"), "p").join(one.toDF("q", "b"), "q").select("a", "b")
    return _confirmed(kept(same.unionByName(across)), texts, shingle, Fraction(str(similar)))


def similar_links(texts: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR, known: DataFrame | None = None) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs of ``similar`` Jaccard similarity or more.

    ``texts`` holds ``fp, text``, equal texts with equal ``fp``. ``known`` has edges of similar
    texts, found before; they are among the result. All texts' shingles are put
    in one order, frequent ones last. Two sets of that similarity share ``NEEDED`` shingles
    (all shared ones, if fewer are enough) among the first ``size - ceil(similar * size) +
    NEEDED`` of the longer and the first ``size - ceil(2 * similar / (1 + similar) * size) +
    NEEDED`` of the shorter, so texts are joined on these and candidates compared as a whole.

    A shingle of up to ``PAIRED`` texts is joined pair by pair. In a crowded one, texts are first
    linked to that of them which has most crowded shingles, as the original of many edited copies
    does, so that a family of near copies is one component and none of its pairs is met again. Then only the first shared shingle of a pair of different components
    counts, for which both bounds are one shingle short: texts with a passage in common meet
    only if what comes before it leaves the passage room to make them similar. No pair is
    lost: a pair whose first shared shingle is not crowded meets there, and the crowded ones
    that it shares are counted from a list per text before it is compared as a whole.

    Of a text's first shingles, so many must occur in other texts at all as a similar pair of
    these sizes has in common. So members of a family that are all far from each other by
    edits of their own, and near the original only, do not meet.

    Texts of different components that meet in a crowded shingle are no candidates if the sketches of
    their whole sets show more shingles missing in one of them than the limit allows.

    Texts that consist of the same crowded passages in different choice, and so are close to
    the limit pairwise, are still compared pair by pair.
    """
    share = Fraction(str(similar))
    rare = _rare_tokens(texts, shingle, share).repartition("token").groupBy("token", "fp").agg(F.first("place").alias("place"))
    counted = rare.withColumn("n", F.count("*").over(Window.partitionBy("token"))).filter("n > 1")
    shared = _written(counted.select("token", "fp", "place", (F.col("n") > PAIRED).alias("crowded")))
    crowded = shared.filter("crowded")
    no_links = texts.sparkSession.createDataFrame([], "a bigint, b bigint")
    known = no_links if known is None else known
    sums = [F.count(F.lit(1)).alias("met"), F.count_if(F.col("crowded")).alias("hot"), F.collect_list("token").alias("tokens")]
    facts = kept(shared.groupBy("fp").agg(*sums).select("fp", "met", "hot", F.when(F.col("hot") > 0, F.col("tokens")).alias("tokens")))
    tokens = facts.filter("hot > 0").select("fp", "tokens")
    some_crowded = not tokens.isEmpty()
    stars = no_links
    if some_crowded:
        named = crowded.join(facts.select("fp", "met", "hot"), "fp")
        hubs = named.groupBy("token").agg(F.max(F.struct("hot", "fp", "place", "met")).alias("hub"))
        hub, own = F.col("hub"), F.struct("fp", "place", "met")
        spokes = named.join(hubs, "token").filter(F.col("fp") != hub["fp"]).filter(_met(hub, own, share, NEEDED)).select(
            hub["fp"].alias("a"), F.col("fp").alias("b"), F.lit(1).alias("counted"), _whole(hub["place"], F.col("place"), share).alias("whole")
        )
        stars = _confirmed(_candidates(spokes), texts, shingle, share)
    stars = stars.unionByName(known)
    roots = components(stars).withColumnRenamed("node", "fp")
    facts = facts.select("fp", "met", "hot").join(roots, "fp", "left").withColumn("comp", F.coalesce("root", "fp"))
    shared = _written(shared.join(facts.drop("root"), "fp"))
    crowded = shared.filter("crowded")
    small = shared.filter("not crowded")
    x, y = F.col("x"), F.col("y")
    apart = x["comp"] != y["comp"]
    ends = (x["fp"].alias("a"), y["fp"].alias("b"))
    whole = _whole(x["place"], y["place"], share).alias("whole")
    pairs = _side(small, "x").join(_side(small, "y"), "token").filter(x["fp"] < y["fp"]).filter(apart & _met(x, y, share, NEEDED))
    must = _must_share(x["place"], y["place"], share).cast("int").alias("must")
    pairs = pairs.select(*ends, F.lit(1).alias("counted"), whole, F.least(x["hot"], y["hot"]).alias("hot"), must)
    if not some_crowded:
        return _confirmed(_candidates(pairs), texts, shingle, share).unionByName(stars)
    early = crowded.filter(_early(F.col("place"), share, False, 1)).withColumn("short", _early(F.col("place"), share, True, 1))
    tops = early.groupBy("token", "comp").agg(F.count("*").alias("n"), F.max("short").alias("short")).groupBy("token")
    tops = tops.agg(F.max(F.struct("n", "comp")).alias("m"), F.count("*").alias("comps"), F.max("short").alias("short"))
    tops = tops.filter("comps > 1 and short").select("token", F.col("m.comp").alias("top"))
    early = kept(early.join(tops, "token"))
    bits = _once(texts, early.select("fp").distinct()).select("fp", _sketches(F.col("text"), shingle).alias("bits"))
    early = kept(early.join(bits, "fp"))
    rest = early.filter("comp <> top")
    one = _side(rest.filter("short"), "x", "bits").join(_side(early, "y", "bits"), "token")
    two = _side(early.filter("short and comp = top"), "x", "bits").join(_side(rest, "y", "bits"), "token")
    first = F.struct(_size(x["place"]), x["fp"]) < F.struct(_size(y["place"]), y["fp"])
    near = _met(x, y, share, 1) & _differ_little(x, y, share)
    met = one.unionByName(two).filter(first & apart & near).select(*ends, F.lit(0).alias("counted"), whole, F.lit(NEEDED).alias("hot"), must)
    found = _confirmed(_candidates(pairs.unionByName(met), tokens), texts, shingle, share)
    return found.unionByName(stars)


def drop_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: float = SIMILAR, bits: int = BITS
) -> DataFrame:
    """One document of each group of similar texts, with all columns of ``docs``.

    Texts whose sets of ``shingle``-word shingles have a Jaccard similarity of ``similar`` or
    more are linked, and a group is what links lead to. Links come from SimHash fingerprints
    that differ in ``bits`` bits or fewer, each confirmed by the similarity; pairs that are
    similar but further apart in bits are then found by rare shared shingles. The row with the group's smallest id
    stays; if several rows have it (repeated rows, or a group without any id), one of them.
    Null and blank texts are one group. Shingles and texts are compared by 64-bit hashes.
    """
    fp = _text_key(col(text_col))
    rows = kept(docs.select(col(id_col).alias("doc_id"), fp.alias("fp")))
    texts = docs.select(fp.alias("fp"), col(text_col).alias("text"))
    return one_of_each(docs, id_col, fp, groups_of(rows, lambda _: similar_links(texts, shingle, similar, sketched_links(texts, shingle, similar, bits))))
