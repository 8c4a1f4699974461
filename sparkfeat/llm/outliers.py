"""Quality rules, and robust multivariate outliers among what passes them (minimum covariance determinant)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, kept, let

SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
#: Rule limits: words a text needs, percent of its words that may lie in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Share of a group that the determinant is minimised over, and refinement steps.
SUBSET, STEPS = 0.75, 4
#: Rows a group needs for estimates of its own (eight per dimension); smaller ones use their language's, then those of all rows.
LEAST_ROWS = 40
#: Smallest standard deviation of a transformed statistic, so that constant ones have an inverse.
FLOOR = 0.05
#: Squared Mahalanobis distance beyond which a document is rejected: ten robust deviations, as texts have
#: heavier tails than normal data.
CUTOFF = 100.0
#: Distances are ranked in steps of a 64th of their logarithm.
RANK_STEPS = 64
STATS = ("x_length", "x_word", "x_symbols", "x_lines", "x_repeats")


def base_stats(text: Column) -> Column:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text as a struct.

    Work per text is that of sorting its words, whatever their repetition. A null or blank
    text has zeros.
    """
    text = F.coalesce(text, F.lit(""))
    long = lambda c: c.cast("bigint")
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    chars = F.length(F.translate(text, SPACES, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    words = F.filter(F.split(text, f"[{SPACES}]+", -1), lambda w: w != "")
    return let(
        words,
        lambda w: F.struct(
            long(F.size(w)).alias("n_words"),
            long(chars).alias("word_chars"),
            long(symbols).alias("n_symbols"),
            long(dup_lines).alias("n_dup_lines"),
            long(_repeated(w)).alias("n_repeat_words"),
        ),
    )


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window which occurs twice or more.

    Windows are sorted by hash, so equal ones stand side by side; their positions, sorted
    again, cover three words each or as many as there are to the next.
    """
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0)))
    window = lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
    )

    def covered(s: Column) -> Column:
        same = lambda x, k: F.get(s, k).getField("h").eqNullSafe(x["h"])
        twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        width = lambda p, k, x: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))
        return let(
            starts,
            lambda p: F.aggregate(F.transform(p, lambda x, k: width(p, k, x)), F.lit(0), lambda a, b: a + b),
        )

    hashes = F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    any_twice = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when((F.size(words) < 4) | ~any_twice, 0).otherwise(let(F.sort_array(F.transform(at, window)), covered))


def transformed(s: Column) -> list[Column]:
    """The statistics on scales on which ordinary texts are about normal, named as ``STATS``."""
    n = F.greatest(s["n_words"], F.lit(1)).cast("double")
    return [
        (F.log1p(s["n_words"].cast("double")) / 2).alias(STATS[0]),
        (F.log(F.greatest(s["word_chars"], F.lit(1)) / n) * 2).alias(STATS[1]),
        F.sqrt(s["n_symbols"] / n).alias(STATS[2]),
        F.sqrt(s["n_dup_lines"] / n).alias(STATS[3]),
        F.sqrt(s["n_repeat_words"] / n).alias(STATS[4]),
    ]


#: Scale that makes the covariance of the central part of normal data in 5 dimensions that of all of it:
#: share / (distribution of chi-square 7 at the share's quantile of chi-square 5), for shares 0.75 and 0.975.
CONSISTENCY, CONSISTENCY_LAST = 1.412, 1.083
#: Squared distance that holds 0.975 of normal data in 5 dimensions.
CENTRAL = 12.83
#: Rows a pooled group needs for any verdict.
LEAST_POOLED = 12
#: Groups whose estimates (about 300 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 20_000
#: Grain of the medians that the search starts from.
GRAIN = 256

P = len(STATS)
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def _attach(df: DataFrame, small: DataFrame, n: int, on: Sequence[str], how: str = "inner") -> DataFrame:
    return df.join(F.broadcast(small) if n <= BROADCAST_GROUPS else small, list(on), how)


def _key(level: str, *names: str) -> Column:
    """A number for a group; null is a name of its own."""
    return F.xxhash64(F.to_json(F.array(F.lit(level), *[F.col(n) for n in names])))


def _cells(rows: DataFrame) -> tuple[DataFrame, int]:
    """Per (lang, source): the group whose estimates it uses, and all groups its rows count in."""
    cells = rows.filter("ok").groupBy("cell").agg(F.first("lang").alias("lang"), F.first("source").alias("source"), F.count("*").alias("n"))
    cells = kept(cells)
    by_lang = Window.partitionBy("lang")
    level = (
        F.when(F.col("n") >= LEAST_ROWS, "own").when(F.sum("n").over(by_lang) >= LEAST_ROWS, "lang").otherwise("all")
    )
    cells = kept(cells.withColumn("level", level))
    total, any_all = cells.agg(F.count("*"), F.max((F.col("level") == "all").cast("int"))).first()
    own, lang, pooled = _key("own", "lang", "source"), _key("lang", "lang"), _key("all")
    uses = F.when(F.col("level") == "own", own).when(F.col("level") == "lang", lang).otherwise(pooled)
    needs_lang = F.max((F.col("level") == "lang").cast("int")).over(by_lang) == 1
    counts_in = F.array_compact(
        F.array(
            F.when(F.col("level") == "own", own),
            F.when(needs_lang, lang),
            F.when(F.lit(bool(any_all)), pooled),
        )
    )
    return kept(cells.select("cell", uses.alias("g"), counts_in.alias("counts_in"))), total or 0


def _medians(rows: DataFrame, values: Sequence[Column]) -> DataFrame:
    """``g, m_0, m_1, ...``: medians per group to a fine grain, from counts of binned values."""
    bins = F.array(*[F.struct(F.lit(i).alias("dim"), F.floor(v * GRAIN).alias("bin")) for i, v in enumerate(values)])
    counts = rows.select("g", F.explode(bins).alias("b")).groupBy("g", "b.dim", "b.bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("g", "dim")
    up = group.orderBy("bin")
    middle = counts.select("g", "dim", "bin", (2 * F.sum("n").over(up) >= F.sum("n").over(group)).alias("half"))
    medians = middle.filter("half").groupBy("g", "dim").agg((F.min("bin") / F.lit(GRAIN)).alias("m"))
    return medians.groupBy("g").agg(*[F.max(F.when(F.col("dim") == i, F.col("m"))).alias(f"m_{i}") for i in range(len(values))])


def _solved(frame: DataFrame, scale: float) -> DataFrame:
    """Means ``m_i`` and covariances ``c_i_j`` to ``m_i``, the inverse Cholesky factor ``w_i_j`` and ``logdet``."""
    keys = [c for c in frame.columns if c in ("g", "s")]
    for i, j in LOWER:  # lower triangle, row by row
        inner = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        cov = F.col(f"c_{i}_{j}") * scale
        value = F.sqrt(F.greatest(cov + FLOOR**2 - inner, F.lit(FLOOR**2))) if i == j else (cov - inner) / F.col(f"l_{j}_{j}")
        frame = frame.withColumn(f"l_{i}_{j}", value)
    for i, j in LOWER:
        inner = sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0))
        frame = frame.withColumn(f"w_{i}_{j}", (F.lit(1.0) if i == j else -inner) / F.col(f"l_{i}_{i}"))
    logdet = sum((F.log(F.col(f"l_{i}_{i}")) for i in range(P)), F.lit(0.0))
    return frame.select(
        *keys, *[f"m_{i}" for i in range(P)], *[f"w_{i}_{j}" for i, j in LOWER], logdet.alias("logdet")
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a row that carries its group's estimates."""
    y = [F.col(x) - F.col(f"m_{i}") for i, x in enumerate(STATS)]
    z = [sum((F.col(f"w_{i}_{j}") * y[j] for j in range(i + 1)), F.lit(0.0)) for i in range(P)]
    return sum((v * v for v in z), F.lit(0.0))


def _moments(keys: Sequence[str], rows: DataFrame) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(STATS)],
        *[F.covar_pop(STATS[i], STATS[j]).alias(f"c_{i}_{j}") for i, j in LOWER],
    )


def _starts(members: DataFrame, groups: int) -> DataFrame:
    """Two starts per group: scales of each statistic alone, and the covariance of directions from the median."""
    centre = kept(_medians(members, [F.col(x) for x in STATS]))
    off = [F.abs(F.col(x) - F.col(f"m_{i}")) for i, x in enumerate(STATS)]
    spread = _medians(_attach(members, centre, groups, ["g"]), off)
    spread = spread.select("g", *[F.greatest(F.col(f"m_{i}") * 1.4826, F.lit(FLOOR)).alias(f"d_{i}") for i in range(P)])
    centre = kept(centre.join(spread, "g"))
    alone = centre.select(
        "g",
        F.lit(0).alias("s"),
        *[f"m_{i}" for i in range(P)],
        *[(F.col(f"d_{i}") ** 2 if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in LOWER],
    )
    z = [(F.col(x) - F.col(f"m_{i}")) / F.col(f"d_{i}") for i, x in enumerate(STATS)]
    length = F.greatest(F.sqrt(sum((v * v for v in z), F.lit(0.0))), F.lit(1e-6))
    signs = _attach(members, centre, groups, ["g"]).select("g", *[(v / length).alias(f"z_{i}") for i, v in enumerate(z)])
    turned = signs.groupBy("g").agg(*[F.avg(F.col(f"z_{i}") * F.col(f"z_{j}")).alias(f"t_{i}_{j}") for i, j in LOWER])
    directed = centre.join(turned, "g").select(
        "g",
        F.lit(1).alias("s"),
        *[f"m_{i}" for i in range(P)],
        *[(F.col(f"t_{i}_{j}") * P * F.col(f"d_{i}") * F.col(f"d_{j}")).alias(f"c_{i}_{j}") for i, j in LOWER],
    )
    return kept(_solved(alone.unionByName(directed), 1.0))


def _refined(members: DataFrame, estimates: DataFrame, groups: int) -> DataFrame:
    """Estimates of the ``SUBSET`` of each group's rows nearest to the given ones; determinants do not grow."""
    at = F.floor(F.log(_distance() + 1e-9) * RANK_STEPS)
    ranked = _attach(members, estimates, groups, ["g"]).select("g", "s", *STATS, at.alias("at"))
    counts = ranked.groupBy("g", "s", "at").agg(F.count("*").alias("n"))
    group = Window.partitionBy("g", "s")
    reach = F.sum("n").over(group.orderBy("at")) >= SUBSET * F.sum("n").over(group)
    edge = counts.select("g", "s", "at", reach.alias("reach")).filter("reach").groupBy("g", "s").agg(F.min("at").alias("edge"))
    near = _attach(ranked, kept(edge), groups, ["g", "s"]).filter("at <= edge")
    return kept(_solved(_moments(["g", "s"], near), CONSISTENCY))


def covariance_estimates(members: DataFrame, groups: int) -> DataFrame:
    """Robust estimates per group ``g`` of rows with the columns ``STATS``.

    Each of two starts is refined by concentration steps; the one with the smaller
    determinant stays and is reweighted once, by the rows within its central ellipsoid.
    """
    estimates = _starts(members, groups)
    for _ in range(STEPS):
        estimates = _refined(members, estimates, groups)
    names = [c for c in estimates.columns if c not in ("g", "s", "logdet")]
    best = estimates.groupBy("g").agg(F.min(F.struct("logdet", "s", *names)).alias("b")).select("g", "b.*").drop("s", "logdet")
    central = _attach(members, kept(best), groups, ["g"]).filter(_distance() <= CENTRAL)
    sizes = members.groupBy("g").agg(F.count("*").alias("size")).filter(F.col("size") >= LEAST_POOLED)
    return kept(_solved(_moments(["g"], central), CONSISTENCY_LAST).drop("logdet").join(sizes.select("g"), "g"))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``distance`` and ``kept`` of each document.

    A document fails the base rules with fewer than ``LEAST_WORDS`` words or more than
    ``MOST_REPEATED`` percent of them in repeated windows. The others are judged by the
    squared Mahalanobis distance of their transformed statistics from the minimum covariance
    determinant estimates of their language and source; cells of fewer than ``LEAST_ROWS``
    such documents use those of the language, or of all documents. ``distance`` is null for
    base failures, and where too few documents exist to estimate anything (all are kept
    then).

    Null languages and sources are values of their own; a null or blank text has zeros and
    fails; repeated rows count as often as they occur; an empty table gives no rows. Other
    columns are ignored.
    """
    stats = docs.select(
        col(id_col).alias("doc_id"), col(lang_col).alias("lang"), col(source_col).alias("source"), base_stats(col(text_col)).alias("b")
    ).select("doc_id", "lang", "source", "b.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    here = {n: F.col(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    rows = kept(
        stats.select("*", (~failed).alias("ok"), _key("own", "lang", "source").alias("cell"), *transformed(here))
    )
    cells, n = _cells(rows)
    fit = _attach(rows.filter("ok").select("cell", *STATS), cells, n, ["cell"])
    members = kept(fit.select(F.explode("counts_in").alias("g"), *STATS))
    estimates = covariance_estimates(members, 2 * n + 2)
    judged = _attach(rows, cells.select("cell", "g"), n, ["cell"], "left")
    judged = _attach(judged, estimates, 2 * n + 2, ["g"], "left")
    distance = F.when(F.col("ok"), _distance())
    return judged.select(
        "doc_id",
        *here,
        (~F.col("ok")).alias("base_failed"),
        distance.alias("distance"),
        (F.col("ok") & (F.coalesce(distance, F.lit(0.0)) <= cutoff)).alias("kept"),
    )
