"""Mixing sources to target weights by iterative proportional fitting (raking)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.llm.common import WORD, col, free_name, unit_hash

#: Category of values without a target of their own, and of missing ones.
OTHER = "other"
SWEEPS = 50
#: Share of a sample's tokens that may be missing in categories too small for their target.
SLACK = 0.02
SEED = "mix"


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text is made of: its legal, tabular or numeric marks, else prose."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(t.rlike("(?i)licen[cs]e"), "legal")
        .when(t.contains(" | "), "tables")
        .when(t.rlike("[0-9]{3}"), "numbers")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    """Words of the whole text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Mix:
    """Raked factors of each category of each dimension, and the share of all tokens to keep."""

    factors: Mapping[str, Mapping[str, float]]
    keep: float

    def probability(self, categories: Mapping[str, Column]) -> Column:
        p = F.lit(self.keep)
        for dim, values in self.factors.items():
            items = [F.lit(x) for pair in values.items() for x in pair]
            p = p * F.coalesce(F.element_at(F.create_map(*items), categories[dim]), F.lit(0.0))
        return F.least(p, F.lit(1.0))


def category(value: Column, shares: Mapping[str, float]) -> Column:
    """The value where it has a target, else ``other``."""
    text = value.cast("string")
    return F.when(text.isin(list(shares)), text).otherwise(F.lit(OTHER))


def full_shares(shares: Mapping[str, float]) -> dict[str, float]:
    """The targets with what they leave to 1 as the share of ``other``."""
    named = {k: float(v) for k, v in shares.items() if k != OTHER}
    if any(v < 0 for v in named.values()) or sum(named.values()) > 1 + 1e-9:
        raise ValueError("target shares are at least 0 and add up to 1 at most")
    return {**named, OTHER: max(0.0, 1.0 - sum(named.values()))}


def rake(weights: np.ndarray, targets: list[np.ndarray], keep: float, sweeps: int = SWEEPS) -> list[np.ndarray]:
    """Factors per dimension; a cell's probability is ``keep`` times its factors, 1 at most.

    Each sweep fits one dimension after the other, so that the expected tokens of every
    category come to its share of ``keep`` times all tokens. A category that holds fewer
    tokens than that is asked for all it has, and a category without any leaves its share to
    the others.
    """
    wanted = keep * weights.sum()
    factors = [np.ones(n) for n in weights.shape]
    for _ in range(sweeps if wanted > 0 else 0):
        for d, target in enumerate(targets):
            rest = tuple(k for k in range(weights.ndim) if k != d)
            held = weights.sum(axis=rest)
            reach = np.where(held > 0, target, 0.0)
            share = reach / reach.sum() if reach.sum() > 0 else reach
            now = (weights * np.minimum(1.0, keep * _outer(factors))).sum(axis=rest)
            goal = np.minimum(share * wanted, held)
            factors[d] = factors[d] * np.divide(goal, now, out=np.zeros_like(now), where=now > 0)
    return factors


def _outer(factors: list[np.ndarray]) -> np.ndarray:
    out = factors[0]
    for f in factors[1:]:
        out = np.multiply.outer(out, f)
    return out


def largest_sample(weights: np.ndarray, targets: list[np.ndarray], slack: float = SLACK) -> float:
    """The largest share of all tokens whose targets can be met but for ``slack`` of the sample in each dimension.

    A category can give no more than it holds. With the categories in order of what they
    hold against their target, the first of them lack most; what any number of them lack
    together must stay within the slack. Where the targets are what is held, all is kept.
    """
    total, most = weights.sum(), 1.0
    for d, target in enumerate(targets):
        held = weights.sum(axis=tuple(k for k in range(weights.ndim) if k != d))
        share = np.where(held > 0, target, 0.0)
        if share.sum() <= 0:
            continue
        share, held = share[share > 0] / share.sum(), held[share > 0] / total
        order = np.argsort(held / share, kind="stable")
        asked, given = np.cumsum(share[order]), np.cumsum(held[order])
        bounds = given[asked > slack] / (asked[asked > slack] - slack)
        most = min(most, float(bounds.min()))
    return most


def fit_mix(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float]], weight: str, keep: float | None, slack: float = SLACK
) -> Mix:
    """Fit the factors to the token weights of ``cells``, one column of categories per dimension.

    Every value without a target is in ``other``, so there are no more cells than the product
    of the targets' sizes, whatever the data holds; that small table is all that is collected.
    """
    shares = {d: full_shares(t) for d, t in targets.items()}
    places = {d: {v: i for i, v in enumerate(s)} for d, s in shares.items()}
    weights = np.zeros([len(s) for s in shares.values()])
    for row in cells.groupBy(*[col(d) for d in shares]).agg(F.sum(col(weight)).alias("__w")).collect():
        weights[tuple(places[d][row[d]] for d in shares)] += row["__w"] or 0
    goals = [np.array(list(s.values())) for s in shares.values()]
    if keep is None:
        keep = largest_sample(weights, goals, slack) if weights.any() else 1.0
    factors = rake(weights, goals, keep)
    return Mix({d: dict(zip(s, f.tolist())) for (d, s), f in zip(shares.items(), factors)}, keep if weights.any() else 0.0)


def mix_sources(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    dimensions: Mapping[str, Column],
    keep: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "mix",
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``tokens, probability, draw, kept``.

    ``targets`` gives the wanted share of tokens per value of each of the ``dimensions`` (a
    column each); values without a target, null included, are one category ``other`` with what
    the targets leave. ``keep`` is the share of all tokens to sample; without it, it is the
    largest one that can meet the targets but for ``SLACK`` (2 %) of the sample in each dimension, so
    categories that are rare against their target are kept whole and hold the others down
    only a little, and nothing is dropped where the marginals fit already. The tokens of the
    cells are raked to all marginals, and a document's probability is ``keep`` times its
    cell's factors, 1 at most. A cell whose category has target 0 gets probability 0: leave a
    share for ``other`` unless rows of other values, and those without any, are to go.

    ``draw`` is a hash of id and text, so a document's fate is the same on every run and
    retry, and repeated rows share it. A null text has no tokens but is drawn like any
    other row; an empty table stays empty; if there are no tokens at all nothing is kept. All
    columns pass through and ``out`` may not be one of them.
    """
    if free_name(docs, out) != out:
        raise ValueError(f"the documents already have a column {out!r}")
    if keep is not None and not 0 < keep <= 1:
        raise ValueError("the share to keep is above 0 and at most 1")
    shares = {d: full_shares(t) for d, t in targets.items()}
    categories = {d: category(dimensions[d], shares[d]) for d in shares}
    tokens = token_count(col(text_col))
    mix = fit_mix(docs.select(*[c.alias(d) for d, c in categories.items()], tokens.alias("__tokens")), targets, "__tokens", keep)
    draw = unit_hash([col(id_col), col(text_col)], seed)
    p = mix.probability(categories)
    return docs.select(
        "*",
        F.struct(tokens.alias("tokens"), p.alias("probability"), draw.alias("draw"), (draw < p).alias("kept")).alias(out),
    )
