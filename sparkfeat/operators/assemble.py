"""Joining feature frames onto the entity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from sparkfeat.functions.columns import prefix_columns, rename_all


def assemble(entity: DataFrame, frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Left join frames of one row per key onto the entity; its row count never changes.

    Every frame leaves its aggregation partitioned by ``key``, so after the entity's own
    exchange the chain of joins shuffles nothing more.
    """
    names = Counter(c.lower() for f in [entity, *frames] for c in f.columns if c != key)
    clash = sorted(n for n, k in names.items() if k > 1)
    if clash:
        raise ValueError(f"column names occur in more than one frame: {clash[:5]}; prefix the frames")
    return reduce(lambda left, right: left.join(right, key, "left"), frames, entity)


def assemble_families(entity: DataFrame, families: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Like :func:`assemble`, with each family's columns named ``<family>__<column>``."""
    return assemble(entity, [prefix_columns(f, f"{name}__", [key]) for name, f in families.items()], key)


def number_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rename columns to ``<position>_<name>``, which makes any set of names unique."""
    rest = [c for c in df.columns if c not in keep]
    position = {c: i for i, c in enumerate(rest)}
    return rename_all(df, [c if c in keep else f"{position[c]}_{c}" for c in df.columns])
