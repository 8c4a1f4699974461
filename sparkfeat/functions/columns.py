"""Choosing and naming columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def col(name: str) -> Column:
    """Column by literal name, safe for names with dots, spaces or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in skip]


def integer_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in skip]


def names_containing(df: DataFrame, part: str, without: Sequence[str] = ()) -> list[str]:
    """Column names that contain ``part`` and none of ``without``."""
    return [c for c in df.columns if part in c and not any(w in c for w in without)]


def document_flags(df: DataFrame) -> list[str]:
    return names_containing(df, "FLAG_DOC")


def contact_flags(df: DataFrame) -> list[str]:
    """Numeric flag columns that are neither document flags nor derived flags.

    String flags (``Y``/``N``) match the name rule too, but row-wise statistics
    skip text, so they are left out here.
    """
    numeric = set(numeric_columns(df))
    return [c for c in names_containing(df, "FLAG_", ("FLAG_DOC", "_FLAG_")) if c in numeric]


def sanitise(name: str) -> str:
    """Replace every character outside ``[A-Za-z0-9_]`` with an underscore."""
    return re.sub("[^A-Za-z0-9_]", "_", name)


def unique_names(names: Sequence[str]) -> list[str]:
    """Make names unique case-insensitively by appending ``_2``, ``_3`` ..."""
    seen: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in seen:
            n += 1
            candidate = f"{name}_{n}"
        seen.add(candidate.lower())
        out.append(candidate)
    return out


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename columns by position in one projection."""
    return df.select([col(old).alias(new) for old, new in zip(df.columns, names, strict=True)])


def sanitise_columns(df: DataFrame) -> DataFrame:
    return rename_all(df, unique_names([sanitise(c) for c in df.columns]))


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Prefix every column but the key columns, so that families never collide."""
    return rename_all(df, [c if c in keep else prefix + c for c in df.columns])


def drop_listed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names that are not there are ignored."""
    gone = set(names)
    return df.select([col(c) for c in df.columns if c not in gone])
