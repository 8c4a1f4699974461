"""What the text operators share: places for intermediate rows, word rules, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the plain rule: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Maps the bytes A-Z to a-z and leaves all others, so UTF-8 text stays valid.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may do without the
    setting; it gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    own = getattr(spark.sparkContext, "_sparkfeat_shared", None)
    if own is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="sparkfeat-")
        spark.sparkContext._sparkfeat_shared = own
    return own


def kept(df: DataFrame) -> DataFrame:
    """The frame computed once and cut from its lineage, in the shared folder."""
    spark = df.sparkSession
    place = shared_dir(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(place)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def unit_hash(parts: Sequence[Column], salt: str) -> Column:
    """A number in [0, 1) from the given values; the same on every run and engine."""
    text = F.concat_ws("\x1f", F.lit(salt), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
