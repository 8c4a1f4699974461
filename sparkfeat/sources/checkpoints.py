"""Where checkpoints go, and frames that are computed once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The session's ``spark.checkpoint.dir``; ``fallback`` is set only where there is none.

    On a cluster the setting, or the fallback, names a folder all executors share. Only a
    local session may have neither: it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        fallback = tempfile.mkdtemp(prefix="sparkfeat-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def stored(df: DataFrame) -> DataFrame:
    """The frame computed once and cut from its lineage, so that several readers share it.

    It lies in the checkpoint folder, survives the loss of executors, and holds no storage
    memory that would have to be released.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
