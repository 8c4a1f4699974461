"""Writing predictions, feature matrices and importance tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from sparkfeat.functions.columns import col


def timestamped(directory: str, name: str, when: datetime | None = None) -> str:
    return f"{directory}/{name}_{(when or datetime.now()):%Y-%m-%d_%H-%M-%S}"


def write_predictions(df: DataFrame, path: str, key: str, prediction: str, label: str = "TARGET") -> None:
    """Write ``(key, label)`` as CSV with a header, one part file per task."""
    df.select(col(key), col(prediction).alias(label)).write.mode("overwrite").csv(path, header=True)


def write_matrix(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)


def write_importance(df: DataFrame, path: str) -> None:
    df.select("feature", "importance", "fold").write.mode("overwrite").csv(path, header=True)
