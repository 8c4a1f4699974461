"""A store of feature families that lie in the same buckets, so that they join without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from sparkfeat.functions.columns import col

MANIFEST = "family string, version bigint, path string, ddl string"


class FeatureStore:
    """Families of features of one entity below a folder, each a Parquet table bucketed and sorted by the key.

    A manifest beside them says which version of a family counts. Writing a family again adds a
    version and touches no other family. Any session that can read the folder can open the
    store; ``buckets`` is fixed when it is made.
    """

    def __init__(self, spark: SparkSession, directory: str, key: str, buckets: int) -> None:
        self.spark, self.directory, self.key, self.buckets = spark, directory.rstrip("/"), key, buckets
        self._tables: dict[str, str] = {}

    def put(self, family: str, df: DataFrame) -> None:
        """Write or replace a family, one row per key; rows without a key are left out."""
        version = max((r["version"] for r in self._manifest() if r["family"] == family), default=0) + 1
        path = f"{self.directory}/{family}/v{version}-{uuid.uuid4().hex}"
        rows = df.filter(col(self.key).isNotNull())
        name = f"family_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.option("path", path).saveAsTable(name)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        line = self.spark.createDataFrame([(family, version, path, ddl)], MANIFEST)
        line.coalesce(1).write.mode("append").json(f"{self.directory}/_manifest")
        self._tables[path] = name

    def _manifest(self) -> list:
        """One row per version of each family."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.directory}/_manifest").collect()
        except Exception as missing:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(missing):
                return []
            raise

    def families(self) -> dict[str, str]:
        """The path of each family's newest version."""
        return {r["family"]: r["path"] for r in sorted(self._manifest(), key=lambda r: r["version"])}

    def get(self, family: str) -> DataFrame:
        newest = [r for r in self._manifest() if r["family"] == family]
        if not newest:
            raise KeyError(family)
        row = max(newest, key=lambda r: r["version"])
        if row["path"] not in self._tables:  # written by another session
            name = f"family_{uuid.uuid4().hex}"
            self.spark.sql(
                f"create table {name} ({row['ddl']}) using parquet "
                f"clustered by (`{self.key}`) sorted by (`{self.key}`) into {self.buckets} buckets location '{row['path']}'"
            )
            self._tables[row["path"]] = name
        return self.spark.table(self._tables[row["path"]])

    def matrix(self, entity: str, families: Sequence[str]) -> DataFrame:
        """The entity's rows with all columns of the families, named ``<family>__<feature>``; nothing is shuffled."""
        parts = [
            self.get(f).select(col(self.key), *[col(c).alias(f"{f}__{c}") for c in self.get(f).columns if c != self.key]).hint("merge")
            for f in families
        ]
        return reduce(lambda left, right: left.join(right, self.key, "left"), parts, self.get(entity))

    def close(self) -> None:
        """Take the tables out of the session's catalog; the files stay."""
        for name in self._tables.values():
            self.spark.sql(f"drop table if exists {name}")
        self._tables = {}
