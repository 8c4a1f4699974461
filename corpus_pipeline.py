"""The stages that make a training corpus out of ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and gives the rows it keeps, with the columns of
``documents``. The last adds the shard. ``run`` writes each stage's rows to the shared
folder and reads them back before the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.llm.common import col, free_name, fresh_path
from sparkfeat.llm.queries import GOOD, SHARD_BYTES, mixed, quality_model
from sparkfeat.llm.sharding import assign_shards
from sparkfeat.llm.similar import drop_similar
from sparkfeat.llm.wu_manber import find_passages, hit_words


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled ones."""
    model = quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(model.score(F.col("text")) >= GOOD)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id stays.

    SimHash fingerprints that differ in two bits or fewer link documents, and an exact check of each link follows
    (five-word shingles, similarity 0.8); similar documents whose fingerprints differ more are added to the links.
    """
    return drop_similar(docs, shingle=5, similar=0.8, bits=2)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    out = free_name(docs, "found")
    found = find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=out)
    return found.filter(hit_words(col(out)) == 0).select(*[col(c) for c in docs.columns])


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample whose tokens have the target shares of sources, languages and topics."""
    out = free_name(docs, "mix")
    return mixed(docs, out).filter(col(out)["kept"]).select(*[col(c) for c in docs.columns])


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the label of their shard."""
    out = free_name(docs, "shard")
    return assign_shards(docs, SHARD_BYTES, out=out).withColumn(out, col(out)["label"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmarks),
    ("mixing", mixed_to_targets),
    ("sharding", into_shards),
]

#: The stages fit models and follow links, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
