"""Loading tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfeat.functions.columns import col
from sparkfeat.sources.schemas import CREDIT_FILES, CREDIT_SCHEMAS, TEXT_PREFIXES


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL, so that one missing marker is left."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select([F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floats else col(c) for c in df.columns])


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | None = None,
    clean: bool = True,
) -> DataFrame:
    """Read one table: Parquet, ORC, or CSV with a header (plain or gzip).

    The format follows the file name unless given. A CSV with a schema is read by header
    name in one pass (see ``load_csv``); without one its types are inferred, which costs
    another pass over the file. ``clean`` turns NaN into NULL; files known to hold no NaN
    can go without, which lets filters on their floating-point columns reach the file.
    """
    fmt = fmt or _format_of(path)
    if fmt == "csv" and schema is not None:
        df = load_csv(spark, path, schema)
    elif fmt == "csv":
        df = spark.read.option("header", True).option("nanValue", "NaN").option("inferSchema", True).csv(path)
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.format(fmt).load(path)
    return nan_to_null(df) if clean else df


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, other: T.DataType | None = None
) -> DataFrame:
    """Read a CSV by its header: declared columns get their types, wherever they stand.

    Columns that are not declared become ``other``, or stay text; declared ones that the
    file lacks are left out. Only the header line is read to plan. An empty cell is NULL, a
    whole number may be written with a fraction of zero, and text that is no number in a
    column of numbers is an error when the rows are read, and is not dropped.
    """
    text = spark.read.option("header", True).csv(path)
    types = {f.name: f.dataType for f in schema}

    def typed(name: str) -> Column:
        kind = types.get(name, other or T.StringType())
        if isinstance(kind, (T.IntegerType, T.LongType)):
            whole = col(name).try_cast("bigint")
            return F.coalesce(whole, col(name).cast("double").cast("bigint")).cast(kind).alias(name)
        return col(name).cast(kind).alias(name)

    return text.select([typed(c) for c in text.columns])


def _format_of(path: str) -> str:
    name = path.rstrip("/").lower()
    if name.endswith((".csv", ".csv.gz", ".csv.bz2")):
        return "csv"
    if name.endswith(".orc"):
        return "orc"
    if name.endswith(".zip"):
        raise ValueError("zip archives cannot be split; unpack to CSV, gzip or Parquet first")
    return "parquet"


def load_credit_tables(
    spark: SparkSession,
    directory: str,
    fmt: str = "csv",
    schemas: Mapping[str, T.StructType] | None = None,
    suffix: str = "",
) -> dict[str, DataFrame]:
    """Load the credit tables by their usual file names, train and test already stacked.

    CSV columns are found by name and get the types that
    :mod:`sparkfeat.sources.schemas` (or ``schemas``) declares, so train and test agree and
    each file is read once. Real exports carry more columns: those named like codes and
    names are text, all others are numbers.
    """
    tables = {}
    for name, stem in CREDIT_FILES.items():
        path = f"{directory}/{stem}.{fmt}{suffix}"
        schema = (schemas or {}).get(name) or CREDIT_SCHEMAS[name.removesuffix("_train").removesuffix("_test")]
        if fmt == "csv":
            header = spark.read.option("header", True).csv(path).columns
            known = {f.name for f in schema}
            texts = [c for c in header if c not in known and c.startswith(TEXT_PREFIXES)]
            full = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in texts]])
            tables[name] = nan_to_null(load_csv(spark, path, full, T.DoubleType()))
        else:
            tables[name] = load_table(spark, path, fmt, (schemas or {}).get(name))
    train, test = tables.pop("application_train"), tables.pop("application_test")
    tables["application"] = union_labelled(train, test)
    return tables


def empty_credit_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], CREDIT_SCHEMAS[name])


def union_labelled(train: DataFrame, test: DataFrame) -> DataFrame:
    """Stack train and test by name. Columns one side lacks, such as the label, are NULL."""
    return train.unionByName(test, allowMissingColumns=True)


def split_labelled(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The labelled rows and the unlabelled rows."""
    return df.filter(col(label).isNotNull()), df.filter(col(label).isNull())
