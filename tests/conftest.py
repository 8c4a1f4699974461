from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from sparkfeat.sources.checkpoints import ensure_checkpoint_dir
from tests.credit import credit_pandas, credit_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session, str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frames():
    """The credit tables as pandas frames."""
    return credit_pandas()


@pytest.fixture(scope="session")
def tables(spark, frames):
    """The credit tables as Spark frames."""
    return credit_tables(spark, frames)


@pytest.fixture(scope="module")
def plain_execution(spark):
    """Skip run-time re-planning: on tiny rows wide plans spend their time there.

    The query tests run with it.
    """
    names = ["spark.sql.adaptive.enabled"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "false")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)
