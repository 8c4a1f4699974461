"""Compare queries with their SQL twins: ``python -m tests.compare <dir> [query ...]``."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, row count, type families or values. Empty when all agree."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(set(got.columns) ^ set(want.columns))}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    out = []
    types = {n: t for n, t in spark_df.dtypes}
    wanted = {d[0]: str(d[1]).lower() for d in con.execute(f"describe {sql}").fetchall()}
    for c, t in types.items():
        if family(t) != family(wanted[c]):
            out.append(f"type {c}: {t} != {wanted[c]}")
    a, b = _sorted(got), _sorted(want)
    for c in a.columns:
        x, y = a[c], b[c]
        if pd.api.types.is_numeric_dtype(x) and pd.api.types.is_numeric_dtype(y):
            x, y = x.astype(float), y.astype(float)
        bad = ~((x == y) | (x.isna() & y.isna()))
        if bad.any():
            i = bad.idxmax()
            out.append(f"values {c}: {int(bad.sum())} rows, e.g. {x[i]!r} != {y[i]!r}")
    return out


def family(t: str) -> str:
    t = t.lower()
    if t in ("int", "integer", "bigint", "smallint", "tinyint", "int32", "int64"):
        return "int" if t in ("int", "integer") else t
    return {"varchar": "string"}.get(t, t)


def main(argv: list[str]) -> int:
    from sparkfeat.queries import ORACLES, QUERIES

    sf = argv[0]
    names = argv[1:] or list(QUERIES)
    spark, con = session(), connect(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLES:
                found = differences(df, con, ORACLES[name])
            else:
                found = [] if df.count() > 0 else ["no rows"]
        except Exception as e:  # noqa: BLE001
            traceback.print_exc(limit=3)
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
