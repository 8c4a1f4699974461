"""Small random credit tables with the awkward cases on purpose."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfeat.sources.schemas import CREDIT_SCHEMAS

APPLICANTS = 80


def _holes(rng, values, share=0.2):
    out = np.asarray(values, dtype=float)
    out[rng.random(len(out)) < share] = np.nan
    return out


def _pick(rng, n, options, missing=0.1):
    out = rng.choice(options, n).astype(object)
    out[rng.random(n) < missing] = None
    return out


def _fill(rng, frame, name, skip):
    """Random values for every column of the declared schema that is not set yet."""
    n = len(frame)
    for field in CREDIT_SCHEMAS[name]:
        if field.name in frame or field.name in skip:
            continue
        if isinstance(field.dataType, T.StringType):
            frame[field.name] = _pick(rng, n, ["a b", "c/d", "e (f)", "g: h, i"])
        elif isinstance(field.dataType, T.DoubleType):
            frame[field.name] = _holes(rng, rng.integers(0, 50, n))
        else:
            frame[field.name] = rng.integers(0, 40, n)
    return frame[[f.name for f in CREDIT_SCHEMAS[name] if f.name not in skip]]


def credit_pandas(seed: int = 7) -> dict[str, pd.DataFrame]:
    rng = np.random.default_rng(seed)
    ids = np.arange(1001, 1001 + APPLICANTS)
    app = pd.DataFrame({"SK_ID_CURR": ids})
    app["TARGET"] = np.where(np.arange(APPLICANTS) % 4 == 3, np.nan, rng.integers(0, 2, APPLICANTS))
    app["CODE_GENDER"] = rng.choice(["F", "M"], APPLICANTS)
    app.loc[5, "CODE_GENDER"] = "XNA"
    app["FLAG_OWN_CAR"] = rng.choice(["Y", "N"], APPLICANTS)
    app["FLAG_OWN_REALTY"] = rng.choice(["Y", "N"], APPLICANTS)
    app["DAYS_BIRTH"] = -rng.integers(8000, 25000, APPLICANTS)
    app["DAYS_EMPLOYED"] = np.where(rng.random(APPLICANTS) < 0.2, 365243, -rng.integers(0, 9000, APPLICANTS))
    app["AMT_INCOME_TOTAL"] = rng.integers(1, 300, APPLICANTS) * 1000.0
    app["CNT_FAM_MEMBERS"] = _holes(rng, rng.integers(0, 5, APPLICANTS), 0.1)
    app["EXT_SOURCE_1"] = _holes(rng, rng.random(APPLICANTS), 0.5)
    app["EXT_SOURCE_2"] = _holes(rng, rng.random(APPLICANTS), 0.3)
    app["EXT_SOURCE_3"] = _holes(rng, rng.random(APPLICANTS), 0.5)
    app["ORGANIZATION_TYPE"] = rng.choice(["Bank", "School", "Trade: type 7"], APPLICANTS)
    for i in range(2, 22):
        app[f"FLAG_DOCUMENT_{i}"] = (rng.random(APPLICANTS) < 0.1).astype(int)
    app.loc[0, [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]] = 1
    app = _fill(rng, app, "application", ())

    # the last applicants have no history at all
    known = ids[:-6]
    n = 300
    bureau = pd.DataFrame({"SK_ID_CURR": rng.choice(known, n), "SK_ID_BUREAU": np.arange(5000, 5000 + n)})
    # one applicant holds a third of the rows
    bureau.loc[: n // 3, "SK_ID_CURR"] = known[0]
    bureau["CREDIT_ACTIVE"] = rng.choice(["Active", "Closed", "Sold"], n)
    bureau["CREDIT_CURRENCY"] = rng.choice(["currency 1", "currency 2"], n)
    bureau["CREDIT_TYPE"] = _pick(rng, n, ["Consumer credit", "Credit card", "Mortgage"])
    bureau["DAYS_CREDIT"] = -rng.integers(0, 2900, n)
    bureau["DAYS_CREDIT_ENDDATE"] = _holes(rng, rng.integers(-2000, 2000, n))
    bureau = _fill(rng, bureau, "bureau", ())
    # an applicant whose debt is missing everywhere
    bureau.loc[bureau.SK_ID_CURR == known[1], "AMT_CREDIT_SUM_DEBT"] = np.nan

    m = 900
    balance = pd.DataFrame({"SK_ID_BUREAU": rng.integers(5000, 5000 + n - 40, m)})
    balance["MONTHS_BALANCE"] = -rng.integers(0, 60, m)
    balance["STATUS"] = rng.choice(list("012345CX"), m, p=[0.5, 0.1, 0.05, 0.05, 0.05, 0.05, 0.1, 0.1])

    loans = np.arange(9000, 9200)
    owner = dict(zip(loans, rng.choice(known, len(loans)), strict=True))
    prev = pd.DataFrame({"SK_ID_PREV": loans, "SK_ID_CURR": [owner[x] for x in loans]})
    k = len(prev)
    prev["AMT_APPLICATION"] = rng.integers(0, 100, k) * 10.0
    prev["AMT_CREDIT"] = rng.integers(0, 5, k) * 250.0
    prev["NAME_CONTRACT_STATUS"] = rng.choice(["Approved", "Refused", "Canceled"], k)
    for c in ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE"]:
        prev[c] = np.where(rng.random(k) < 0.3, 365243.0, -rng.integers(0, 900, k))
    prev = _fill(rng, prev, "previous_application", ())

    def monthly(rows, name):
        df = pd.DataFrame({"SK_ID_PREV": rng.choice(loans, rows)})
        df["SK_ID_CURR"] = df.SK_ID_PREV.map(owner)
        df["MONTHS_BALANCE"] = -rng.integers(1, 90, rows)
        df["NAME_CONTRACT_STATUS"] = _pick(rng, rows, ["Active", "Completed", "Signed"], 0.05)
        return _fill(rng, df, name, ())

    inst = pd.DataFrame({"SK_ID_PREV": rng.choice(loans, 700)})
    inst["SK_ID_CURR"] = inst.SK_ID_PREV.map(owner)
    inst["NUM_INSTALMENT_NUMBER"] = rng.integers(1, 9, len(inst))
    inst["DAYS_INSTALMENT"] = -rng.integers(1, 500, len(inst)).astype(float)
    inst["DAYS_ENTRY_PAYMENT"] = _holes(rng, inst.DAYS_INSTALMENT + rng.integers(-20, 20, len(inst)), 0.1)
    inst["AMT_INSTALMENT"] = rng.integers(0, 6, len(inst)) * 10.0
    inst["AMT_PAYMENT"] = _holes(rng, rng.integers(0, 6, len(inst)) * 10.0, 0.1)
    inst = _fill(rng, inst, "installments_payments", ())

    return {
        "application": app,
        "bureau": bureau,
        "bureau_balance": balance,
        "previous_application": prev,
        "pos_cash_balance": monthly(500, "pos_cash_balance"),
        "credit_card_balance": monthly(400, "credit_card_balance"),
        "installments_payments": inst,
    }


def to_spark(spark: SparkSession, df: pd.DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """A Spark frame of the same values, NaN as NULL."""
    kinds = {f.name: f.dataType for f in schema} if schema is not None else {}

    def cells(name):
        kind = kinds.get(name)
        cast = int if isinstance(kind, (T.IntegerType, T.LongType)) else float if isinstance(kind, T.DoubleType) else None
        for v in df[name].tolist():
            yield None if pd.isna(v) else cast(v) if cast else v

    rows = list(zip(*[cells(c) for c in df.columns], strict=True))
    return spark.createDataFrame(rows, schema or list(df.columns)).repartition(3)


def credit_tables(spark: SparkSession, frames: dict[str, pd.DataFrame]) -> dict[str, DataFrame]:
    return {n: to_spark(spark, f, CREDIT_SCHEMAS[n]).cache() for n, f in frames.items()}


def assert_same(got: DataFrame, want: pd.DataFrame, key: str, columns: list[str] | None = None) -> None:
    """Every wanted column has the wanted values, per key, to ten significant digits; no NaN inside."""
    rows = got.toPandas().set_index(key).sort_index()
    want = want.sort_index()
    assert rows.index.is_unique
    assert list(rows.index) == list(want.index)
    for c in columns or list(want.columns):
        assert c in rows.columns, f"{c} is missing"
        a, b = rows[c].astype(float), want[c].astype(float)
        np.testing.assert_allclose(a, b.replace([np.inf, -np.inf], np.nan), rtol=1e-9, atol=1e-9, err_msg=c)


def no_nan(df: DataFrame) -> bool:
    """Whether no double cell is NaN or infinite."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    bad = [
        F.count(F.when(F.isnan(F.col(f"`{c}`")) | (F.abs(F.col(f"`{c}`")) == float("inf")), 1)).alias(f"c{i}")
        for i, c in enumerate(doubles)
    ]
    return sum(df.agg(*bad).first()) == 0
