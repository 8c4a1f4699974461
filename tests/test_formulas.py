"""The formula pipeline against plain pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.operators.formula import formula_chunks, formula_features
from sparkfeat.operators.ranks import HASH_FACTOR, HASH_SPACE, SEED_STEP
from sparkfeat.plans.formulas import (
    FOLDS,
    SEED,
    child_averages,
    encoded_matrix,
    formula_matrix,
    joined_averages,
    merge_suffixed,
)
from tests.credit import assert_same, no_nan
from tests.test_library import KEY


def averaged(df, key, count_of, dummies):
    for c, lead in dummies.items():
        flags = pd.get_dummies(df[c], dtype=int)
        flags.columns = [lead + v for v in flags.columns]
        df = pd.concat([df, flags], axis=1)
    df = df.assign(**{count_of: df.groupby(key)[count_of].transform("count")})
    return df.groupby(key).mean(numeric_only=True)


def test_child_averages(tables, frames):
    bureau, previous, pos, cards, inst = child_averages(tables)
    bb = frames["bureau_balance"]
    bb = bb.assign(buro_count=bb.groupby("SK_ID_BUREAU").MONTHS_BALANCE.transform("count"))
    flags = pd.get_dummies(bb.STATUS, prefix="buro_bal_status", dtype=int)
    months = pd.concat([bb.drop(columns="STATUS"), flags], axis=1).groupby("SK_ID_BUREAU").mean().add_prefix("avg_buro_")
    df = frames["bureau"].join(months, on="SK_ID_BUREAU")
    want = averaged(df, KEY, "SK_ID_BUREAU", {"CREDIT_ACTIVE": "ca__", "CREDIT_CURRENCY": "cu__", "CREDIT_TYPE": "ty__"})
    assert_same(bureau, want, KEY)
    p = frames["previous_application"]
    text = {c: f"{c}_" for c in p.columns if p[c].dtype == object}
    assert_same(previous, averaged(p, KEY, "SK_ID_PREV", text), KEY)
    status = "NAME_CONTRACT_STATUS"
    assert_same(pos, averaged(frames["pos_cash_balance"], KEY, "SK_ID_PREV", {status: ""}), KEY)
    want = averaged(frames["credit_card_balance"], KEY, "SK_ID_PREV", {status: "cc_bal_status__"})
    assert_same(cards, want.add_prefix("cc_bal_"), KEY)
    want = averaged(frames["installments_payments"], KEY, "SK_ID_PREV", {}).add_prefix("inst_")
    assert_same(inst, want, KEY)


def test_merge_suffixed(spark):
    left = spark.createDataFrame([(1, 2.0, 3.0)], ["k", "A", "b"])
    right = spark.createDataFrame([(1, 5.0, 6.0)], ["k", "a", "c"])
    out = merge_suffixed(left, right, "k")
    assert out.columns == ["k", "A_x", "b", "a_y", "c"]
    assert out.first().asDict() == {"k": 1, "A_x": 2.0, "b": 3.0, "a_y": 5.0, "c": 6.0}


@pytest.fixture(scope="module")
def joined(tables):
    return joined_averages(tables).cache()


def test_joined_names(joined, frames):
    assert joined.count() == len(frames["application"])
    for name in ["AMT_ANNUITY_x", "AMT_ANNUITY_y", "AMT_ANNUITY", "AMT_CREDIT_x", "AMT_CREDIT_y"]:
        assert name in joined.columns
    for name in ["SK_ID_PREV_x", "SK_ID_PREV_y", "ca__Closed", "ty__Credit_card", "cc_bal_AMT_BALANCE"]:
        assert name in joined.columns
    assert "NAME_CONTRACT_STATUS_Refused" in joined.columns


def test_encoded_matrix(joined):
    columns = ["CNT_CHILDREN", "ORGANIZATION_TYPE", KEY]
    got = encoded_matrix(joined, columns)
    raw = joined.toPandas().sort_values(KEY).reset_index(drop=True)
    train, test = raw[raw.TARGET.notna()], raw[raw.TARGET.isna()]
    fold = ((train[KEY] % HASH_SPACE * (HASH_FACTOR + SEED * SEED_STEP) + SEED) % HASH_SPACE) % FOLDS
    parts = []
    te = {}
    for c in columns:
        smoothing = (~test[c].isin(train[c])).mean()
        own, rest = pd.Series(index=train.index, dtype=float), pd.Series(0.0, index=test.index)
        for j in range(FOLDS):
            seen = train[fold != j]
            prior = seen.TARGET.mean()
            stats = seen.groupby(c).TARGET.agg(["mean", "count"])
            if smoothing == 0:
                weight = (stats["count"] > 100).astype(float)
            else:
                weight = 1 / (1 + np.exp(-(stats["count"] - 100) / smoothing))
            enc = prior * (1 - weight) + stats["mean"] * weight
            own[fold == j] = train[c][fold == j].map(enc).fillna(prior)
            rest += test[c].map(enc).fillna(prior) / FOLDS
        te[f"te_{c}"] = pd.concat([own, rest])
    both = pd.concat([train, test]).assign(**te)
    both["nans"] = both.drop(columns="TARGET").isna().sum(axis=1)
    for c in columns[:2]:
        both[f"cnt_{c}"] = both[c].map(both[c].value_counts() / len(both))
    features = [c for c in both.columns if c not in (KEY, "TARGET")]
    x = both[features].astype(float)
    sd = x.std(ddof=0)
    want = ((x - x.mean()) / sd.where(sd > 0)).fillna(0.0)
    want[KEY] = both[KEY]
    assert set(got.features) == set(features)
    wide = got.frame.cache()
    assert no_nan(wide)
    # a constant column has no spread to speak of, so compare those with some
    varied = [c for c in features if sd[c] > 1e-9]
    assert_same(wide, want.set_index(KEY)[varied], KEY)


def test_formula_matrix(spark, tables):
    formulas = {f"i{i}": f"greatest(EXT_SOURCE_1, te_CNT_CHILDREN) * {i}.5 - nans" for i in range(120)}
    out = formula_matrix(tables, formulas, ["CNT_CHILDREN", "CODE_GENDER"]).cache()
    assert out.columns == [KEY, "TARGET", *formulas]
    assert out.count() == tables["application"].count()
    assert no_nan(out)
    assert out.filter("abs(i7) > 1").count() == 0


def test_formulas_of_equal_rows_are_evaluated_once(spark, monkeypatch):
    """The wide formulas read each different input once, and count all of its rows."""
    from sparkfeat.queries import encodings

    rows = [(0, 0, 0, 1.0, 2.0, None, 4.0)] * 30 + [(1, 0, 0, None, 5.0, 6.0, 7.0)] * 20 + [(2, 0, 0, 3.0, 9.0, 1.0, 0.0)]
    lines = spark.createDataFrame(rows, "l_orderkey int, l_partkey int, l_suppkey int, num double, qty double, disc double, tax double")
    read = []

    def chunks(df, *args):
        read.append(df.count())
        return formula_chunks(df, *args)

    monkeypatch.setattr(encodings, "gappy_lines", lambda spark, sf: lines)
    monkeypatch.setattr(encodings, "formula_chunks", chunks)
    got = {r["formula"]: r["n_above"] for r in encodings.formulas_wide(spark, "").collect()}
    assert read == [3]
    z = encodings.standardise(lines, encodings.STANDARD)
    few = dict(list(encodings.wide_formulas().items())[:20])
    counts = formula_features(z, few).agg(*[F.count_if(F.col(n) > encodings.WIDE_CUT).alias(n) for n in few]).first()
    assert {n: got[n] for n in few} == counts.asDict()
    assert len(got) == 512
