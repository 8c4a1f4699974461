"""The 23 builders against plain pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from sparkfeat.functions.columns import contact_flags, document_flags
from sparkfeat.plans import library, specs
from tests.credit import assert_same, no_nan

KEY = "SK_ID_CURR"

pytestmark = pytest.mark.usefixtures("plain_execution")


def div(a, b):
    return (a / b).replace([np.inf, -np.inf], np.nan)


def means(df, drop):
    return df.groupby(KEY).mean(numeric_only=True).drop(columns=drop)


@pytest.fixture(scope="module")
def app(frames):
    df = frames["application"].set_index(KEY)
    return df.assign(DAYS_EMPLOYED=df.DAYS_EMPLOYED.replace(365243, np.nan))


def test_relative_calculation(tables, app):
    want = pd.DataFrame({n: div(app[a], app[b]) for n, (a, b) in specs.RELATIVE_RATIOS.items()})
    assert_same(library.gen_relative_calculation(tables["application"]), want, KEY)
    reduced = library.gen_reduced_relative_calculation(tables["application"])
    assert_same(reduced, want[specs.REDUCED_RATIOS], KEY)
    assert len(reduced.columns) == 5


def test_new_relative_feature(tables, app):
    docs, live = document_flags(tables["application"]), contact_flags(tables["application"])
    assert len(docs) == 20
    assert live == [
        "FLAG_MOBIL",
        "FLAG_EMP_PHONE",
        "FLAG_WORK_PHONE",
        "FLAG_CONT_MOBILE",
        "FLAG_PHONE",
        "FLAG_EMAIL",
    ]
    scores = app[list(specs.SCORES)]
    want = pd.DataFrame(
        {
            "CREDIT_TO_GOODS_RATIO": div(app.AMT_CREDIT, app.AMT_GOODS_PRICE),
            "DOC_IND_KURT": app[docs].kurtosis(axis=1),
            "LIVE_IND_SUM": app[live].sum(axis=1),
            "INCOME_PER_CHLD": app.AMT_INCOME_TOTAL / (1 + app.CNT_CHILDREN),
            "INCOME_BY_ORG": app.ORGANIZATION_TYPE.map(app.groupby("ORGANIZATION_TYPE").AMT_INCOME_TOTAL.median()),
            "NEW_ANNUITY_TO_INCOME_RATIO": app.AMT_ANNUITY / (1 + app.AMT_INCOME_TOTAL),
            "SOURCES_PRODUCT": scores.iloc[:, 0] * scores.iloc[:, 1] * scores.iloc[:, 2],
            "EXT_SOURCES_MEAN": scores.mean(axis=1),
            "EXT_SOURCES_STD": scores.std(axis=1).fillna(scores.std(axis=1).mean()),
            "CAR_TO_BIRTH_RATIO": div(app.OWN_CAR_AGE, app.DAYS_BIRTH),
            "CAR_TO_EMPLOY_RATIO": div(app.OWN_CAR_AGE, app.DAYS_EMPLOYED),
            "PHONE_TO_BIRTH_RATIO": div(app.DAYS_LAST_PHONE_CHANGE, app.DAYS_BIRTH),
            "PHONE_TO_EMPLOY_RATIO": div(app.DAYS_LAST_PHONE_CHANGE, app.DAYS_EMPLOYED),
        }
    )
    got = library.gen_new_relative_feature(tables["application"])
    assert_same(got, want, KEY)
    assert len(got.columns) == 14


def attached(frames):
    bb = frames["bureau_balance"]
    months = bb.groupby("SK_ID_BUREAU").MONTHS_BALANCE.agg(["min", "max", "size"])
    months.columns = ["MONTHS_BALANCE_MIN", "MONTHS_BALANCE_MAX", "MONTHS_BALANCE_SIZE"]
    counts = bb.groupby(["SK_ID_BUREAU", "STATUS"]).size().unstack()
    counts.columns = [f"STATUS_{c}" for c in counts.columns]
    return frames["bureau"].join(months, on="SK_ID_BUREAU").join(counts, on="SK_ID_BUREAU")


def spec_frame(df, spec, prefix=""):
    out = df.groupby(KEY).agg(spec)
    out.columns = [f"{prefix}{a}_{b.upper()}" for a, b in out.columns]
    return out


def test_bur_month_balance(tables, frames):
    want = spec_frame(attached(frames), specs.BUREAU_SPEC)
    got = library.gen_bur_month_balance(tables["bureau"], tables["bureau_balance"])
    assert_same(got, want, KEY)
    assert len(got.columns) == 30


def test_bureau_families(tables, frames):
    b = frames["bureau"]
    by = b.groupby(KEY)
    variety = pd.DataFrame({"BUREAU_LOAN_COUNT": by.DAYS_CREDIT.count(), "BUREAU_LOAN_TYPES": by.CREDIT_TYPE.nunique()})
    variety["AVERAGE_LOAN_TYPE"] = div(variety.BUREAU_LOAN_COUNT, variety.BUREAU_LOAN_TYPES)
    assert_same(library.gen_credit_variety(tables["bureau"]), variety, KEY)

    active = (b.CREDIT_ACTIVE != "Closed").astype(int).groupby(b[KEY]).agg(["sum", "mean"])
    active.columns = ["ACTIVE_COUNT", "ACTIVE_LOANS_PERCENTAGE"]
    assert_same(library.gen_bureau_active(tables["bureau"]), active, KEY)

    time = (~(b.DAYS_CREDIT_ENDDATE < 0)).astype(int).groupby(b[KEY]).agg(["mean", "max"])
    time.columns = ["MEAN_CREDIT_TIME", "MAX_CREDIT_TIME"]
    assert_same(library.gen_bureau_credit_time(tables["bureau"]), time, KEY)

    loans = b[b.DAYS_CREDIT_ENDDATE > 0].groupby(KEY).agg({"DAYS_CREDIT_ENDDATE": "max", "SK_ID_BUREAU": "count"})
    loans.columns = ["MAX_DAYS_CREDIT_ENDDATE", "COUNT_SK_ID_BUREAU"]
    assert_same(library.gen_loan_count(tables["bureau"]), loans, KEY)


def test_day_credit_group(tables, frames):
    b = frames["bureau"].sort_values([KEY, "DAYS_CREDIT"], ascending=[True, False])
    gap = (-b.DAYS_CREDIT).groupby(b[KEY]).diff()
    gap = gap.fillna(gap.mean()).astype("int64")
    want = gap.groupby(b[KEY]).agg(["mean", "max"])
    want.columns = ["MEAN_DAYS_DIFF", "MAX_DAYS_DIFF"]
    assert_same(library.gen_day_credit_group(tables["bureau"]), want, KEY)


def test_debt_families(tables, frames):
    b = frames["bureau"]
    filled = b.fillna(b[["AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE", "CNT_CREDIT_PROLONG"]].mean())
    sums = filled.groupby(KEY)[["AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE"]].sum()
    debt = div(sums.AMT_CREDIT_SUM_DEBT, sums.AMT_CREDIT_SUM).to_frame("DEBT_CREDIT_RATIO")
    overdue = div(sums.AMT_CREDIT_SUM_OVERDUE, sums.AMT_CREDIT_SUM_DEBT).to_frame("OVERDUE_DEBT_RATIO")
    prolong = filled.groupby(KEY).CNT_CREDIT_PROLONG.mean().to_frame("AVG_CREDITDAYS_PROLONGED")
    assert_same(library.gen_cust_debt_to_credit(tables["bureau"]), debt, KEY)
    assert_same(library.gen_cust_overdue_debt(tables["bureau"]), overdue, KEY)
    assert_same(library.gen_avg_prolong(tables["bureau"]), prolong, KEY)


def test_avg_buro(tables, frames):
    df = attached(frames)
    dummies = pd.get_dummies(df, columns=["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"])
    dropped = ["SK_ID_BUREAU", "MONTHS_BALANCE_MIN", "MONTHS_BALANCE_MAX", "MONTHS_BALANCE_SIZE"]
    want = means(dummies, dropped).add_prefix("MEAN_OF_")
    want["BUREAU_COUNT"] = df.groupby(KEY).SK_ID_BUREAU.count()
    got = library.gen_avg_buro(tables["bureau"], tables["bureau_balance"])
    assert_same(got, want, KEY)
    assert len(got.columns) == len(want.columns) + 1


def with_status_stats(df):
    codes = {v: i for i, v in enumerate(sorted(df.NAME_CONTRACT_STATUS.fillna("nan").unique()))}
    code = df.NAME_CONTRACT_STATUS.fillna("nan").map(codes)
    per_key = code.groupby(df[KEY]).agg(["nunique", "max"])
    return df.assign(
        NUNIQUE_STATUS=df[KEY].map(per_key["nunique"]), MAX_NUNIQUE_STATUS=df[KEY].map(per_key["max"])
    )


def test_pos_cash(tables, frames):
    p = frames["pos_cash_balance"]
    by = p.groupby(KEY)
    cols = specs.POS_CASH_MEASURES
    want = by[cols].max().add_prefix("MAX_OF_").join(by[cols].mean().add_prefix("MEAN_OF_"))
    want["COUNT_OF_SK_ID_PREV"] = by.SK_ID_PREV.count()
    assert_same(library.gen_pos_cash_features(tables["pos_cash_balance"]), want, KEY)
    assert_same(library.gen_agg_pos_cash(tables["pos_cash_balance"]), spec_frame(p, specs.POS_CASH_SPEC), KEY)
    want = means(with_status_stats(p), ["SK_ID_PREV"]).add_prefix("MEAN_OF_")
    assert_same(library.gen_mean_pos_cash(tables["pos_cash_balance"]), want, KEY)


def test_credit_card(tables, frames):
    c = frames["credit_card_balance"]
    assert_same(
        library.gen_avg_credit_card_bal(tables["credit_card_balance"]),
        means(c, ["SK_ID_PREV"]).add_prefix("MEAN_OF_"),
        KEY,
    )
    numeric = c.drop(columns=["SK_ID_PREV", "NAME_CONTRACT_STATUS"])
    want = spec_frame(numeric, {x: ["min", "max", "sum", "var"] for x in numeric.columns if x != KEY})
    want["CC_COUNT"] = c.groupby(KEY).size()
    got = library.gen_agg_credit_card_bal(tables["credit_card_balance"])
    assert_same(got, want, KEY)
    want = means(with_status_stats(c), ["SK_ID_PREV"]).add_prefix("MEAN_OF_")
    assert_same(library.gen_credit_card_bal(tables["credit_card_balance"]), want, KEY)


def test_previous(tables, frames):
    p = frames["previous_application"]
    asked = p.assign(APP_CREDIT_PERC=div(p.AMT_APPLICATION, p.AMT_CREDIT))
    got = library.gen_agg_prev(tables["previous_application"])
    assert_same(got, spec_frame(asked, specs.PREVIOUS_SPEC), KEY)
    assert len(got.columns) == 21 - 1 + 1
    text = [c for c in p.columns if p[c].dtype == object]
    want = means(pd.get_dummies(p, columns=text), ["SK_ID_PREV"]).add_prefix("MEAN_OF_")
    want["COUNT_OF_SK_ID_PREV"] = p.groupby(KEY).SK_ID_PREV.count()
    assert_same(library.gen_avg_prev(tables["previous_application"]), want, KEY)


def payments(frames):
    i = frames["installments_payments"]
    late = i.DAYS_ENTRY_PAYMENT - i.DAYS_INSTALMENT
    return i.assign(
        PAYMENT_PERC=div(i.AMT_PAYMENT, i.AMT_INSTALMENT),
        PAYMENT_DIFF=i.AMT_INSTALMENT - i.AMT_PAYMENT,
        DPD=late.where(late > 0, 0),
        DBD=(-late).where(-late > 0, 0),
    )


def test_installments(tables, frames):
    i = frames["installments_payments"]
    got = library.gen_agg_installments(tables["installments_payments"])
    assert_same(got, spec_frame(payments(frames), specs.INSTALLMENTS_SPEC), KEY)
    assert len(got.columns) == 30
    by = i.groupby(KEY)
    parts = [
        getattr(by, f)().drop(columns="SK_ID_PREV").add_prefix(f"{f.upper()}_OF_") for f in ["mean", "max", "min"]
    ]
    want = parts[0].join(parts[1]).join(parts[2])
    assert_same(library.gen_avg_payments(tables["installments_payments"]), want, KEY)


def test_prev_installment_feature(tables, frames):
    i = frames["installments_payments"]
    s = i.sort_values(["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"])
    step = s.groupby("SK_ID_PREV").NUM_INSTALMENT_NUMBER.diff()
    s = s.assign(step=step.fillna(step.mean()))
    loan = pd.DataFrame({"STD_OF_INSTALLMENT_SEQ": s.groupby("SK_ID_PREV").step.std()})
    late = (i.DAYS_INSTALMENT - i.DAYS_ENTRY_PAYMENT).groupby(i.SK_ID_PREV).mean()
    short = (i.AMT_INSTALMENT - i.AMT_PAYMENT).groupby(i.SK_ID_PREV).mean()
    loan["MEAN_OF_LATE_INSTALLMENT"] = late.fillna(late.mean())
    loan["MEAN_OF_INSUFFICIENT_PAYMENT"] = short.fillna(short.mean())
    want = i[[KEY, "SK_ID_PREV"]].join(loan, on="SK_ID_PREV").groupby(KEY).mean().drop(columns="SK_ID_PREV")
    want = want.fillna(want.mean())
    assert_same(library.gen_prev_installment_feature(tables["installments_payments"]), want, KEY)


def test_all_features_equal_the_builders(tables, frames):
    frames_by_name = library.feature_frames(tables)
    assert len(frames_by_name) == 23
    got = library.all_features(tables).cache()
    assert got.count() == len(frames["application"])
    assert no_nan(got)
    rows = got.toPandas().set_index(KEY).sort_index()
    total = 0
    for name, frame in frames_by_name.items():
        want = frame.toPandas().set_index(KEY).reindex(rows.index)
        total += len(want.columns)
        for c in want.columns:
            np.testing.assert_allclose(
                rows[f"{name}__{c}"].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=f"{name} {c}"
            )
    assert total == len(got.columns) - 2


def test_result_does_not_depend_on_partitioning(spark, tables):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = library.gen_day_credit_group(tables["bureau"]).toPandas().sort_values(KEY).reset_index(drop=True)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        many = library.gen_day_credit_group(tables["bureau"]).toPandas().sort_values(KEY).reset_index(drop=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    pd.testing.assert_frame_equal(one, many)
