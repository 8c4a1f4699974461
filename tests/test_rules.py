"""The rules for missing values, on rows small enough to work out by hand."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.functions.columns import (
    drop_listed,
    names_containing,
    prefix_columns,
    sanitise,
    sanitise_columns,
    unique_names,
)
from sparkfeat.functions.scalars import (
    RowStat,
    differs_flag,
    not_negative_flag,
    null_count,
    payment_columns,
    product,
    ratio,
    sentinel_to_null,
    with_row_stats,
)
from sparkfeat.operators.aggregate import aggregate, filled_sum, subset_ratios
from sparkfeat.operators.assemble import assemble, assemble_families, number_columns
from sparkfeat.operators.categories import Vocabulary, category_counts, first_seen_codes, label_codes, one_hot, with_codes
from sparkfeat.operators.impute import fill_global_mean, global_means


def one(df):
    return [tuple(r) for r in df.collect()]


def test_ratio_never_leaves_the_numbers(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, None, None, 1.5]


def test_sentinel_keeps_type(spark):
    df = spark.createDataFrame([(365243, 365243.0), (-3, 4.0)], "a int, b double")
    out = sentinel_to_null(df, ["a", "b"])
    assert one(out) == [(None, None), (-3, 4.0)]
    assert out.dtypes == df.dtypes


def test_flags_count_missing_as_one(spark):
    df = spark.createDataFrame([("Closed", -1.0), ("Active", 0.0), (None, None)], "s string, d double")
    assert one(df.select(differs_flag("s", "Closed"), not_negative_flag("d"))) == [(0, 0), (1, 1), (1, 1)]


def test_payment_columns(spark):
    # late, early, never paid, nothing due
    rows = [(10.0, 5.0, -10.0, -4.0), (10.0, 10.0, -10.0, -15.0), (10.0, None, -10.0, None), (0.0, 5.0, -10.0, -10.0)]
    df = spark.createDataFrame(rows, "due double, paid double, due_day double, paid_day double")
    made = payment_columns("due", "paid", "due_day", "paid_day")
    assert list(made) == ["PAYMENT_PERC", "PAYMENT_DIFF", "DPD", "DBD"]
    assert one(df.select(*made.values())) == [
        (0.5, 5.0, 6.0, 0.0),
        (1.0, 0.0, 0.0, 5.0),
        (None, None, 0.0, 0.0),
        (None, -5.0, 0.0, 0.0),
    ]


def test_row_stats_like_pandas(spark):
    rng = np.random.default_rng(1)
    wide = pd.DataFrame(rng.integers(0, 3, (60, 6)).astype(float), columns=list("abcdef"))
    wide = wide.mask(rng.random(wide.shape) < 0.4)
    wide.iloc[0] = 1.0
    wide.iloc[1] = np.nan
    stats = [RowStat(f, f, tuple("abcdef")) for f in ["sum", "mean", "std", "kurt"]]
    from tests.credit import to_spark

    df = to_spark(spark, wide.reset_index(), None)
    df = df.select("index", *[F.col(c).cast("double").alias(c) for c in "abcdef"])
    got = with_row_stats(df, stats).toPandas().sort_values("index").reset_index(drop=True)
    assert set(got.columns) == {"index", *"abcdef", "sum", "mean", "std", "kurt"}
    for f in ["sum", "mean", "std", "kurt"]:
        np.testing.assert_allclose(got[f].astype(float), getattr(wide, f)(axis=1), rtol=1e-9, atol=1e-9, err_msg=f)
    assert got["kurt"][0] == 0


def test_product_and_null_count(spark):
    df = spark.createDataFrame([(2.0, 3.0), (2.0, None)], "a double, b double")
    assert one(df.select(product("a", "b"), null_count(["a", "b"]))) == [(6.0, 0), (None, 1)]


def test_names(spark):
    assert sanitise("Cash loan (non-earmarked): a/b,c") == "Cash_loan__non_earmarked___a_b_c"
    assert unique_names(["a", "A", "b", "a"]) == ["a", "A_2", "b", "a_3"]
    df = spark.createDataFrame([(1, 2, 3)], ["k", "x/y", "x y"])
    assert sanitise_columns(df).columns == ["k", "x_y", "x_y_2"]
    assert names_containing(df, "x", ("/",)) == ["x y"]
    assert prefix_columns(df, "p_", ["k"]).columns == ["k", "p_x/y", "p_x y"]
    assert drop_listed(df, ["x/y", "nope"]).columns == ["k", "x y"]
    assert number_columns(df, ["k"]).columns == ["k", "0_x/y", "1_x y"]


ROWS = [
    (1, "A", 1.0),
    (1, "A", None),
    (1, "B", None),
    (2, "A", None),
    (3, "B", 5.0),
    (3, "B", 7.0),
    (None, "A", 9.0),
]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(ROWS, "k int, s string, v double")


def by_key(df, *columns):
    return {r["k"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_aggregate_rules(small):
    spec = {"v": ["sum", "mean", "var", "std", "count", "size", "nunique", "min", "max", "median"]}
    out = aggregate(small, "k", spec, "P_")
    names = [f"P_v_{f.upper()}" for f in spec["v"]]
    got = by_key(out, *names)
    assert set(got) == {1, 2, 3}
    # one value among three rows; all missing; two values
    assert got[1] == (1.0, 1.0, None, None, 1, 3, 1, 1.0, 1.0, 1.0)
    assert got[2] == (0.0, None, None, None, 0, 1, 0, None, None, None)
    assert got[3] == (12.0, 6.0, 2.0, pytest.approx(2**0.5), 2, 2, 2, 5.0, 7.0, 6.0)


def test_subset_without_rows_is_null_but_missing_values_sum_to_zero(small):
    spec = {"v": ["sum", "size", "nunique", "mean"]}
    subsets = {"A_": (F.col("s") == "A", spec), "B_": (F.col("s") == "B", spec)}
    out = aggregate(small, "k", {}, subsets=subsets)
    names = [f"{p}v_{f}" for p in ["A_", "B_"] for f in ["SUM", "SIZE", "NUNIQUE", "MEAN"]]
    got = by_key(out, *names)
    assert got[1] == (1.0, 2, 1, 1.0, 0.0, 1, 0, None)
    assert got[2] == (0.0, 1, 0, None, None, None, None, None)
    assert got[3] == (None, None, None, None, 12.0, 2, 2, 6.0)
    ratios = subset_ratios(out, spec, "A_", "B_", "R_")
    assert list(ratios) == ["R_v_SUM", "R_v_SIZE", "R_v_NUNIQUE", "R_v_MEAN"]
    assert by_key(out.select("k", *[e.alias(n) for n, e in ratios.items()]), "R_v_SUM", "R_v_SIZE")[1] == (None, 2.0)


def test_unknown_aggregate(small):
    with pytest.raises(ValueError, match="unknown aggregate"):
        aggregate(small, "k", {"v": ["mode"]})


def test_category_counts_leave_absent_ones_null(small):
    got = by_key(small.filter("k is not null").groupBy("k").agg(*category_counts("s", ["A", "B"], "S_")), "S_A", "S_B")
    assert got == {1: (2, 1), 2: (1, None), 3: (None, 2)}


def test_global_mean_fill(small):
    filled = fill_global_mean(small, ["v"]).filter("k = 2").first()
    assert filled["v"] == pytest.approx(22 / 4)
    total = filled_sum(F.col("v"), global_means(small, ["v"])["v"])
    got = by_key(small.filter("k is not null").groupBy("k").agg(total.alias("t")), "t")
    assert got == {1: (pytest.approx(12.0),), 2: (pytest.approx(5.5),), 3: (pytest.approx(12.0),)}


def test_vocabulary(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "k int, c string")
    known = Vocabulary.fit(df)
    assert known.values == {"c": ("a", "b")}
    assert one(one_hot(df, known, missing=True)) == [(1, 0, 1, 0), (2, 0, 0, 1), (3, 1, 0, 0), (4, 0, 1, 0)]
    # the same columns whatever values the scored rows hold
    other = spark.createDataFrame([(9, "z")], "k int, c string")
    assert one(one_hot(other, known)) == [(9, 0, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        Vocabulary.fit(df, max_values=1)


def test_code_tables(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, None, "x"), (3, "a", None), (4, "b", None)], "k int, c string, d string")
    table = lambda t: {(r["column"], r["value"]): r["code"] for r in t.collect()}
    first = first_seen_codes(df, ["c", "d"], "k")
    assert table(first) == {("c", "b"): 0, ("c", "a"): 1, ("d", "x"): 0}
    assert one(with_codes(df, first, ["c", "d"], unknown=-1)) == [(1, 0, 0), (2, -1, 0), (3, 1, -1), (4, 0, -1)]
    labels = label_codes(df, ["c"])
    assert table(labels) == {("c", "a"): 0, ("c", "b"): 1, ("c", "nan"): 2}
    assert [r["c"] for r in with_codes(df, labels, ["c"], missing="nan").orderBy("k").collect()] == [1, 2, 0, 1]
    assert with_codes(df, first_seen_codes(df.limit(0), ["c"], "k"), ["c"], unknown=-1).filter("c <> -1").count() == 0


def test_codes_of_very_many_values(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("c"))
    coded = with_codes(df, first_seen_codes(df, ["c"], "id"), ["c"], unknown=-1)
    assert coded.filter("id <> c").count() == 0
    many = with_codes(df, label_codes(df, ["c"]), ["c"])
    assert many.agg(F.countDistinct("c"), F.min("c"), F.max("c")).first()[:] == (20_000, 0, 19_999)


def test_assemble_keeps_rows_and_refuses_clashes(spark):
    entity = spark.createDataFrame([(1, 0.0), (2, 1.0)], "k int, a double")
    child = spark.createDataFrame([(1, 5.0)], "k int, b double")
    assert sorted(one(assemble(entity, [child], "k"))) == [(1, 0.0, 5.0), (2, 1.0, None)]
    with pytest.raises(ValueError, match="more than one frame"):
        assemble(entity, [child, child], "k")
    assert assemble_families(entity, {"x": child, "y": child}, "k").columns == ["k", "a", "x__b", "y__b"]


def test_wide_states_of_scattered_keys_are_not_shuffled(spark, monkeypatch):
    """Rows of keys with few rows are shuffled as they are; those of a heavy key still combine first."""
    from sparkfeat.operators import aggregate as module

    monkeypatch.setattr(module, "SCATTERED_FROM", 1000)
    n = F.col("id")
    key = F.when(n % 2 == 0, 0).when(n % 97 != 0, n)
    few = spark.range(20_000).select(F.floor(n / 3).alias("k"), *[(n * (i + 3) % 101).cast("double").alias(f"c{i}") for i in range(4)])
    heavy = spark.range(20_000).select(key.alias("k"), *[(n * (i + 5) % 103).cast("double").alias(f"c{i}") for i in range(4)])
    deep = few.withColumn("k", F.col("k") % 7)
    funcs = ["min", "max", "mean", "sum", "count"]
    spec = {f"c{i}": funcs for i in range(4)}
    for rows, dealt, combined in ((few, True, False), (heavy, True, True), (deep, False, True)):
        out = module.aggregate(rows, "k", spec)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("RepartitionByExpression" in plan) == dealt
        assert ("Union" in plan) == (dealt and combined)
        plain = rows.filter("k is not null").groupBy("k").agg(*module.spec_columns(spec, module.upper_suffix()))
        assert sorted(out.collect()) == sorted(plain.collect())
