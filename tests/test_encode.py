"""Encoders, scaling, grids and formulas on small rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sparkfeat.learning.grids import Normal, Uniform, expand_grid, random_grid
from sparkfeat.operators import encode, lookup
from sparkfeat.operators.encode import (
    FoldEncoding,
    Scaler,
    frequency_encode,
    noise,
    standardise,
    target_encode,
    unseen_shares,
)
from sparkfeat.operators.formula import formula_features
from sparkfeat.operators.lookup import counted_lookup, keep_listed, unseen_share


@pytest.fixture(scope="module")
def train(spark):
    rows = [("a", 1), ("a", 1), ("a", 0), ("b", 0), ("b", 1), ("c", 1), (None, 0)]
    return spark.createDataFrame([(i, c, y) for i, (c, y) in enumerate(rows)], "id int, c string, y int")


@pytest.fixture(scope="module")
def test(spark):
    return spark.createDataFrame([(10, "a"), (11, "b"), (12, "zzz"), (13, None)], "id int, c string")


def values(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_target_encoding_without_smoothing_is_a_step(train, test):
    got = values(target_encode(train, test, "c", "y", "e", min_samples_leaf=2, smoothing=0.0), "e")
    prior = 4 / 7
    # a has three rows, above the limit; b has two, at the limit
    assert got == {10: pytest.approx(2 / 3), 11: pytest.approx(prior), 12: pytest.approx(prior), 13: pytest.approx(prior)}


def test_target_encoding_blends(train, test):
    got = values(target_encode(train, test, "c", "y", "e", min_samples_leaf=2, smoothing=0.5), "e")
    prior, w = 4 / 7, 1 / (1 + math.exp(-(3 - 2) / 0.5))
    assert got[10] == pytest.approx(prior * (1 - w) + 2 / 3 * w)
    assert got[11] == pytest.approx((prior + 0.5) / 2)
    assert got[12] == got[13] == pytest.approx(prior)


def test_target_encoding_takes_extreme_exponents(train, test):
    got = values(target_encode(train, test, "c", "y", "e", min_samples_leaf=100, smoothing=1e-9), "e")
    assert got[10] == pytest.approx(4 / 7)


def test_smoothing_may_come_from_the_data(train, test):
    share = unseen_share(train, test, "c")
    got = values(target_encode(train, test, "c", "y", "e", min_samples_leaf=2, smoothing=share), "e")
    w = 1 / (1 + math.exp(-(3 - 2) / 0.25))
    assert got[10] == pytest.approx(4 / 7 * (1 - w) + 2 / 3 * w)


def test_unseen_share(spark, train, test):
    assert spark.range(1).select(unseen_share(train, test, "c")).first()[0] == 0.25
    assert unseen_shares(train, test, ["c"]) == {"c": 0.25}
    whole = train.filter("c is not null")
    assert unseen_shares(whole, test, ["c"]) == {"c": 0.5}
    assert spark.range(1).select(unseen_share(whole, test, "c")).first()[0] == 0.5


@pytest.mark.parametrize("limit", [100_000, 0])
def test_fold_encoding(train, test, monkeypatch, limit):
    """The same results whether the table is broadcast or shuffled."""
    monkeypatch.setattr(encode, "MAX_BROADCAST_ROWS", limit)
    folded = train.withColumn("fold", F.col("id") % 2)
    fitted = FoldEncoding.fit(folded, ["c"], "y", "fold", 2, min_samples_leaf=0, smoothing=0.0)
    # fold 0 rows 0 2 4 6: a1 a0 b1 -0; fold 1 rows 1 3 5: a1 b0 c1
    assert fitted.priors == (pytest.approx(2 / 3), 0.5)
    own = values(fitted.transform(folded, "fold"), "te_c")
    assert own == {
        0: 1.0,
        1: 0.5,
        2: 1.0,
        3: 1.0,
        4: 0.0,
        # c occurs in its own fold only, and a missing category in none: the prior
        5: 0.5,
        6: pytest.approx(2 / 3),
    }
    rest = values(fitted.transform(test), "te_c")
    mean_prior = (2 / 3 + 0.5) / 2
    assert rest == {10: 0.75, 11: 0.5, 12: pytest.approx(mean_prior), 13: pytest.approx(mean_prior)}


def test_fold_encoding_of_one_frame(train, test):
    """Train and test rows in one frame: a row without a fold is a test row."""
    folded = train.withColumn("fold", F.col("id") % 2)
    fitted = FoldEncoding.fit(folded, ["c"], "y", "fold", 2, min_samples_leaf=0, smoothing=0.0)
    both = folded.select("id", "c", "fold").unionByName(test, allowMissingColumns=True)
    got = values(fitted.transform(both, "fold"), "te_c")
    assert got == {**values(fitted.transform(folded, "fold"), "te_c"), **values(fitted.transform(test), "te_c")}


def test_frequency(train):
    got = values(frequency_encode(train, ["c", "id"]), "cnt_c")
    assert got[0] == pytest.approx(3 / 7) and got[5] == pytest.approx(1 / 7) and got[6] is None


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, None), (None, 5.0, None)], "a double, b double, c double")
    assert [tuple(r) for r in standardise(df, ["a", "b", "c"]).collect()] == [(-1.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    assert Scaler.fit(df, ["a"]).stats == {"a": (2.0, 1.0)}


def test_noise(spark):
    df = spark.range(100).select(F.lit(2.0).alias("x"))
    assert df.select(noise(F.col("x"), 0.0, 1).alias("n")).distinct().collect()[0]["n"] == 2.0
    assert df.select(noise(F.col("x"), 0.1, 1).alias("n")).distinct().count() == 100


def test_formula(spark):
    df = spark.createDataFrame([(1, 0.5, -2.0)], "k int, a double, b double")
    out = formula_features(df, {"i0": "if(a > 0, -3.0, b)", "i1": "cast(a > b as double) * greatest(a, b)"}, ["k"])
    row = out.first()
    assert (row["k"], row["i0"], row["i1"]) == (1, pytest.approx(math.tanh(-3)), pytest.approx(math.tanh(0.5)))


@pytest.mark.parametrize("limit", [100, 0])
def test_counted_lookup(spark, train, limit):
    table = spark.createDataFrame([("a", 1.5)], "c string, x double")
    got = values(counted_lookup(train, table, "c", limit), "x")
    assert got[0] == 1.5 and got[3] is None and got[6] is None and len(got) == 7


def test_keep_listed(spark, train):
    listed = spark.createDataFrame([("a",), ("a",), ("q",)], "c string")
    assert keep_listed(train, listed, "c").count() == 3
    assert lookup.MAX_BROADCAST_ROWS == 100_000


def test_expand_grid(spark):
    grid = expand_grid(spark, {"a": [1, 2], "b": [0.5], "c": ["x", "y", "z"]})
    assert grid.columns == ["a", "b", "c"]
    assert {tuple(r) for r in grid.collect()} == {(a, 0.5, c) for a in (1, 2) for c in "xyz"}


def test_random_grid(spark):
    space = {"depth": [3, 5], "rate": Uniform(0.1, 0.2), "l2": Normal(0.0, 1.0, low=0.0), "n": Uniform(2, 5, whole=True)}
    draws = random_grid(spark, space, 200, 4)
    rows = draws.collect()
    assert rows == random_grid(spark, space, 200, 4).collect()
    assert {r["depth"] for r in rows} == {3, 5} and {r["n"] for r in rows} == {2, 3, 4}
    assert all(0.1 <= r["rate"] < 0.2 and r["l2"] >= 0 for r in rows)
    with pytest.raises(TypeError, match="rate"):
        random_grid(spark, {"rate": 0.3})
