"""Reading, stacking, writing, and whole pipelines from files to files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfeat.learning.estimators import logistic
from sparkfeat.learning.search import Stage
from sparkfeat.plans.pipelines import cross_validate, hold_out, prepare_search, run_formulas, run_search, run_wide
from sparkfeat.plans.selected import SIMPLE, wide_matrix
from sparkfeat.sources.checkpoints import ensure_checkpoint_dir
from sparkfeat.sources.sinks import timestamped, write_matrix, write_predictions
from sparkfeat.sources.schemas import CREDIT_FILES
from sparkfeat.sources.tables import (
    empty_credit_table,
    load_credit_tables,
    load_csv,
    load_table,
    nan_to_null,
    split_labelled,
    union_labelled,
)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert [r["x"] for r in nan_to_null(df).orderBy("k").collect()] == [None, 2.0]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
def test_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 2.5, "a b"), (2, None, "c,d")], "k int, x double, s string")
    path = str(tmp_path / f"t.{fmt}")
    write_matrix(df, path, fmt)
    back = load_table(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2.5, "a b"), (2, None, "c,d")]
    assert back.dtypes == df.dtypes


def test_gzip_and_zip(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write("k,x\n1,\n2,3.5\n")
    got = load_table(spark, str(tmp_path / "t.csv.gz"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, None), (2, 3.5)]
    with pytest.raises(ValueError, match="zip"):
        load_table(spark, "t.csv.zip")


def test_csv_by_header_name(spark, tmp_path):
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())]
    )
    (tmp_path / "a.csv").write_text("s,more,n,k,x\n007,1.5,3.0,9007199254740993,NaN\n,,,2,4\n")
    (tmp_path / "b.csv").write_text("x,k\n1,3\n")
    a = load_table(spark, str(tmp_path / "a.csv"), schema=schema)
    assert dict(a.dtypes) == {"s": "string", "more": "string", "n": "int", "k": "bigint", "x": "double"}
    got = sorted(a.select("k", "x", "n", "s", "more").collect())
    assert [tuple(r) for r in got] == [(2, 4.0, None, None, None), (9007199254740993, None, 3, "007", "1.5")]
    b = load_table(spark, str(tmp_path / "b.csv"), schema=schema)
    assert dict(b.dtypes) == {"x": "double", "k": "bigint"}
    assert load_csv(spark, str(tmp_path / "a.csv"), schema, T.DoubleType()).dtypes[1] == ("more", "double")
    (tmp_path / "c.csv").write_text("x\nabc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_csv(spark, str(tmp_path / "c.csv"), schema).collect()


def test_credit_csv_has_one_type_in_train_and_test(spark, tmp_path):
    for stem in CREDIT_FILES.values():
        (tmp_path / f"{stem}.csv").write_text("SK_ID_CURR\n")
    (tmp_path / "application_train.csv").write_text("AMT_CREDIT,TARGET,NAME_X,APARTMENTS_AVG,SK_ID_CURR\n10,1,5,1,1\n")
    (tmp_path / "application_test.csv").write_text("SK_ID_CURR,NAME_X,AMT_CREDIT,APARTMENTS_AVG\n2,b,10.5,0.25\n")
    df = load_credit_tables(spark, str(tmp_path))["application"]
    types = {"AMT_CREDIT": "double", "TARGET": "int", "NAME_X": "string", "APARTMENTS_AVG": "double", "SK_ID_CURR": "bigint"}
    assert dict(df.dtypes) == types
    assert sorted((r.SK_ID_CURR, r.TARGET, r.NAME_X, r.AMT_CREDIT) for r in df.collect()) == [(1, 1, "5", 10.0), (2, None, "b", 10.5)]


def test_union_and_split(spark):
    train = spark.createDataFrame([(1, 0)], "k int, TARGET int")
    test = spark.createDataFrame([(2,)], "k int")
    labelled, rest = split_labelled(union_labelled(train, test), "TARGET")
    assert [tuple(r) for r in labelled.collect()] == [(1, 0)]
    assert [tuple(r) for r in rest.collect()] == [(2, None)]
    assert empty_credit_table(spark, "bureau_balance").columns == ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"]


def test_predictions_file(spark, tmp_path):
    df = spark.createDataFrame([(7, 0.25)], "SK_ID_CURR bigint, p double")
    write_predictions(df.coalesce(1), str(tmp_path / "out"), "SK_ID_CURR", "p")
    text = "".join(f.read_text() for f in (tmp_path / "out").glob("part-*"))
    assert text == "SK_ID_CURR,TARGET\n7,0.25\n"
    assert timestamped("d", "x", datetime(2020, 1, 2, 3, 4, 5)) == "d/x_2020-01-02_03-04-05"


def test_checkpoint_dir_of_the_session_wins(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark, str(tmp_path))
    assert got == (configured or str(tmp_path))


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """The credit tables as files, train and test apart."""
    directory = str(tmp_path_factory.mktemp("credit"))
    names = {"pos_cash_balance": "POS_CASH_balance"}
    for name, df in tables.items():
        if name == "application":
            train, test = split_labelled(df, "TARGET")
            train.write.parquet(f"{directory}/application_train.parquet")
            test.drop("TARGET").write.parquet(f"{directory}/application_test.parquet")
        else:
            df.write.parquet(f"{directory}/{names.get(name, name)}.parquet")
    return directory


def test_files_to_files(spark, tables, stored, tmp_path):
    loaded = load_credit_tables(spark, stored, "parquet")
    assert set(loaded) == set(tables)
    assert loaded["application"].count() == tables["application"].count()
    # a narrow matrix will do: the wide one is checked elsewhere
    for name, kept in {
        "credit_card_balance": ["SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE"],
        "application": [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)],
    }.items():
        df = loaded[name]
        loaded[name] = df.drop(*kept) if name == "application" else df.select(*kept)
    trees = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.5}
    result = run_wide(loaded, str(tmp_path), SIMPLE, trees, k=2)
    assert result.out_of_fold.count() == 60
    assert result.test.count() == 20
    assert 0 <= result.auc.first()["auc"] <= 1 and result.fold_auc.count() == 2
    written = {p.name.split("_20")[0] for p in tmp_path.iterdir()}
    assert written == {"matrix", "test_predictions", "train_predictions", "importance"}


def test_cross_validation_by_hash(spark, tables):
    wide = wide_matrix(tables, SIMPLE).select("SK_ID_CURR", "TARGET", "EXT_SOURCE_1", "BURO_DAYS_CREDIT_MAX").cache()
    result = cross_validate(wide, {"n_estimators": 2, "max_depth": 2}, k=3)
    assert result.out_of_fold.select("fold").distinct().count() == 3
    flagged = wide.withColumn("is_test", (F.col("SK_ID_CURR") % 2).cast("int"))
    assert [p.count() for p in hold_out(flagged)] == [40, 40]


def test_search_from_features_to_predictions(spark, tables, tmp_path):
    features = tables["application"].select("SK_ID_CURR", "TARGET", "EXT_SOURCE_1", "DAYS_BIRTH").cache()
    data = prepare_search(features, folds=2, repeats=1)
    assert data.names == ("0_EXT_SOURCE_1", "1_DAYS_BIRTH", "0_EXT_SOURCE_1__missing")
    assert data.train.count() + data.held_out.count() == 60 and data.unlabelled.count() == 20
    tuned = run_search(
        features,
        str(tmp_path),
        [Stage("strength", lambda best: {"C": [0.1, 1.0]})],
        {"C": 1.0, "max_iter": 3},
        factory=lambda p: logistic(p, 40),
        folds=2,
        repeats=1,
    )
    assert tuned.best["C"] in (0.1, 1.0)
    assert tuned.predictions.count() == 20 and 0 <= tuned.held_out_auc.first()["auc"] <= 1
    assert len(list(tmp_path.glob("tuned_predictions*"))) == 1


def test_formulas_from_tables_to_predictions(spark, tables, tmp_path):
    formulas = {"i0": "EXT_SOURCE_1 - te_CNT_CHILDREN", "i1": "greatest(DAYS_BIRTH, nans)"}
    trees = {"n_estimators": 1, "max_depth": 1}
    result = run_formulas(tables, formulas, str(tmp_path), trees, k=2, encode=["CNT_CHILDREN"])
    assert result.test.count() == 20
    assert {p.name.split("_20")[0] for p in tmp_path.iterdir()} == {
        "formulas",
        "test_predictions",
        "train_predictions",
        "importance",
    }
