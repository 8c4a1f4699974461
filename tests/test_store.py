"""Feature store, distinct counts in one pass, shares of columns with very many values."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.operators.distinct import Distinct, distinct_counts, merged_shares, share_of, sparse_shares
from sparkfeat.sources.store import FeatureStore


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(rng.choice([1, 2, 3, None]), rng.choice(["a", "b", "c", None]), rng.randrange(40), rng.random() < 0.3) for _ in range(400)]
    return out + [(9, None, 1, False), (9, None, 1, False)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, kind string, n int, flag boolean").cache()


def test_distinct_counts_in_one_pass(df, rows):
    counts = {
        "kinds": Distinct("kind"), "flagged": Distinct("kind", F.col("flag")), "plain": Distinct("kind", ~F.col("flag")),
        "numbers": Distinct("n"), "small": Distinct("n", F.col("n") < 10), "never": Distinct("n", F.col("n") > 1000),
    }
    out = distinct_counts(df, "k", counts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate") == 1
    got = {r["k"]: r.asDict() for r in out.collect()}
    pdf = pd.DataFrame(rows, columns=["k", "kind", "n", "flag"])
    for k, part in pdf.dropna(subset=["k"]).groupby("k"):
        want = {
            "kinds": part.kind.nunique(), "flagged": part[part.flag].kind.nunique(), "plain": part[~part.flag].kind.nunique(),
            "numbers": part.n.nunique(), "small": part[part.n < 10].n.nunique(), "never": None,
        }
        if not part.flag.any():
            want["flagged"] = None
        assert got[k] == {"k": k, **want}
    assert set(got) == {1, 2, 3, 9}


def test_sparse_shares(df, rows):
    shares, table = sparse_shares(df, "k", "kind")
    code = {r["value"]: r["code"] for r in table.collect()}
    assert sorted(code, key=code.get) == ["a", "b", "c", "nan"] and sorted(code.values()) == [0, 1, 2, 3]
    pdf = pd.DataFrame(rows, columns=["k", "kind", "n", "flag"]).dropna(subset=["k"])
    pdf["kind"] = pdf.kind.fillna("nan")
    for r in shares.collect():
        part = pdf[pdf.k == r["k"]].kind.value_counts(normalize=True)
        want = sorted((code[v], s) for v, s in part.items())
        assert list(zip(r["codes"], r["shares"])) == [(c, pytest.approx(s)) for c, s in want] and r["n_rows"] == (pdf.k == r["k"]).sum()
    lone = shares.select("k", share_of(shares, code["a"]).alias("a")).filter("k = 9").first()
    assert lone["a"] == 0.0
    whole = {r["k"]: r for r in shares.collect()}
    halves = [sparse_shares(df.filter(F.col("n") % 2 == i), "k", "kind")[0] for i in (0, 1)]
    codes = [sparse_shares(df.filter(F.col("n") % 2 == i), "k", "kind")[1].count() for i in (0, 1)]
    if codes == [4, 4]:  # the same code tables
        for r in merged_shares(halves[0].unionByName(halves[1]), "k").collect():
            assert r["codes"] == whole[r["k"]]["codes"] and r["shares"] == pytest.approx(whole[r["k"]]["shares"])


def test_families_join_without_a_shuffle(spark, df, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "store"), "k", 4)
    entity = spark.createDataFrame([(i,) for i in range(12)], "k int")
    store.put("entity", entity)
    families = [f"f{i}" for i in range(23)]
    for i, f in enumerate(families):
        store.put(f, df.groupBy("k").agg((F.sum("n") + i).alias("total")))
    wide = store.matrix("entity", families)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 23
    assert wide.columns == ["k", *[f"{f}__total" for f in families]]
    want = {r["k"]: r["t"] for r in df.groupBy("k").agg(F.sum("n").alias("t")).collect()}
    got = {r["k"]: r for r in wide.collect()}
    assert len(got) == 12 and all(got[k][f"f{i}__total"] == (want[k] + i if k in want else None) for k in range(12) for i in range(23))

    before = store.families()
    store.put("f3", df.groupBy("k").agg(F.max("n").alias("most")))
    after = store.families()
    assert {f for f in after if after[f] != before[f]} == {"f3"}
    assert store.get("f3").columns == ["k", "most"]
    again = FeatureStore(spark, str(tmp_path / "store"), "k", 4)  # as another session opens it
    wide = again.matrix("entity", ["f3", "f4"])
    assert wide.columns == ["k", "f3__most", "f4__total"] and "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert wide.count() == 12
    with pytest.raises(KeyError):
        again.get("none")
    store.close()
    again.close()
