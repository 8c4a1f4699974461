"""Every query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from sparkfeat.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registry():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(QUERIES)
    # numbers of fits; importance_per_fold, oof_predict and tests check what must hold of them
    assert set(QUERIES) - set(ORACLES) == {"fold_importance", "oof_scores", "boosted_auc_by_round", "stacked_blend", "guided_search"}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 150
    assert df.columns[:2] == ["c_custkey", "label"]
