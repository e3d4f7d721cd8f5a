"""Every registered query against its SQL counterpart, on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLES) == {"train_score", "model_search"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLES[name], SF_DIR) == []


@pytest.mark.parametrize("name", ["train_score", "model_search"])
def test_model_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["use_chip", "total_tx", "fraud_count", "fraud_rate_pct", "avg_amount"]
    assert result.count() > 0
