import os

import pytest
import sql_check

import __spark_entry__ as driver
from daymart.plans.expected_sql import EXPECTED_SQL
from daymart.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    opened = sql_check.connect(SF_DIR)
    yield opened
    opened.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED_SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(EXPECTED_SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = QUERIES[name](spark, SF_DIR)
    sql_check.assert_same(result, connection, EXPECTED_SQL[name])
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct"):
        assert operator not in plan


def test_entry(spark):
    assert driver.entry(spark).count() == 5
