"""Every named query against its SQL on the same files: columns, types and all values."""

import os

import pytest

import __spark_entry__ as driver
from patronage import catalog
from compare import difference, duck

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
# all pairs of two sides, or rows handed to Python
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    assert difference(df, connection, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
