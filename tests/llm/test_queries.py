"""The registered queries: names, columns, and SQL where there is some."""

import os

import pytest

import __spark_entry__ as driver
from compare import difference, duck
from patronage.llm import queries

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_each_operator_has_one_query():
    names = [n for n in driver.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.oracle_sql()[name]) is None
