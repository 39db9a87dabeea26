"""The shape of physical plans: what reaches the scan."""

import re

import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["monthly_kpis", "discount_ltv", "customer_facts_all", "cohort_retention", "rfm_summary"])
def test_status_filter_reaches_the_scan(spark, name):
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualNullSafe\(o_orderstatus,F\)", plan)


def test_only_needed_columns_are_read(spark):
    plan = driver.queries()["discount_rate"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(read) == ["l_orderkey:bigint,l_discount:double", "o_orderkey:bigint,o_orderstatus:string"]


def test_first_rows_are_limited_before_the_shuffle(spark):
    plan = driver.queries()["second_order_pick"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in plan and re.search(r"WindowGroupLimit .*, 2, Partial", before)
