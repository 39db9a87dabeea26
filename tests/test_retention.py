"""Retention rules on literal rows: boundaries, censoring, and where the two rules differ."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from patronage.operators.facts import customer_timeline, delivered, order_facts, snapshot_date
from patronage.plans import exports, retention, segments

DAY0 = date(2024, 1, 1)


def orders(spark, rows):
    """rows: (customer, day offset); every order is delivered, ids follow the list order."""
    data = [(i, c, DAY0 + timedelta(days=d), "Delivered") for i, (c, d) in enumerate(rows)]
    return spark.createDataFrame(data, "order_id long, customer_id string, order_date date, order_status string")


def flags(spark, rows, snapshot):
    at = F.lit(DAY0 + timedelta(days=snapshot))
    found = retention.with_flags(customer_timeline(orders(spark, rows)), at)
    return {r.customer_id: r for r in found.collect()}


@pytest.mark.parametrize(
    "days, snapshot, gap, strict, eligible",
    [
        ([0, 0], 200, True, False, True),
        ([0, 1], 200, True, True, True),
        ([0, 90], 200, True, True, True),
        ([0, 91], 200, False, False, True),
        ([0, 5], 10, True, True, True),
        ([0], 10, False, False, False),
        ([0, 0, 30], 200, True, True, True),
        ([0, 0, 120], 200, True, False, True),
        ([0], 89, False, False, False),
        ([0], 90, False, False, True),
    ],
)
def test_rules(spark, days, snapshot, gap, strict, eligible):
    row = flags(spark, [("X", d) for d in days], snapshot)["X"]
    assert (row.retained_gap, row.retained_strict, row.eligible) == (gap, strict, eligible)


def test_gap_contains_strict(spark, layout):
    rows = [(f"c{i}", (i * j * 37) % 140) for i in range(60) for j in range(1 + i % 4)]
    rows += [("same", 0), ("same", 0), ("later", 0), ("later", 0), ("later", 120)]
    found = flags(spark, rows, 120).values()
    assert len(found) == 62
    assert all(r.retained_gap or not r.retained_strict for r in found)
    assert any(r.retained_gap and not r.retained_strict for r in found)


def test_open_outcome_is_null(spark):
    df = orders(spark, [("POS", 0), ("POS", 5), ("OPEN", 0)])
    found = retention.retention_flags_strict(df, F.lit(DAY0 + timedelta(days=10)))
    rows = {r.customer_id: r for r in found.collect()}
    assert (rows["POS"].retained_raw, rows["POS"].eligible, rows["POS"].retained) == (True, True, True)
    assert (rows["OPEN"].retained_raw, rows["OPEN"].eligible, rows["OPEN"].retained) == (False, False, None)


def test_first_order_of_a_day_is_the_lowest_id(spark, layout):
    df = spark.createDataFrame(
        [(7, "A", DAY0, "Delivered", 55), (3, "A", DAY0, "Delivered", 5), (1, "A", DAY0 + timedelta(days=1), "Delivered", 20)],
        "order_id long, customer_id string, order_date date, order_status string, delivery_delay_min int",
    )
    row = customer_timeline(df).collect()[0]
    assert (row.first_order_id, row.first_delay, row.orders, row.first_day_orders) == (3, 5, 3, 2)
    assert row.second_date == DAY0 and row.second_day == DAY0 + timedelta(days=1)


def test_text_ids(spark):
    df = spark.createDataFrame(
        [("O2", "A", DAY0, "Delivered"), ("O1", "A", DAY0, "Delivered")],
        "order_id string, customer_id string, order_date date, order_status string",
    )
    assert customer_timeline(df).collect()[0].first_order_id == "O1"


def test_several_discounts_of_one_order_count_once(spark):
    base = orders(spark, [("A", 0), ("A", 40)])
    events = base.select("order_id", F.lit(12).alias("delivery_delay_min"))
    discounts = spark.createDataFrame([(0,), (0,), (0,)], "order_id long")
    facts = order_facts(base, events, discounts)
    assert facts.count() == 2
    assert {r.order_id: r.is_discounted for r in facts.collect()} == {0: True, 1: False}


def test_one_pass_binding_equals_three_tables(spark):
    from patronage.sources.binding import BoundTables

    b = BoundTables(spark, "/root/testdata/sf0.001")
    columns = ["order_id", "delivery_delay_min", "is_discounted", "order_status"]
    joined = order_facts(b.orders, b.delivery_events, b.discounts).select(*columns)
    direct = b.facts.select(*columns)
    assert joined.count() == direct.count()
    assert joined.exceptAll(direct).count() == 0


def test_rules_differ_on_the_larger_tables(spark):
    """At sf0.01 an engine that swaps the rules would pass; here 1,624 and 1,617 tell them apart."""
    from patronage.sources.binding import BoundTables

    good = delivered(BoundTables(spark, "/root/testdata/sf0.1").orders)
    found = retention.with_flags(customer_timeline(good.select("customer_id", "order_date")), snapshot_date(good))
    row = found.agg(
        F.count_if("retained_gap").alias("gap"),
        F.count_if("retained_strict").alias("strict"),
        F.count_if("eligible").alias("eligible"),
        F.count(F.lit(1)).alias("n"),
    ).collect()[0]
    assert (row.gap, row.strict, row.eligible, row.n) == (1624, 1617, 14413, 14489)


def test_filtered_kpis(spark):
    people = spark.createDataFrame(
        [("A", "X", "p"), ("B", "X", "q"), ("C", "Y", "p"), ("D", "Y", "q")],
        "customer_id string, city string, acquisition_channel string",
    )
    bought = orders(spark, [("A", 0), ("A", 10), ("B", 0), ("C", 195)]).withColumn(
        "net_order_value", F.lit(10).cast("decimal(10,2)")
    )
    everyone = exports.customer_facts_all(people, bought)
    at = F.lit(DAY0 + timedelta(days=200))
    row = exports.filtered_kpis(everyone, at, city="X").collect()[0]
    assert (row.ordering_customers, float(row.total_gmv)) == (3, 40.0)
    assert (row.filtered_customers, row.eligible_customers, row.retained_customers, row.retention_pct) == (2, 2, 1, 50.0)
    assert exports.filtered_kpis(everyone, at, city="Y").collect()[0].retention_pct is None


def test_buckets_add_up_to_the_eligible(spark):
    from patronage.sources.binding import BoundTables

    b = BoundTables(spark, "/root/testdata/sf0.01")
    outcomes = retention.delay_outcomes_strict(b.facts)
    listed = retention.delay_retention_strict(outcomes).collect()
    assert sum(r.customer_count for r in listed) == outcomes.agg(F.sum("customers")).collect()[0][0]
    bands = segments.discount_ltv(b.facts, snapshot_date(b.orders)).agg(F.sum("customer_count")).collect()[0][0]
    assert bands == 1418
