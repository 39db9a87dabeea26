"""Data quality checks on tables with faults, and the file readers."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronage.plans import enrichment, kpis, quality
from patronage.sources import files
from patronage.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS


def test_orphans_count_rows_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    row = quality.foreign_keys({"child": child, "parent": parent}, [("child", "k", "parent")]).first()
    assert (row.orphans, row.status) == (3, "FAIL")


def test_primary_key_faults(spark):
    good = spark.createDataFrame([(1,), (2,)], "k long")
    bad = spark.createDataFrame([(1,), (1,), (1,), (None,)], "k long")
    rows = {r.key_name: r for r in quality.primary_keys({"good": (good, "k"), "bad": (bad, "k")}).collect()}
    assert (rows["good.k"].is_unique, rows["good.k"].surplus) == (True, 0)
    assert (rows["bad.k"].is_unique, rows["bad.k"].surplus, rows["bad.k"].nulls) == (False, 2, 1)


def test_reconciliation(spark):
    one, two = spark.range(1), spark.range(2)
    rows = quality.reconcile_counts({"a": one, "b": one, "gone": one}, {"a": one, "b": two}).collect()
    assert {r.table_name: (r.expected, r.actual, r.status) for r in rows} == {
        "a": (1, 1, "OK"),
        "b": (1, 2, "MISMATCH"),
        "gone": (1, None, "MISMATCH"),
    }


def test_coverage(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,)], "order_id long")
    items = spark.createDataFrame([(1,), (1,), (2,)], "order_id long")
    events = spark.createDataFrame([(1,), (2,), (2,), (3,)], "order_id long")
    row = quality.order_coverage(orders, items, events).first()
    assert (row.orders, row.orders_without_item, row.orders_without_delivery, row.orders_with_several_deliveries) == (3, 1, 0, 1)
    assert (row.every_order_has_item, row.exactly_one_delivery) == (False, False)


def test_lifecycle_ignores_unknown_customers_in_the_customer_share(spark):
    orders = spark.createDataFrame([("A",), ("B",), ("B",), ("ghost",)], "customer_id string")
    customers = spark.createDataFrame([("A",), ("B",), ("C",)], "customer_id string")
    row = quality.lifecycle_shares(orders, customers).first()
    assert row.one_order_pct == pytest.approx(200 / 3) and row.at_most_one_order_pct == pytest.approx(200 / 3)
    assert row.max_orders == 2


def test_summary_matches_pandas(spark):
    values = [Decimal(str(v)) for v in (1.5, 2.25, 2.25, 9.0, 100.75, 3.0)]
    df = spark.createDataFrame([(v, None if i == 0 else i) for i, v in enumerate(values)], "a decimal(10,2), b int")
    found = {r.metric: r for r in quality.numeric_summary(df, ["a", "b"]).collect()}
    for name, row in found.items():
        expected = df.select(F.col(name).cast("double")).toPandas()[name].dropna().describe()
        got = [row.n, row["mean"], row.std, row["min"], row.q25, row.q50, row.q75, row["max"]]
        assert [float(x) for x in got] == pytest.approx(list(expected))


def test_model_csv_round_trip(spark, tmp_path):
    table = SCHEMAS["orders"]
    row = ("O1", "C1", "R1", date(2024, 1, 6), 9, "Saturday", "2024-01", 1, 2, Decimal("10.50"), Decimal("9.00"), "UPI", "Delivered")
    files.write_csv(spark.createDataFrame([row], table), str(tmp_path / "orders.csv"))
    back = files.read_csv(spark, str(tmp_path / "orders.csv"), table)
    assert [tuple(r) for r in back.collect()] == [row]
    assert [f.dataType for f in back.schema] == [f.dataType for f in table]


def test_bad_csv_row_ends_the_job(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("customer_id,signup_date,acquisition_channel,city,cohort_month\nC1,not a date,a,b,2024-01\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|CANNOT_PARSE|FAILED_READ"):
        files.read_csv(spark, str(path), SCHEMAS["customers"]).collect()


def test_wrong_header_ends_the_job(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("id,signup_date,acquisition_channel,city,cohort_month\nC1,2024-01-01,a,b,2024-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(path), SCHEMAS["customers"]).collect()


def test_schema_contract_is_consistent():
    for child, key, parent in FOREIGN_KEYS:
        assert key in SCHEMAS[child].names and key == PRIMARY_KEYS[parent]
    assert all(not field.nullable for schema in SCHEMAS.values() for field in schema)


def test_flags_and_views(spark):
    df = files.flags_as_numbers(spark.createDataFrame([(True,), (False,)], "f boolean"))
    files.register_views({"flag_view": df})
    assert sorted(r.f for r in spark.sql("SELECT f FROM flag_view").collect()) == [0, 1]


def test_summary_keeps_small_and_large_values(spark):
    rows = [(Decimal("0.001000"), 10**17, 1.5), (Decimal("0.004000"), 3, None), (Decimal("0.012600"), None, 2.5)]
    df = spark.createDataFrame(rows, "a decimal(18,6), b bigint, c double")
    exact = {r.metric: r for r in quality.numeric_summary(df, ["a", "b"]).collect()}
    assert (exact["a"].n, float(exact["a"].min), float(exact["a"].max)) == (3, 0.001, 0.0126)
    assert exact["a"].mean == pytest.approx(0.0176 / 3) and exact["a"].q50 == pytest.approx(0.004)
    assert exact["b"].n == 2 and int(exact["b"].max) == 10**17
    mixed = {r.metric: r for r in quality.numeric_summary(df, ["a", "c"]).collect()}
    assert (mixed["c"].min, mixed["c"].q50, mixed["c"].max) == (1.5, 2.0, 2.5)


def test_never_ordered_lists_customers_without_any_order(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,), (4,)], "customer_id long")
    orders = spark.createDataFrame([(10, 1, "Delivered"), (11, 1, "Delivered"), (12, 3, "Cancelled")], "order_id long, customer_id long, order_status string")
    assert sorted(r.customer_id for r in kpis.never_ordered(customers, orders).collect()) == [2, 4]


def test_month_filter_reads_only_its_folders(spark, tmp_path):
    orders = spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 5)), (3, date(2024, 2, 6))], "order_id long, order_date date")
    files.write_parquet(enrichment.with_calendar(orders), str(tmp_path / "orders"), partition_by=["order_month"])
    kept = spark.read.parquet(str(tmp_path / "orders")).filter("order_month = '2024-02'")
    assert kept.count() == 2
    assert "PartitionFilters: [isnotnull(order_month" in kept._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["decimal(12,2)", "double", "bigint"])
def test_quartiles_are_exact_on_many_rows_and_ties(spark, layout, kind):
    value = F.when(F.col("id") % 3 == 0, F.lit(5000)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 100)
    df = spark.range(60_000).select(value.cast(kind).alias("a"), F.when(F.col("id") % 7 > 0, (F.col("id") % 4).cast(kind)).alias("b"), F.lit(None).cast(kind).alias("c"))
    found = {r.metric: r for r in quality.numeric_summary(df, ["a", "b", "c"]).collect()}
    assert set(found) == {"a", "b"}
    for name, row in found.items():
        expected = df.agg(F.percentile(F.col(name).cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
        assert [row.q25, row.q50, row.q75] == pytest.approx(expected, rel=1e-12)
