"""The whole job on model tables in CSV, checked against pandas on the same rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage import job
from patronage.operators.facts import customer_timeline, delivered, snapshot_date
from patronage.plans import retention
from patronage.sources import files
from patronage.sources.model import ModelTables
from patronage.sources.schemas import SCHEMAS

START = date(2024, 1, 1)


def model_rows(n_customers=40, hot=True):
    """Every third order belongs to one customer; ids are text, days repeat."""
    customers = [(f"C{i:03d}", START, "Organic" if i % 2 else "Referral", "X" if i % 3 else "Y", "2024-01") for i in range(n_customers)]
    restaurants = [("R1", "X", "Italian", "Mid", 1)]
    orders, items, events, discounts = [], [], [], []
    for i in range(360):
        who = "C000" if hot and i % 3 == 0 else f"C{(i * 7) % (n_customers - 2):03d}"
        day = START + timedelta(days=(i * i * 13) % 300)
        net = Decimal(100 + (i * 37) % 900).quantize(Decimal("0.01"))
        status = "Cancelled" if i % 11 == 0 else "Refunded" if i % 13 == 0 else "Delivered"
        oid = f"O{i:05d}"
        orders.append((oid, who, "R1", day, i % 24, day.strftime("%A"), day.strftime("%Y-%m"), int(day.weekday() > 4), 1, net, net, "UPI", status))
        items.append((f"I{i}", oid, "x", "Sides", 1, net))
        at = datetime(day.year, day.month, day.day, i % 24)
        events.append((f"E{i}", oid, at, at, at, Decimal((i * 17) % 640) / 10, 30, "Late"))
        for k in range(1 + (i % 2) if i % 4 == 0 else 0):
            discounts.append((f"D{i}-{k}", oid, "Flat", Decimal("5.00"), Decimal("0.0"), "In-App Promo"))
    return dict(customers=customers, restaurants=restaurants, orders=orders, order_items=items, delivery_events=events, discounts=discounts)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("model")
    for name, rows in model_rows().items():
        files.write_csv(spark.createDataFrame(rows, SCHEMAS[name]), str(path / f"{name}.csv"))
    return path


def test_job_writes_every_result(spark, folder, tmp_path):
    assert job.run(spark, "csv", str(folder), str(tmp_path), "parquet")
    for name in (*job.VIEWS, *job.RESULTS):
        assert spark.read.parquet(str(tmp_path / name)).count() > 0, name
    assert spark.sql("SELECT * FROM v_customer_segments").columns[-1] == "is_churned"
    assert len(spark.table("v_customer_segments").columns) == 16


def write_model(spark, folder, change=None):
    rows = model_rows()
    if change:
        change(rows)
    for name, part in rows.items():
        kinds = T.StructType([T.StructField(f.name, f.dataType, True) for f in SCHEMAS[name]])
        files.write_csv(spark.createDataFrame(part, kinds), f"{folder}/{name}.csv")


def no_signup(rows):
    rows["customers"][3] = (*rows["customers"][3][:1], None, *rows["customers"][3][2:])


def second_event(rows):
    rows["delivery_events"].append(("E-again", *rows["delivery_events"][0][1:]))


def repeated_order(rows):
    rows["orders"].append(rows["orders"][0])


def lost_customer(rows):
    rows["customers"] = rows["customers"][1:]


@pytest.mark.parametrize(
    "change, fault",
    [
        (no_signup, "customers.signup_date"),
        (second_event, "delivery_events.order_id"),
        (repeated_order, "orders.order_id"),
        (lost_customer, "orders.customer_id -> customers"),
    ],
)
def test_job_stops_on_faults(spark, tmp_path, change, fault):
    write_model(spark, tmp_path / "in", change)
    assert not job.run(spark, "csv", str(tmp_path / "in"), str(tmp_path / "out"), "parquet")
    found = {r.subject for r in spark.read.parquet(str(tmp_path / "out" / "load_checks")).filter("status = 'FAIL'").collect()}
    assert fault in found
    assert not (tmp_path / "out" / "cohort_retention").exists()


def test_job_stops_on_a_date_that_is_none(spark, tmp_path):
    write_model(spark, tmp_path / "in")
    broken = tmp_path / "in" / "customers.csv"
    part = next(broken.glob("part-*.csv"))
    part.write_text(part.read_text().replace("2024-01-01", "2024-13-01", 1))
    (broken / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="2024-13-01|malformed|MALFORMED|parse"):
        job.run(spark, "csv", str(tmp_path / "in"), str(tmp_path / "out"), "parquet")


def test_a_lost_row_is_found(spark, folder):
    given = ModelTables.read(spark, str(folder), "csv")
    loaded = ModelTables(spark=spark, **{**given.tables(), "discounts": given.discounts.limit(3)})
    found = {(r["check"], r.subject): r.status for r in job.verify(given, loaded).collect()}
    assert found["row count", "discounts"] == "FAIL" and found["row count", "orders"] == "OK"


def test_job_leaves_no_scratch(spark, folder, tmp_path):
    from pathlib import Path

    from patronage.session import shared_dir

    assert job.run(spark, "csv", str(folder), str(tmp_path / "out"), "csv")
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("job-*"))


def test_flags_of_a_hot_customer_match_pandas(spark, folder, layout):
    model = ModelTables.read(spark, str(folder), "csv")
    good = delivered(model.orders)
    found = retention.with_flags(customer_timeline(good), snapshot_date(good)).toPandas().set_index("customer_id")
    frame = good.select("customer_id", "order_id", "order_date").toPandas().sort_values(["customer_id", "order_date", "order_id"])
    frame["order_date"] = pd.to_datetime(frame["order_date"])
    last = frame["order_date"].max()
    for customer, rows in frame.groupby("customer_id"):
        days = list(rows["order_date"])
        gap = len(days) > 1 and (days[1] - days[0]).days <= 90
        strict = any(0 < (d - days[0]).days <= 90 for d in days)
        eligible = len(days) > 1 or (last - days[0]).days >= 90
        row = found.loc[customer]
        assert (row.retained_gap, row.retained_strict, row.eligible) == (gap, strict, eligible)
        assert (row.orders, row.first_order_id) == (len(days), rows["order_id"].iloc[0])


def test_repeated_discounts_do_not_inflate_the_month(spark, folder):
    model = ModelTables.read(spark, str(folder), "csv")
    months = job.VIEWS["v_monthly_kpis"](model)
    total = months.agg(F.sum("total_orders"), F.sum("total_gmv")).first()
    plain = delivered(model.orders).agg(F.count(F.lit(1)), F.sum("net_order_value")).first()
    assert tuple(total) == tuple(plain)
