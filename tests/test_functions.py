"""Column functions: exact rounding, band edges, money text, the chi-square tail."""

import math
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronage.functions import bands, calendar, numeric
from patronage.operators import relational
from patronage.operators.independence import chi_square, upper_tail
from patronage.plans import enrichment


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=20, max_size=60))
def test_rounding_is_half_away_from_zero(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long").select(
        "n", "d", numeric.rounded_pct(F.col("n"), F.col("d"), 2).alias("r")
    )
    for row in df.collect():
        exact = (Decimal(100 * row.n) / Decimal(row.d)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row.r == float(exact)


def test_rounding_of_money_and_zero(spark):
    df = spark.createDataFrame([(Decimal("1.00"), 8), (Decimal("-1.00"), 8), (Decimal("5.00"), 0)], "s decimal(22,2), n long")
    got = [r[0] for r in df.select(numeric.rounded_ratio(F.col("s"), F.col("n"), 2)).collect()]
    assert got == [0.13, -0.13, None]


@pytest.mark.parametrize(
    "value, label, place",
    [(-5, "0-10 min", 1), (9.9, "0-10 min", 1), (10, "10-20 min", 2), (35, "35-50 min", 4), (50, "50+ min", 5), (None, None, None)],
)
def test_delay_buckets(spark, value, label, place):
    df = spark.createDataFrame([(None if value is None else float(value),)], "x double")
    row = df.select(bands.delay_bucket(F.col("x")).alias("a"), bands.delay_bucket_order(F.col("x")).alias("b")).first()
    assert (row.a, row.b) == (label, place)


@pytest.mark.parametrize(
    "share, four, three",
    [(0.0, "Never", "Never"), (0.1, "Light", "Light/Moderate"), (30.0, "Light", "Light/Moderate"),
     (30.5, "Moderate", "Light/Moderate"), (60.0, "Moderate", "Light/Moderate"), (60.1, "Heavy", "Heavy")],
)
def test_discount_bands(spark, share, four, three):
    df = spark.createDataFrame([(share,)], "x double")
    assert tuple(df.select(bands.discount_band(F.col("x")), bands.repeat_discount_band(F.col("x"))).first()) == (four, three)


@pytest.mark.parametrize(
    "recency, frequency, label",
    [(30, 5, "Champion"), (30, 4, "Loyal"), (31, 5, "Loyal"), (61, 9, "At Risk"), (0, 1, "At Risk"), (90, 1, "At Risk"),
     (91, 9, "About to Lapse"), (180, 1, "About to Lapse"), (181, 9, "Lost")],
)
def test_segments(spark, recency, frequency, label):
    df = spark.createDataFrame([(recency, frequency)], "r int, f long")
    assert df.select(bands.segment(F.col("r"), F.col("f"))).first()[0] == label


def test_money_text(spark):
    values = ["241460000.00", "120.40", "99999.50", "250000.00", "-1234567.00", "999.00", "10000000.00"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "m decimal(22,2)")
    got = [r[0] for r in df.select(numeric.compact_money(F.col("m"))).collect()]
    assert got == ["₹24.15Cr", "₹120", "₹1,00,000", "₹2.50L", "₹-12,34,567", "₹999", "₹1.00Cr"]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 3, 2), 23)], "d date, h int")
    row = df.select(
        calendar.day_name(F.col("d")).alias("name"),
        calendar.is_weekend(F.col("d")).alias("weekend"),
        calendar.month_key_index(calendar.month_key(F.col("d"))).alias("index"),
        calendar.plus_minutes(calendar.at_hour(F.col("d"), F.col("h")), F.lit(75.5)).alias("later"),
    ).first()
    assert tuple(row) == ("Saturday", 1, 2024 * 12 + 3, datetime(2024, 3, 3, 0, 15, 30))


def test_discount_is_capped(spark):
    df = spark.createDataFrame([("Flat", Decimal("90.00")), ("Percentage", Decimal("0.00"))], "k string, flat decimal(18,2)")
    value = enrichment.discount_value(
        F.col("k"), F.col("flat"), F.lit(30).cast("decimal(18,2)"), F.lit(12.5).cast("decimal(5,1)"), F.lit(100).cast("decimal(18,2)")
    )
    assert [float(r[0]) for r in df.select(value).collect()] == [70.0, 12.5]


def _tail(x, k):
    half = x / 2
    if k % 2 == 0:
        return math.exp(-half) * sum(half**i / math.factorial(i) for i in range(k // 2))
    steps = sum(half ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (k - 1) // 2 + 1))
    return math.erfc(math.sqrt(half)) + math.exp(-half) * steps


def test_chi_square_tail(spark):
    points = [(x, k) for k in range(1, 13) for x in (0.001, 0.3, 2.5, 4.9, 12.0, 30.0, 200.0, 900.0)]
    df = spark.createDataFrame(points, "x double, k int").select("x", "k", upper_tail(F.col("x"), F.col("k")).alias("p"))
    for row in df.collect():
        assert row.p == pytest.approx(_tail(row.x, row.k), rel=1e-11)


@pytest.mark.parametrize(
    "cells, statistic, dof",
    [
        ([("a", "u", 30), ("a", "v", 10), ("b", "u", 20), ("b", "v", 40)], 15.041666666666666, 1),  # corrected
        ([("a", "u", 3), ("b", "v", 4), ("c", "w", 5)], 24.0, 4),  # empty cells
        ([("a", "u", 30), ("b", "u", 5)], 0.0, 0),
    ],
)
def test_chi_square(spark, cells, statistic, dof):
    row = chi_square(spark.createDataFrame(cells, "r string, c string, n long"), "r", "c", "n").first()
    assert row.statistic == pytest.approx(statistic) and row.dof == dof
    assert row.p_value == pytest.approx(_tail(statistic, dof) if dof else 1.0)


def exact_tail(x, dof):
    """P(X >= x) of the chi-square distribution, by the finite sum over steps of two degrees, in 60 digits."""
    with localcontext() as context:
        context.prec = 60
        half = Decimal(x) / 2
        if dof % 2:
            root = half.sqrt()
            total = Decimal(math.erfc(float(root)))
            term = 2 * root * (-half).exp() / Decimal("3.14159265358979323846264338327950288419716939937510").sqrt()
            start = Decimal(3) / 2
        else:
            total = term = (-half).exp()
            term = term * half
            start = Decimal(2)
        for k in range((dof - 1) // 2):
            total += term
            term = term * half / (start + k)
        return float(total)


def test_chi_square_tail_at_many_degrees_of_freedom(spark):
    points = [(float(f), k) for k in (*range(1, 12), 50, 99, 300, 344, 429, 1000, 1999, 2000) for f in (k * 0.5, k * 0.97, k, k * 1.03, k * 1.2, k * 1.5 + 3)]
    df = spark.createDataFrame(points, "x double, k int").select("x", "k", upper_tail(F.col("x"), F.col("k")).alias("p"))
    for r in df.collect():
        assert 0 <= r.p <= 1 and r.p == pytest.approx(exact_tail(r.x, r.k), rel=1e-8, abs=1e-13), (r.x, r.k)


def test_chi_square_of_a_large_table(spark):
    cells = [(f"r{i}", f"c{j}", 50 + (i * 7 + j * 3) % 11) for i in range(40) for j in range(12)]
    row = chi_square(spark.createDataFrame(cells, "r string, c string, n long"), "r", "c", "n").first()
    assert row.dof == 39 * 11 and 0 <= row.p_value <= 1 and row.p_value == pytest.approx(exact_tail(row.statistic, row.dof), rel=1e-6)


def test_values_that_are_not_listed_are_counted(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", "z"), ("b", None)], "r string, c string")
    found = {r.r: (r.n_x, r.n_y, r.n_other) for r in relational.contingency(df, "r", "c", ["x", "y"]).collect()}
    assert found == {"a": (1, 0, 1), "b": (0, 0, 2)}
