"""Distributed rank, quartile, running sum and quantiles against a plain single-task window."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.operators.ranking import exact_quantile, global_rank, ntile, ordered, rank_within, value_histogram
from patronage.plans import cohorts, revenue, segments
from patronage.sources.binding import BoundTables


def heavy_ties(spark, rows):
    """65 % of the rows share one value, as order counts of one-time buyers do."""
    value = F.when(F.col("id") % 20 < 13, F.lit(1)).otherwise(F.col("id") % 11)
    return spark.range(rows).select(F.col("id"), value.cast("decimal(12,2)").alias("v")).repartition(5)


@pytest.mark.parametrize("rows", [0, 3, 20_000])
def test_rank_and_running_sum(spark, layout, rows):
    df = heavy_ties(spark, rows)
    keys = [F.col("v").desc(), F.col("id").asc()]
    plain = W.orderBy(*keys)
    expected = df.select("id", F.row_number().over(plain).alias("r"), F.sum("v").over(plain).alias("s")).collect()
    placed = ordered(df, keys)
    assert {(r.id, r["rank"]) for r in placed.ranked().collect()} == {(e.id, e.r) for e in expected}
    got = placed.running(into="r", s=F.col("v")).collect()
    total = sum((row.v for row in df.collect()), Decimal(0))
    assert {(r.id, r.r, r.s) for r in got} == {(e.id, e.r, e.s) for e in expected}
    assert all(r.rows_total == rows and r.s_total == total for r in got)


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 7, 402, 403])
def test_ntile(spark, rows):
    df = spark.range(1, rows + 1)
    got = df.select("id", ntile(F.col("id"), F.lit(rows).cast("bigint"), 4).alias("t"))
    expected = df.select("id", F.ntile(4).over(W.orderBy("id")).alias("t"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_rank_within_a_group_that_holds_a_third(spark, layout):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("g"),
        (F.col("id") * 7919 % 1000).alias("k"),
        "id",
    )
    keys = [F.col("k").asc(), F.col("id").asc()]
    expected = df.select("id", F.row_number().over(W.partitionBy("g").orderBy(*keys)).alias("rn")).collect()
    got = rank_within(df, "g", keys).select("id", "rn").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_large_group_is_cut_over_ranges(spark, setting):
    setting("spark.sql.shuffle.partitions", "8")
    setting("spark.sql.adaptive.enabled", "false")
    df = spark.range(40_000).select(F.lit(1).alias("g"), "id")
    sizes = [r["count"] for r in ordered(df, [F.col("g"), F.col("id")]).rows.groupBy("_slot").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 10_000


def test_quantiles(spark, layout):
    rng = np.random.default_rng(5)
    data = {"a": np.round(rng.gamma(2, 50, 777), 2), "b": np.round(rng.normal(5, 1, 40), 2), "c": np.array([3.5])}
    rows = [(name, Decimal(str(round(float(v), 2)))) for name, values in data.items() for v in values]
    long = spark.createDataFrame(rows, "metric string, value decimal(18,2)")
    found = value_histogram(long, "metric", "value").groupBy("metric").agg(
        *[exact_quantile("value", p).alias(f"q{int(p * 100)}") for p in (0.0, 0.25, 0.5, 0.75, 1.0)]
    )
    for row in found.collect():
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert row[f"q{int(p * 100)}"] == pytest.approx(np.percentile(data[row.metric], 100 * p))


def test_scores_do_not_depend_on_the_layout(spark, setting):
    b = BoundTables(spark, "/root/testdata/sf0.01")
    seen = set()
    for partitions, adaptive in (("1", "false"), ("5", "true"), ("16", "false")):
        setting("spark.sql.shuffle.partitions", partitions)
        setting("spark.sql.adaptive.enabled", adaptive)
        rows = segments.rfm_scores(b.orders).collect()
        seen.add(tuple(sorted(map(tuple, rows))))
    assert len(seen) == 1
    sizes = [sum(1 for r in rows if r.m_score == k) for k in (1, 2, 3, 4)]
    assert max(sizes) - min(sizes) <= 1


def test_pareto_ends_at_one_hundred(spark):
    b = BoundTables(spark, "/root/testdata/sf0.01")
    last = revenue.pareto_detail(revenue.by_spend(b.orders)).orderBy(F.desc("rnk")).first()
    assert (last.cumulative_customer_pct, last.cumulative_gmv_pct) == (100.0, 100.0)
    assert revenue.monthly_gmv(b.orders).agg(F.sum("gmv")).first()[0] == last.cumulative_gmv


def test_crossing_with_negative_spend(spark, layout):
    rows = [(1, "60.00"), (2, "40.00"), (3, "10.00"), (4, "-5.00"), (5, "-5.00")]
    df = spark.createDataFrame([(i, Decimal(v)) for i, v in rows], "customer_id long, net_spend decimal(12,2)")
    placed = ordered(df, [F.col("net_spend").desc(), F.col("customer_id").asc()])
    found = {r.target: r.rnk for r in revenue.crossings(placed, (50, 60, 100)).collect()}
    assert found == {50: 1, 60: 1, 100: 2}


def test_cohort_offset_zero_is_everyone(spark):
    b = BoundTables(spark, "/root/testdata/sf0.01")
    first = cohorts.cohort_retention(b.orders, b.customers).filter("months_since_first = 0")
    assert {r.retention_pct for r in first.collect()} == {100.0}


def test_global_rank_is_dense_and_complete(spark):
    got = [r["rank"] for r in global_rank(heavy_ties(spark, 1000), [F.col("v"), F.col("id")]).collect()]
    assert sorted(got) == list(range(1, 1001))


def test_a_null_group_over_several_ranges_is_numbered_through(spark, layout):
    df = spark.range(900).selectExpr("id", "CASE WHEN id % 9 = 0 THEN 1 WHEN id % 9 = 1 THEN 2 END AS g")
    found = rank_within(df, "g", [F.col("id")]).collect()
    for group in (None, 1, 2):
        rows = sorted((r.id, r.rn) for r in found if r.g == group)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))
