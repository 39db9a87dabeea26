"""Cohort retention.

The cohort is the signup month; the offset counts from the month of the first delivered order.
A cell beyond the last cohort month is NULL (not observable yet); an observed zero is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.functions import bands, calendar, numeric
from patronage.operators.facts import delivered

OFFSETS = (0, 1, 2, 3, 6, 9, 12)


def active_months(orders: DataFrame) -> DataFrame:
    """(customer, offset): the months with a delivered order, counted from the first such month.

    The distinct runs on (customer, month), so a customer with very many orders is combined
    before the shuffle and spread over it; the window then sees at most one row per month.
    """
    months = (
        delivered(orders).select("customer_id", calendar.month_index(F.col("order_date")).alias("month")).distinct()
    )
    first = F.min("month").over(W.partitionBy("customer_id"))
    return months.select("customer_id", (F.col("month") - first).alias("offset"))


def cohort_counts(orders: DataFrame, customers: DataFrame, offsets: Sequence[int] = OFFSETS) -> DataFrame:
    """One row per cohort: its size, its month index and the active customers per offset.

    Every ordering customer is active at offset 0, so the count there is the cohort size and no
    customer x offset grid is built.
    """
    wanted = sorted({0, *offsets})
    active = active_months(orders).filter(F.col("offset").isin(wanted))
    placed = active.join(customers.select("customer_id", "cohort_month"), "customer_id")
    return placed.groupBy("cohort_month").agg(
        *[numeric.count_if(F.col("offset") == k).alias(f"active_{k}") for k in wanted]
    )


def cohort_retention_indexed(orders: DataFrame, customers: DataFrame, offsets: Sequence[int] = OFFSETS) -> DataFrame:
    """Cohort x offset rows with count, percentage, and the index against peers of the same offset."""
    counts = cohort_counts(orders, customers, offsets)
    cells = counts.select(
        "cohort_month",
        F.col("active_0").alias("cohort_size"),
        calendar.month_key_index(F.col("cohort_month")).alias("_index"),
        # bounded: one row per calendar month
        F.max(calendar.month_key_index(F.col("cohort_month"))).over(W.partitionBy()).alias("_horizon"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("months_since_first"), F.col(f"active_{k}").alias("active"))
                    for k in offsets
                ]
            )
        ).alias("cell"),
    ).select("*", "cell.*")

    def observed(value):
        return bands.within_horizon(F.col("_index"), F.col("months_since_first"), F.col("_horizon"), value)

    hundredths = F.round(numeric.rounded_pct(F.col("active"), F.col("cohort_size")) * 100, 0).cast("bigint")
    masked = cells.select(
        "cohort_month",
        "months_since_first",
        "cohort_size",
        observed(F.col("active")).alias("customer_count"),
        observed(hundredths).alias("_hundredths"),
    )
    peers = W.partitionBy("months_since_first")
    index = numeric.rounded_ratio(
        F.col("_hundredths") * F.count("_hundredths").over(peers), F.sum("_hundredths").over(peers), digits=3
    )
    return masked.select(
        "cohort_month",
        "months_since_first",
        "cohort_size",
        "customer_count",
        (F.col("_hundredths") / F.lit(100.0)).alias("retention_pct"),
        index.alias("retention_index"),
    ).orderBy("cohort_month", "months_since_first")


def cohort_retention(orders: DataFrame, customers: DataFrame, offsets: Sequence[int] = OFFSETS) -> DataFrame:
    return cohort_retention_indexed(orders, customers, offsets).select(
        "cohort_month", "months_since_first", "customer_count", "retention_pct"
    )


def cohort_matrix(retention: DataFrame, offsets: Sequence[int] = OFFSETS) -> DataFrame:
    """One row per cohort, one column per offset; masked cells are NULL."""
    wide = retention.groupBy("cohort_month").pivot("months_since_first", list(offsets)).agg(F.first("retention_pct"))
    return wide.select("cohort_month", *[F.col(f"`{k}`").alias(f"month_{k}") for k in offsets]).orderBy("cohort_month")


def month1_average(orders: DataFrame, customers: DataFrame, mask: bool = False) -> DataFrame:
    """Mean over cohorts of the share active one month after the first order.

    Without ``mask`` a cohort beyond the horizon counts as 0, as in the published figure.
    """
    counts = cohort_counts(orders, customers, (0, 1)).withColumn(
        "_index", calendar.month_key_index(F.col("cohort_month"))
    )
    if mask:
        counts = counts.withColumn("_horizon", F.max("_index").over(W.partitionBy())).filter(
            F.col("_index") + 1 <= F.col("_horizon")
        )
    return counts.agg(F.avg(numeric.pct(F.col("active_1"), F.col("active_0"))).alias("month1_avg_pct"))
