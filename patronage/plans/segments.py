"""Recency, frequency and spend: scores, segments, the wide customer table, discount bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.functions import bands, numeric
from patronage.operators.facts import customer_timeline, customer_totals, delivered, snapshot_date
from patronage.operators.ranking import tiles_by_selection
from patronage.operators.relational import reindexed
from patronage.plans.retention import WINDOW_DAYS, with_flags


def customer_rfm(orders: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """Recency in days, number of orders and spend per customer with a delivered order.

    The default snapshot is the latest date of all orders, whatever their status.
    """
    at = snapshot if snapshot is not None else snapshot_date(orders)
    totals = customer_totals(delivered(orders).select("customer_id", "order_date", "net_order_value"))
    return totals.select(
        "customer_id",
        F.datediff(at, F.col("last_date")).alias("recency_days"),
        F.col("orders").alias("frequency"),
        F.col("spend").alias("monetary"),
    )


def rfm_scores(orders: DataFrame, snapshot: Column | None = None, tiles: int = 4) -> DataFrame:
    """Quartile scores, their total, the segment and the spend per customer.

    The three orders need no sort of the customers: the last customer of each quartile is selected from
    counts of ranges, and every score is a comparison with three customers.
    """
    orders_by = {
        "r_score": [F.col("recency_days").desc(), F.col("customer_id").asc()],
        "f_score": [F.col("frequency").asc(), F.col("customer_id").asc()],
        "m_score": [F.col("monetary").asc(), F.col("customer_id").asc()],
    }
    scored = tiles_by_selection(customer_rfm(orders, snapshot), orders_by, tiles)
    return scored.select(
        "customer_id",
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        bands.segment(F.col("recency_days"), F.col("frequency")).alias("segment"),
        F.col("monetary").alias("total_spend"),
    )


def customer_segment(orders: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """Customer, frequency, spend and segment; the default snapshot is the last delivered order."""
    good = delivered(orders)
    rfm = customer_rfm(orders, snapshot if snapshot is not None else snapshot_date(good))
    return rfm.select(
        "customer_id", "frequency", "monetary", bands.segment(F.col("recency_days"), F.col("frequency")).alias("segment")
    )


def rfm_summary(segments: DataFrame) -> DataFrame:
    """Five rows, one per segment: customers, GMV and both shares; an empty segment is NULL."""
    per_segment = segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("gmv"), F.sum("frequency").alias("_orders")
    )
    every = W.partitionBy()  # over at most five rows
    shares = per_segment.select(
        "segment",
        "customers",
        "gmv",
        numeric.pct(F.col("customers"), F.sum("customers").over(every)).alias("pct_customers"),
        numeric.pct(F.col("gmv"), F.sum("gmv").over(every)).alias("pct_gmv"),
        numeric.ratio(F.col("_orders"), F.col("customers")).alias("avg_frequency"),
    )
    return reindexed(shares, "segment", bands.SEGMENTS)


def segment_avg_frequency(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(
        numeric.ratio(F.sum("frequency"), F.count(F.lit(1))).alias("avg_frequency")
    )


def customer_segments(customers: DataFrame, facts: DataFrame, orders: DataFrame) -> DataFrame:
    """The wide customer table, 16 columns, over customers with a delivered order that has an event.

    Orders, delays and discounts are reduced to the customer in one grouping of the order facts.
    ``orders`` only gives the snapshot (all statuses).
    """
    totals = customer_totals(delivered(facts)).filter(F.col("delay_orders") > 0)
    since_last = F.datediff(snapshot_date(orders), F.col("last_date"))
    share = numeric.pct(F.col("discounted"), F.col("orders"))
    return (
        customers.join(totals, "customer_id")
        .withColumn("_since", since_last)
        .withColumn("_share", share)
        .select(
            "customer_id",
            "city",
            "acquisition_channel",
            "cohort_month",
            "signup_date",
            F.col("orders").alias("total_orders"),
            F.col("spend").alias("total_spend"),
            numeric.ratio(F.col("spend"), F.col("orders")).alias("avg_order_value"),
            F.col("first_date").alias("first_order_date"),
            F.col("last_date").alias("last_order_date"),
            F.col("_since").alias("days_since_last_order"),
            numeric.ratio(F.col("delay_sum"), F.col("delay_orders")).alias("avg_delivery_delay"),
            numeric.rounded_pct(F.col("discounted"), F.col("orders")).alias("discount_pct_of_orders"),
            bands.discount_band(F.col("_share")).alias("discount_group"),
            bands.segment(F.col("_since"), F.col("orders")).alias("rfm_segment"),
            bands.churned(F.col("_since")).alias("is_churned"),
        )
    )


def discount_ltv(facts: DataFrame, snapshot: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """Four discount bands over all eligible customers (gap rule): means per band.

    The delay is a mean of customer means. Customers without any event are left out.
    """
    timeline = customer_timeline(delivered(facts)).filter(F.col("delay_orders") > 0)
    known = with_flags(timeline, snapshot, days).filter("eligible")
    share = numeric.pct(F.col("discounted"), F.col("orders"))
    # a fixed-point customer mean makes the sum independent of the order of addition
    own_delay = numeric.ratio(F.col("delay_sum"), F.col("delay_orders")).cast("decimal(24,12)")
    grouped = known.groupBy(
        bands.discount_band(share).alias("discount_group"), bands.discount_band_order(share).alias("group_order")
    ).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("orders").alias("_orders"),
        F.sum("spend").alias("_spend"),
        numeric.count_if(F.col("retained_gap")).alias("_kept"),
        F.sum(own_delay).alias("_delay"),
    )
    n = F.col("customer_count")
    return grouped.select(
        "discount_group",
        "group_order",
        "customer_count",
        numeric.rounded_ratio(F.col("_orders"), n, 2).alias("avg_total_orders"),
        numeric.rounded_ratio(F.col("_spend"), n, 2).alias("avg_net_spend"),
        numeric.rounded_pct(F.col("_kept"), n, 2).alias("avg_90day_retention_pct"),
        numeric.rounded_ratio(F.col("_delay"), n, 2).alias("avg_delivery_delay"),
    ).orderBy("group_order")


def discount_ltv_repeat(facts: DataFrame, snapshot: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """Three discount bands over customers with at least two delivered orders (strict rule)."""
    columns = ("customer_id", "order_date", "net_order_value", "is_discounted")
    repeat = customer_timeline(delivered(facts).select(*columns)).filter(F.col("orders") >= 2)
    flagged = with_flags(repeat, snapshot, days)
    share = numeric.pct(F.col("discounted"), F.col("orders"))
    grouped = flagged.groupBy(
        bands.repeat_discount_band(share).alias("discount_group"),
        bands.repeat_discount_band_order(share).alias("group_order"),
    ).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("spend").alias("_spend"),
        numeric.count_if(F.col("retained_strict") & F.col("eligible")).alias("_kept"),
        numeric.count_if(F.col("eligible")).alias("_known"),
    )
    return grouped.select(
        "discount_group",
        "group_order",
        "customers",
        numeric.ratio(F.col("_spend"), F.col("customers")).alias("avg_ltv"),
        numeric.pct(F.col("_kept"), F.col("_known")).alias("retention_pct"),
    ).orderBy("group_order")


def _band_value(band: str, column: str) -> Column:
    return F.max(F.when(F.col("discount_group") == band, F.col(column)))


def heavy_vs_light_gap(by_band: DataFrame) -> DataFrame:
    """Mean lifetime value of Heavy against Light/Moderate, as a percentage difference."""
    heavy, light = _band_value("Heavy", "avg_ltv"), _band_value("Light/Moderate", "avg_ltv")
    return by_band.agg(((heavy / light - 1) * 100).alias("heavy_vs_light_pct"))


def foregone_ltv(by_band: DataFrame) -> DataFrame:
    """Heavy customers times the gap of their mean lifetime value to Light/Moderate."""
    heavy, light = _band_value("Heavy", "avg_ltv"), _band_value("Light/Moderate", "avg_ltv")
    n = _band_value("Heavy", "customers")
    return by_band.agg(
        n.alias("heavy_customers"), (light - heavy).alias("ltv_gap"), (n * (light - heavy)).alias("foregone_ltv")
    )
