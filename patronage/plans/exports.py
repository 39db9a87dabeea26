"""Per-customer tables for other tools, and the KPIs recomputed from them.

The exported flag is not censored; whoever reads it applies the eligibility rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import bands, numeric
from patronage.operators.facts import customer_timeline, delivered, with_delivery
from patronage.plans.retention import WINDOW_DAYS, is_eligible, strict_rule


def customer_facts(facts: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Customers with a delivered order that has an event: nine columns, strict flag, first order."""
    columns = ("customer_id", "order_id", "order_date", "net_order_value", "delivery_delay_min")
    timeline = customer_timeline(with_delivery(delivered(facts)).select(*columns))
    return timeline.select(
        "customer_id",
        F.col("first_date").alias("FirstOrderDate"),
        F.col("last_date").alias("LastOrderDate"),
        F.col("orders").alias("OrderCount"),
        F.col("spend").alias("TotalLTV"),
        strict_rule(F.col("first_date"), F.col("second_day"), days).alias("Retained90d"),
        F.col("first_order_id").alias("FirstOrderID"),
        F.col("first_delay").alias("FirstOrderDelay"),
        bands.delay_bucket(F.col("first_delay")).alias("DelayBucket"),
    )


def customer_facts_all(customers: DataFrame, orders: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """All customers: zeros and no first date where there is no delivered order."""
    timeline = customer_timeline(delivered(orders).select("customer_id", "order_date", "net_order_value"))
    return customers.join(timeline, "customer_id", "left").select(
        "customer_id",
        "city",
        "acquisition_channel",
        F.coalesce("orders", F.lit(0).cast("bigint")).alias("order_count"),
        F.coalesce("spend", F.lit(0).cast("decimal(12,2)")).alias("net_gmv"),
        F.col("first_date").alias("first_order_date"),
        strict_rule(F.col("first_date"), F.col("second_day"), days).alias("retained_90d_raw"),
    )


def dimension_filter(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Equality filters per column; ``None`` or "all" leaves the column free."""
    for column, value in wanted.items():
        if value is not None and value != "all":
            df = df.filter(F.col(column) == value)
    return df


def filtered_kpis(
    all_customers: DataFrame, snapshot: Column, city: str | None = None, channel: str | None = None
) -> DataFrame:
    """One row: retention of the chosen customers; GMV and orderers of the whole platform.

    One pass: the filter only decides which customers count towards retention.
    """
    chosen = F.lit(True)
    for column, value in (("city", city), ("acquisition_channel", channel)):
        if value is not None and value != "all":
            chosen = chosen & F.coalesce(F.col(column) == value, F.lit(False))
    buyer = F.col("order_count") > 0
    known = buyer & chosen & is_eligible(F.col("order_count"), F.col("first_order_date"), snapshot)
    return all_customers.agg(
        numeric.count_if(buyer).alias("ordering_customers"),
        F.sum(F.when(buyer, F.col("net_gmv"))).alias("total_gmv"),
        numeric.count_if(chosen).alias("filtered_customers"),
        numeric.count_if(known).alias("eligible_customers"),
        numeric.count_if(known & F.col("retained_90d_raw")).alias("retained_customers"),
    ).withColumn("retention_pct", numeric.pct(F.col("retained_customers"), F.col("eligible_customers")))
