"""Order facts and the customer grain.

One customer may hold a large part of all orders. No operator here brings that customer's
orders to one task: the orders are first reduced to one row per customer and day (each map
task combines its own rows), and only then to the customer. A customer has at most as many
day rows as the calendar has days, whatever the number of orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DELIVERED = "Delivered"


def delivered(orders: DataFrame, status: str = DELIVERED) -> DataFrame:
    """The filter every customer metric starts from."""
    return orders.filter(F.col("order_status") == status)


def with_delivery(facts: DataFrame) -> DataFrame:
    """Facts that have a delivery event (the delay is never NULL in an event)."""
    return facts.filter(F.col("delivery_delay_min").isNotNull())


def order_facts(orders: DataFrame, delivery: DataFrame, discounts: DataFrame) -> DataFrame:
    """Orders with the delay of their event and a flag for a discount; one row per order.

    ``discounts`` may hold several rows per order, so it is reduced to its order ids first.
    All three sides are keyed by order id, so the joins share one partitioning.
    """
    events = delivery.select("order_id", "delivery_delay_min")
    discounted = discounts.select("order_id").distinct().withColumn("is_discounted", F.lit(True))
    return (
        orders.join(events, "order_id", "left")
        .join(discounted, "order_id", "left")
        .withColumn("is_discounted", F.coalesce("is_discounted", F.lit(False)))
    )


def snapshot_date(orders: DataFrame) -> Column:
    """The latest order date as a scalar subquery; filter ``orders`` first to narrow the scope."""
    return orders.agg(F.max("order_date")).scalar()


def customer_totals(facts: DataFrame) -> DataFrame:
    """Sums and date bounds per customer, in one shuffle of already combined rows.

    Which columns are computed follows from the columns of ``facts``; unused ones are pruned.
    """
    present = set(facts.columns)
    measures = [F.count(F.lit(1)).alias("orders")]
    if "order_date" in present:
        measures += [F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date")]
    if "net_order_value" in present:
        measures += [F.sum("net_order_value").alias("spend")]
    if "is_discounted" in present:
        measures += [F.sum(F.col("is_discounted").cast("int")).alias("discounted")]
    if "delivery_delay_min" in present:
        measures += [
            F.sum("delivery_delay_min").alias("delay_sum"),
            F.count("delivery_delay_min").alias("delay_orders"),
        ]
    return facts.groupBy("customer_id").agg(*measures)


def customer_days(facts: DataFrame) -> DataFrame:
    """One row per customer and day. The first order of a day is the one with the lowest id."""
    present = set(facts.columns)
    measures = [F.count(F.lit(1)).alias("orders")]
    if "net_order_value" in present:
        measures += [F.sum("net_order_value").alias("spend")]
    if "is_discounted" in present:
        measures += [F.sum(F.col("is_discounted").cast("int")).alias("discounted")]
    if "delivery_delay_min" in present:
        measures += [
            F.sum("delivery_delay_min").alias("delay_sum"),
            F.count("delivery_delay_min").alias("delay_orders"),
        ]
    if "order_id" in present:
        measures += [F.min("order_id").alias("first_order_id")]
        if "delivery_delay_min" in present:
            measures += [F.min_by("delivery_delay_min", "order_id").alias("first_delay")]
    return facts.groupBy("customer_id", "order_date").agg(*measures)


def customer_timeline(facts: DataFrame) -> DataFrame:
    """One row per customer: totals, first order, and the date of the second order.

    ``second_day`` is the second distinct order date; ``second_date`` the date of the second
    order, which is the first date again if that day has two orders.
    """
    days = customer_days(facts)
    ahead = days.withColumn("next_day", F.lead("order_date").over(W.partitionBy("customer_id").orderBy("order_date")))
    measures = [
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.min("next_day").alias("second_day"),
        F.sum("orders").alias("orders"),
        F.min_by("orders", "order_date").alias("first_day_orders"),
    ]
    for name in ("spend", "discounted", "delay_sum", "delay_orders"):
        if name in days.columns:
            measures.append(F.sum(name).alias(name))
    for name in ("first_order_id", "first_delay"):
        if name in days.columns:
            measures.append(F.min_by(name, "order_date").alias(name))
    return (
        ahead.groupBy("customer_id")
        .agg(*measures)
        .withColumn(
            "second_date", F.when(F.col("first_day_orders") > 1, F.col("first_date")).otherwise(F.col("second_day"))
        )
    )
