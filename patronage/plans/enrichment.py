"""Order attributes that follow from other data: gross and net value, calendar, status, timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import bands, calendar

DISCOUNT_CAP = "0.7"


def order_values(items: DataFrame) -> DataFrame:
    """Gross value and number of items per order."""
    return items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("item_price")).cast("decimal(18,2)").alias("gross_order_value"),
        F.count(F.lit(1)).alias("items_count"),
    )


def discount_value(kind: Column, flat: Column, fixed: Column, percent: Column, gross: Column) -> Column:
    """Value of a discount: flat amount, fixed amount of a free delivery, or percent of gross; capped."""
    raw = F.when(kind == "Flat", flat).when(kind == "Free Delivery", fixed).otherwise(F.round(gross * percent / 100, 2))
    return F.least(raw.cast("decimal(18,3)"), (gross * F.lit(DISCOUNT_CAP).cast("decimal(2,1)")).cast("decimal(18,3)"))


def net_value(gross: Column, discount: Column) -> Column:
    return F.round(gross - F.coalesce(discount, F.lit(0)), 2).cast("decimal(18,2)")


def with_net(orders: DataFrame, discounts: DataFrame) -> DataFrame:
    """Net value of each order; several discounts of one order add up."""
    off = discounts.groupBy("order_id").agg(F.sum("discount_value").alias("_off"))
    return (
        orders.join(off, "order_id", "left")
        .withColumn("net_order_value", net_value(F.col("gross_order_value"), F.col("_off")))
        .drop("_off")
    )


def with_calendar(orders: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return (
        orders.withColumn("order_day_of_week", calendar.day_name(day))
        .withColumn("order_month", calendar.month_key(day))
        .withColumn("is_weekend", calendar.is_weekend(day))
    )


def with_cohort(customers: DataFrame) -> DataFrame:
    return customers.withColumn("cohort_month", calendar.month_key(F.col("signup_date")))


def with_delivery_status(events: DataFrame) -> DataFrame:
    return events.withColumn("delivery_status", bands.delivery_status(F.col("delivery_delay_min")))


def with_timeline(orders: DataFrame) -> DataFrame:
    """Dispatch, pickup and delivery moments from date, hour, preparation and dispatch minutes.

    Travel takes what the promise and the delay leave, at least five minutes.
    """
    start = calendar.at_hour(F.col("order_date"), F.col("order_hour"))
    travel = F.greatest(
        F.col("promised_delivery_min") + F.col("delivery_delay_min") - F.col("prep_min") - F.col("dispatch_min"),
        F.lit(5),
    )
    return (
        orders.withColumn("dispatched_time", calendar.plus_minutes(start, F.col("prep_min")))
        .withColumn("pickup_time", calendar.plus_minutes(F.col("dispatched_time"), F.col("dispatch_min")))
        .withColumn("delivered_time", calendar.plus_minutes(F.col("pickup_time"), travel))
    )
