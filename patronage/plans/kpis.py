"""Monthly and overall KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import calendar, numeric
from patronage.operators.facts import customer_totals, delivered, with_delivery

ON_TIME_LIMIT = 20


def new_customers_by_month(customers: DataFrame) -> DataFrame:
    return customers.groupBy(F.col("cohort_month").alias("order_month")).agg(F.count(F.lit(1)).alias("new_customers"))


def monthly_kpis(customers: DataFrame, facts: DataFrame, on_time_limit: int = ON_TIME_LIMIT) -> DataFrame:
    """One row per month with a delivered order: acquisition, volume, GMV, discounting, delivery.

    ``facts`` has one row per order, so a count of discounted orders is a plain sum and the three
    groupings of orders, discounts and events are one. "On time" is a delay below the limit, over
    orders that have an event.
    """
    delay = F.col("delivery_delay_min")
    per_month = (
        delivered(facts)
        .groupBy(calendar.month_start(F.col("order_date")).alias("_month"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("net_order_value").alias("total_gmv"),
            numeric.count_if(F.col("is_discounted")).alias("_discounted"),
            F.sum(delay).alias("_delay"),
            F.count(delay).alias("_events"),
            numeric.count_if(delay < on_time_limit).alias("_on_time"),
        )
        .withColumn("order_month", calendar.month_key(F.col("_month")))
    )
    return (
        per_month.join(new_customers_by_month(customers), "order_month", "left")
        .select(
            "order_month",
            F.coalesce("new_customers", F.lit(0).cast("bigint")).alias("new_customers"),
            "total_orders",
            "total_gmv",
            numeric.rounded_ratio(F.col("total_gmv"), F.col("total_orders"), 2).alias("avg_order_value"),
            numeric.rounded_pct(F.col("_discounted"), F.col("total_orders")).alias("discount_rate_pct"),
            numeric.rounded_ratio(F.col("_delay"), F.col("_events"), 2).alias("avg_delivery_delay"),
            numeric.rounded_pct(F.col("_on_time"), F.col("_events")).alias("on_time_delivery_pct"),
        )
        .orderBy("order_month")
    )


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return customer_totals(delivered(orders).select("customer_id"))


def one_time_share(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with exactly one delivered order, of those with one and of all."""
    everyone = customers.agg(F.count(F.lit(1))).scalar()
    return (
        orders_per_customer(orders)
        .agg(
            numeric.count_if(F.col("orders") == 1).alias("one_time_customers"),
            F.count(F.lit(1)).alias("ordering_customers"),
        )
        .select(
            "one_time_customers",
            "ordering_customers",
            numeric.pct(F.col("one_time_customers"), F.col("ordering_customers")).alias("one_time_pct_orderers"),
            numeric.pct(F.col("one_time_customers"), everyone).alias("one_time_pct_all"),
        )
    )


def no_delivered_order(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers without a delivered order; they may have cancelled or refunded ones."""
    buyers = delivered(orders).select("customer_id").distinct()
    everyone = customers.agg(F.count(F.lit(1))).scalar()
    return (
        customers.join(buyers, "customer_id", "left_anti")
        .agg(F.count(F.lit(1)).alias("customers"))
        .select("customers", numeric.pct(F.col("customers"), everyone).alias("pct_of_all"))
    )


def never_ordered(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers without an order of any status."""
    anyone = orders.select("customer_id").distinct()
    return customers.join(anyone, "customer_id", "left_anti")


def avg_delivery_delay(facts: DataFrame) -> DataFrame:
    """Mean over delivered orders that have an event, not over customers."""
    known = with_delivery(delivered(facts))
    return known.agg(
        numeric.ratio(F.sum("delivery_delay_min"), F.count("delivery_delay_min")).alias("avg_delivery_delay")
    )


def discount_rate(facts: DataFrame) -> DataFrame:
    return delivered(facts).agg(
        numeric.pct(numeric.count_if(F.col("is_discounted")), F.count(F.lit(1))).alias("discount_rate_pct")
    )


def customer_funnel(customers: DataFrame, flags: DataFrame) -> DataFrame:
    """Signed up, first delivered order, back within 90 days. ``flags`` has one row per orderer."""
    signed = customers.agg(F.count(F.lit(1)).alias("customers")).select(
        F.lit(1).alias("step"), F.lit("Signed Up").alias("stage"), "customers"
    )
    later = flags.agg(F.count(F.lit(1)).alias("first"), numeric.count_if(F.col("retained")).alias("back")).select(
        F.explode(
            F.array(
                F.struct(F.lit(2).alias("step"), F.lit("1st Order").alias("stage"), F.col("first").alias("customers")),
                F.struct(F.lit(3).alias("step"), F.lit("Repeat (90d)").alias("stage"), F.col("back").alias("customers")),
            )
        ).alias("row")
    )
    return signed.unionByName(later.select("row.*")).orderBy("step")
