"""90-day retention under its two rules, and what is derived from the flags.

*Gap*: the second order comes at most 90 days after the first; the same day counts.
*Strict*: some order falls in (first, first + 90]; the same day does not count.

Gap contains strict. They differ for a customer whose second order is on the first day and
who has no later order within 90 days.

A customer is *eligible* if there is any second order, or the snapshot is at least 90 days
after the first. This is not symmetric: a recent customer who came back is kept, a recent one
who did not is dropped, so the rate is biased upwards. Eligibility stays a column of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.functions import bands, numeric
from patronage.operators.facts import customer_timeline, delivered, snapshot_date, with_delivery
from patronage.operators.independence import chi_square
from patronage.operators.relational import reindexed

WINDOW_DAYS = 90


def gap_rule(first: Column, second: Column, days: int = WINDOW_DAYS) -> Column:
    return F.coalesce(F.datediff(second, first) <= days, F.lit(False))


def strict_rule(first: Column, second_day: Column, days: int = WINDOW_DAYS) -> Column:
    """The second distinct day decides: no other day after the first is earlier."""
    return F.coalesce(second_day <= F.date_add(first, days), F.lit(False))


def is_eligible(orders: Column, first: Column, snapshot: Column, days: int = WINDOW_DAYS) -> Column:
    return (orders >= 2) | (F.datediff(snapshot, first) >= days)


def with_flags(timeline: DataFrame, snapshot: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """Adds ``retained_gap``, ``retained_strict`` and ``eligible`` to a customer timeline."""
    first = F.col("first_date")
    return (
        timeline.withColumn("retained_gap", gap_rule(first, F.col("second_date"), days))
        .withColumn("retained_strict", strict_rule(first, F.col("second_day"), days))
        .withColumn("eligible", is_eligible(F.col("orders"), first, snapshot, days))
    )


def retention_flags_strict(orders: DataFrame, snapshot: Column | None = None, days: int = WINDOW_DAYS) -> DataFrame:
    """Per customer: uncensored flag, eligibility, and the flag with NULL where the outcome is open."""
    good = delivered(orders)
    at = snapshot if snapshot is not None else snapshot_date(good)
    flagged = with_flags(customer_timeline(good.select("customer_id", "order_date")), at, days)
    return flagged.select(
        "customer_id",
        F.col("retained_strict").alias("retained_raw"),
        "eligible",
        F.when(F.col("eligible"), F.col("retained_strict")).alias("retained"),
    )


def retention_summary(flags: DataFrame) -> DataFrame:
    """Overall retention and churn percentage and the number retained, over eligible customers."""
    known = F.count("retained")
    kept = numeric.count_if(F.col("retained"))
    return flags.agg(
        kept.alias("retained_customers"),
        known.alias("eligible_customers"),
        numeric.pct(kept, known).alias("retention_pct"),
        (F.lit(100.0) - numeric.pct(kept, known)).alias("churn_pct"),
    )


def delay_retention_gap(facts: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Retention (gap rule) per bucket of the first order's delay, over orders that have an event.

    The snapshot is the last date of that same population. It is not known before the
    population is built, so customers are counted per bucket, first date and outcome, and the
    eligibility rule is applied to these counts. They are bounded by calendar days, so one pass
    over orders and events is enough.
    """
    population = with_delivery(delivered(facts)).select("customer_id", "order_id", "order_date", "delivery_delay_min")
    timeline = customer_timeline(population)
    counted = (
        timeline.select(
            bands.delay_bucket(F.col("first_delay")).alias("delay_bucket"),
            bands.delay_bucket_order(F.col("first_delay")).alias("bucket_order"),
            "first_date",
            "last_date",
            (F.col("orders") >= 2).alias("returned"),
            gap_rule(F.col("first_date"), F.col("second_date"), days).alias("retained"),
        )
        .groupBy("delay_bucket", "bucket_order", "first_date", "returned", "retained")
        .agg(F.count(F.lit(1)).alias("customers"), F.max("last_date").alias("last_date"))
    )
    # bounded: at most calendar days x buckets x outcomes rows
    dated = counted.withColumn("snapshot", F.max("last_date").over(W.partitionBy()))
    known = dated.filter(F.col("returned") | (F.datediff("snapshot", "first_date") >= days))
    kept = F.sum(F.when(F.col("retained"), F.col("customers")).otherwise(F.lit(0)))
    return (
        known.groupBy("delay_bucket", "bucket_order")
        .agg(F.sum("customers").alias("customer_count"), kept.alias("retained_count"))
        .withColumn("retention_pct", numeric.rounded_pct(F.col("retained_count"), F.col("customer_count")))
        .orderBy("bucket_order")
    )


def delay_outcomes_strict(facts: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Counts per delay bucket and outcome (strict rule) over all customers with a known outcome.

    A customer whose first order has no event has no bucket and is left out.
    """
    good = delivered(facts)
    timeline = customer_timeline(good.select("customer_id", "order_id", "order_date", "delivery_delay_min"))
    # the snapshot subquery reads one date column of the orders and joins nothing
    flagged = with_flags(timeline, snapshot_date(good.select("order_date")), days)
    return (
        flagged.filter(F.col("eligible") & F.col("first_delay").isNotNull())
        .groupBy(
            bands.delay_bucket(F.col("first_delay")).alias("delay_bucket"),
            bands.delay_bucket_order(F.col("first_delay")).alias("bucket_order"),
            F.col("retained_strict").alias("retained"),
        )
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def delay_retention_strict(outcomes: DataFrame) -> DataFrame:
    """Customers and retention per delay bucket; every bucket is listed, also an empty one."""
    per_bucket = outcomes.groupBy("delay_bucket").agg(
        F.sum("customers").alias("customer_count"),
        F.sum(F.when(F.col("retained"), F.col("customers")).otherwise(F.lit(0))).alias("retained_count"),
    )
    return reindexed(per_bucket, "delay_bucket", bands.DELAY_LABELS, "bucket_order").select(
        "delay_bucket",
        "bucket_order",
        "customer_count",
        numeric.pct(F.col("retained_count"), F.col("customer_count")).alias("retention_pct"),
    )


def delay_significance(outcomes: DataFrame) -> DataFrame:
    """Does retention depend on the delay bucket? Chi-square over the counts."""
    return chi_square(outcomes, "delay_bucket", "retained", "customers")


def delay_overall_average(by_bucket: DataFrame) -> DataFrame:
    """Retention over all buckets, weighted by customers."""
    return by_bucket.agg(numeric.pct(F.sum("retained_count"), F.sum("customer_count")).alias("retention_pct"))
