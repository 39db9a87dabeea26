"""Revenue concentration: ranked customers, cumulative shares, milestones, key accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import calendar, numeric
from patronage.operators.facts import delivered
from patronage.operators.ranking import SLOT, Ordered, ordered

TARGETS = (50, 65, 80)


def customer_spend(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.sum("net_order_value").alias("net_spend"))


def by_spend(orders: DataFrame, status_filter: bool = True) -> Ordered:
    """Customers in descending order of spend, then id. Written once, read by every figure below."""
    spend = customer_spend(delivered(orders) if status_filter else orders)
    return ordered(spend, [F.col("net_spend").desc(), F.col("customer_id").asc()])


def cumulative(sorted_customers: Ordered) -> DataFrame:
    """``rnk``, ``cumulative_gmv``, and the totals ``rows_total`` and ``cumulative_gmv_total``."""
    return sorted_customers.running(into="rnk", cumulative_gmv=F.col("net_spend"))


def pareto_detail(sorted_customers: Ordered) -> DataFrame:
    """Per customer: rank, cumulative share of customers, cumulative GMV and its share."""
    return cumulative(sorted_customers).select(
        "rnk",
        "customer_id",
        numeric.rounded_pct(F.col("rnk"), F.col("rows_total"), 3).alias("cumulative_customer_pct"),
        "cumulative_gmv",
        numeric.rounded_pct(F.col("cumulative_gmv"), F.col("cumulative_gmv_total"), 3).alias("cumulative_gmv_pct"),
    )


def crossings(sorted_customers: Ordered, targets: Sequence[float] = TARGETS) -> DataFrame:
    """Per target: the first rank at which the cumulative GMV reaches it, and the GMV there.

    Only the ranges a target falls in are read. Spend is descending, so the highest
    cumulative value inside a range is what lies before it plus the range's positive spend.
    """
    spend = F.col("net_spend")
    positive = F.greatest(spend, F.lit(0).cast("decimal(12,2)"))
    slots = sorted_customers.slots(gmv=spend, peak=positive)
    reached = (F.col("_before_gmv") + F.col("_sum_peak")) * 100
    candidates = slots.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets]))).filter(
        reached >= F.col("_total_gmv") * F.col("target")
    )
    # one row per target
    hit = candidates.groupBy("target").agg(F.min(SLOT).alias(SLOT))
    touched = sorted_customers.restricted(hit).running_in(slots, into="rnk", gmv=spend)
    return (
        touched.join(F.broadcast(hit), SLOT)
        .filter(F.col("gmv") * 100 >= F.col("gmv_total") * F.col("target"))
        .groupBy("target")
        .agg(
            F.min("rnk").alias("rnk"),
            F.min_by("gmv", "rnk").alias("cumulative_gmv"),
            F.max("rows_total").alias("customers"),
            F.max("gmv_total").alias("total_gmv"),
        )
    )


def pareto_milestones(sorted_customers: Ordered, targets: Sequence[int] = TARGETS) -> DataFrame:
    """The share of customers that brings each target share of GMV, with its label."""
    found = crossings(sorted_customers, targets)
    share = numeric.rounded_pct(F.col("rnk"), F.col("customers"), 2).cast("decimal(10,2)").cast("string")
    label = F.concat(
        F.lit("Top "), share, F.lit("% of customers drive "), F.col("target").cast("string"), F.lit("% of GMV")
    )
    return found.select(
        label.alias("milestone_label"),
        numeric.rounded_pct(F.col("rnk"), F.col("customers"), 3).alias("cumulative_customer_pct"),
        F.col("target").cast("double").alias("cumulative_gmv_pct"),
    )


def revenue_pareto(sorted_customers: Ordered, targets: Sequence[int] = TARGETS) -> DataFrame:
    """Milestones first, then every customer by rank; columns a row type lacks are typed NULLs."""
    detail = pareto_detail(sorted_customers).select(
        F.lit("detail").alias("row_type"), F.lit(None).cast("string").alias("milestone_label"), "*"
    )
    milestones = pareto_milestones(sorted_customers, targets).select(
        F.lit("milestone").alias("row_type"),
        "milestone_label",
        F.lit(None).cast("bigint").alias("rnk"),
        F.lit(None).cast(detail.schema["customer_id"].dataType).alias("customer_id"),
        "cumulative_customer_pct",
        F.lit(None).cast(detail.schema["cumulative_gmv"].dataType).alias("cumulative_gmv"),
        "cumulative_gmv_pct",
    )
    return detail.unionByName(milestones).orderBy(F.desc("row_type"), "rnk", "cumulative_gmv_pct")


def concentration(sorted_customers: Ordered, targets: Sequence[int] = (50, 80)) -> DataFrame:
    """Unrounded share of customers per target, and the total GMV."""
    return crossings(sorted_customers, targets).select(
        "target", numeric.pct(F.col("rnk"), F.col("customers")).alias("top_customers_pct"), "total_gmv"
    )


def lorenz_curve(sorted_customers: Ordered) -> DataFrame:
    """Points (x, y) of the curve, one per customer."""
    curve = cumulative(sorted_customers)
    n = F.col("rows_total")
    return curve.select(
        "rnk",
        numeric.pct(F.col("rnk"), n).alias("customers_pct"),
        numeric.pct(F.col("cumulative_gmv"), F.col("cumulative_gmv_total")).alias("gmv_pct"),
    )


def top_rows(sorted_customers: Ordered, fraction: float) -> DataFrame:
    """The first ``floor(n * fraction)`` customers, at least one, with their rank."""
    last = F.greatest(F.floor(F.col("_rows") * F.lit(fraction)), F.lit(1))
    ranked = sorted_customers.ranked("rnk", total="_rows", gmv=F.col("net_spend"))
    return ranked.filter(F.col("rnk") <= last).drop("_rows")


def top_fraction_share(sorted_customers: Ordered, fraction: float = 0.15) -> DataFrame:
    """GMV share of the customers of :func:`top_rows`."""
    top = top_rows(sorted_customers, fraction)
    return top.agg(
        F.count(F.lit(1)).alias("top_customers"),
        numeric.pct(F.sum("net_spend"), F.max("gmv_total")).alias("top_share_pct"),
    )


def key_accounts(sorted_customers: Ordered, share: int = 50) -> DataFrame:
    """The customers up to the crossing of ``share`` percent of GMV: how many, mean spend, multiple of the base."""
    return crossings(sorted_customers, [share]).select(
        F.col("rnk").alias("key_customers"),
        F.col("cumulative_gmv").alias("key_gmv"),
        numeric.ratio(F.col("cumulative_gmv"), F.col("rnk")).alias("key_avg_spend"),
        numeric.ratio(F.col("total_gmv"), F.col("customers")).alias("base_avg_spend"),
        (
            numeric.ratio(F.col("cumulative_gmv"), F.col("rnk"))
            / numeric.ratio(F.col("total_gmv"), F.col("customers"))
        ).alias("multiple_of_base"),
    )


def revenue_at_risk(sorted_customers: Ordered, churn_pct: int = 5, share: int = 50) -> DataFrame:
    """GMV lost if ``churn_pct`` percent of the key accounts leave, at their mean spend, and the
    size of the largest group of lowest-spending customers with no more GMV than that."""
    crossing = crossings(sorted_customers, [share])
    # one row, used as one scalar value
    key = crossing.agg(F.max(F.struct("rnk", "cumulative_gmv"))).scalar()
    at_risk_100 = key["cumulative_gmv"] * churn_pct
    from_bottom = F.col("cumulative_gmv_total") - F.col("cumulative_gmv") + F.col("net_spend")
    return (
        cumulative(sorted_customers)
        .agg(numeric.count_if(from_bottom * 100 <= at_risk_100).alias("equal_bottom_customers"))
        .select(
            numeric.rounded_ratio(key["rnk"] * churn_pct, F.lit(100), 0).cast("bigint").alias("customers_lost"),
            (at_risk_100.cast("double") / 100).alias("gmv_at_risk"),
            "equal_bottom_customers",
        )
    )


def monthly_gmv(orders: DataFrame, window_end: Column | None = None) -> DataFrame:
    """Delivered GMV per month, up to and including ``window_end``."""
    good = delivered(orders)
    if window_end is not None:
        good = good.filter(F.col("order_date") <= window_end)
    return (
        good.groupBy(calendar.month_start(F.col("order_date")).alias("_month"))
        .agg(F.sum("net_order_value").alias("gmv"))
        .select(calendar.month_key(F.col("_month")).alias("order_month"), "gmv")
        .orderBy("order_month")
    )
