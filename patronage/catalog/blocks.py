"""Each building block of the analyses as a query of its own, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.functions import bands, calendar, numeric
from patronage.operators import relational as rel
from patronage.operators.facts import (
    customer_days,
    customer_timeline,
    customer_totals,
    delivered,
    snapshot_date,
)
from patronage.operators.independence import chi_square
from patronage.operators.ranking import ntile, ordered, rank_within
from patronage.plans import cohorts, exports, retention, revenue, segments
from patronage.sources.binding import BoundTables as B


def _by_time():
    return [F.col("order_date").asc(), F.col("order_id").asc()]


def _totals(b: B) -> DataFrame:
    return customer_totals(delivered(b.facts))


def _share(b: B) -> DataFrame:
    return _totals(b).select("customer_id", "orders", numeric.pct(F.col("discounted"), F.col("orders")).alias("share"))


def _recency(b: B) -> DataFrame:
    return segments.customer_rfm(b.orders).select("customer_id", "recency_days", "frequency")


def _count_rows():
    return F.count(F.lit(1))


def _spend_order(b: B):
    return revenue.by_spend(b.orders)


def _quartiles(b: B) -> DataFrame:
    totals = customer_totals(delivered(b.orders).select("customer_id"))
    ranked = ordered(totals, [F.col("orders").asc(), F.col("customer_id").asc()]).ranked("place", total="n")
    return ranked.select("customer_id", ntile(F.col("place"), F.col("n"), 4).alias("quartile"))


def _cohort_members(b: B) -> DataFrame:
    buyers = delivered(b.orders).select("customer_id").distinct()
    return b.customers.join(buyers, "customer_id", "left_semi")


def _cohort_grid(b: B) -> DataFrame:
    """Cohort x offset with the active customers, by a left join on both keys."""
    active = (
        cohorts.active_months(b.orders)
        .filter(F.col("offset").isin(*cohorts.OFFSETS))
        .join(b.customers.select("customer_id", "cohort_month"), "customer_id")
        .groupBy("cohort_month", "offset")
        .agg(_count_rows().alias("active"))
    )
    # every member is active at offset 0; the same grouping feeds both sides of the join
    sizes = active.groupBy("cohort_month").agg(F.max(F.when(F.col("offset") == 0, F.col("active"))).alias("cohort_size"))
    return rel.spread_over(sizes, cohorts.OFFSETS, "offset").join(active, ["cohort_month", "offset"], "left")


def _mean_order_of_customer_means(b: B) -> DataFrame:
    """Mean per segment of the customers' own mean order value."""
    good = delivered(b.orders)
    own = customer_totals(good.select("customer_id", "order_date", "net_order_value")).select(
        bands.segment(F.datediff(snapshot_date(good), F.col("last_date")), F.col("orders")).alias("segment"),
        numeric.ratio(F.col("spend"), F.col("orders")).cast("decimal(24,8)").alias("own"),
    )
    return own.groupBy("segment").agg(
        F.round(numeric.ratio(F.sum("own"), _count_rows()), 4).alias("mean_of_means"), _count_rows().alias("customers")
    )


def _status_by_channel(b: B) -> DataFrame:
    """Order status against the order's payment method."""
    return b.orders.groupBy("payment_method", "order_status").agg(_count_rows().alias("n"))


def _independence(b: B) -> DataFrame:
    found = chi_square(_status_by_channel(b), "payment_method", "order_status", "n")
    return found.select(F.round("statistic", 6).alias("statistic"), "dof", F.round("p_value", 6).alias("p_value"))


def _peer_average(b: B) -> DataFrame:
    months = revenue.monthly_gmv(b.orders).withColumn("year", F.substring("order_month", 1, 4))
    # one row per calendar month
    peers = W.partitionBy("year")
    return months.select(
        "order_month", "gmv", numeric.ratio(F.sum("gmv").over(peers), F.count("gmv").over(peers)).alias("year_mean")
    )


def _days_since_first(b: B) -> DataFrame:
    """Every order with the days since its customer's first: the minimum is combined before the shuffle and joined back."""
    good = delivered(b.orders).select("order_id", "customer_id", "order_date")
    first = good.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    since = F.datediff("order_date", "first_order_date").alias("days_since_first")
    return good.join(first, "customer_id").select("order_id", "customer_id", "order_date", since)


def _by_year(b: B) -> DataFrame:
    """One column for each year that the orders have; the years are a few values, read first."""
    dated = b.orders.withColumn("year", F.year("order_date"))
    years = sorted(r["year"] for r in dated.select("year").distinct().collect() if r["year"] is not None)
    wide = dated.groupBy("payment_method").pivot("year", years).agg(F.sum("net_order_value"))
    return wide.select("payment_method", *[F.col(f"`{y}`").alias(f"y{y}") for y in years])


def _theta(b: B) -> DataFrame:
    """Smallest rank per target with a cumulative share of at least the target: one pass, no join."""
    through = revenue.cumulative(_spend_order(b))
    gmv = F.col("cumulative_gmv_total")
    targets = (50, 65, 80)
    wide = through.agg(
        *[F.min(F.when(F.col("cumulative_gmv") * 100 >= gmv * t, F.col("rnk"))).alias(f"rank_{t}") for t in targets]
    )
    return wide.select(
        F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"rank_{t}").alias("rnk")) for t in targets])).alias("r")
    ).select("r.*")


def _horizon_cells(b: B) -> DataFrame:
    grid = _cohort_grid(b).withColumn("month_index", calendar.month_key_index(F.col("cohort_month")))
    horizon = F.max("month_index").over(W.partitionBy())  # cohort months x offsets rows
    return grid.select(
        "cohort_month",
        "offset",
        bands.within_horizon(
            F.col("month_index"), F.col("offset"), horizon, numeric.or_zero(F.col("active"))
        ).alias("active"),
    )


FILTERS: dict[str, Callable[[B], DataFrame]] = {
    "delivered_orders": lambda b: delivered(b.orders).select("order_id", "customer_id", "order_date"),
    "delay_buckets": lambda b: b.delivery_events.select(
        "order_id",
        bands.delay_bucket(F.col("delivery_delay_min")).alias("bucket"),
        bands.delay_bucket_order(F.col("delivery_delay_min")).alias("bucket_order"),
    ),
    "discount_bands": lambda b: _share(b).select(
        "customer_id",
        bands.discount_band(F.col("share")).alias("band"),
        bands.discount_band_order(F.col("share")).alias("band_order"),
    ),
    "repeat_discount_bands": lambda b: _share(b)
    .filter(F.col("orders") >= 2)
    .select("customer_id", bands.repeat_discount_band(F.col("share")).alias("band")),
    "segment_rule": lambda b: _recency(b).select(
        "customer_id", bands.segment(F.col("recency_days"), F.col("frequency")).alias("segment")
    ),
    "churn_flag": lambda b: _recency(b).select(
        "customer_id", "recency_days", bands.churned(F.col("recency_days")).alias("is_churned")
    ),
    "horizon_mask": _horizon_cells,
    "null_default": lambda b: b.customer_dimension.select("customer_id")
    .join(customer_totals(delivered(b.orders).select("customer_id")), "customer_id", "left")
    .select("customer_id", numeric.or_zero(F.col("orders")).alias("orders")),
    "zero_divide_guard": lambda b: customer_totals(b.facts)
    .select("customer_id", "discounted", (F.col("orders") - F.col("discounted")).alias("plain"))
    .select("customer_id", numeric.ratio(F.col("discounted"), F.col("plain")).alias("discounted_per_plain")),
    "date_cutoff": lambda b: revenue.monthly_gmv(b.orders, F.lit("1999-12-15").cast("date")),
    "dimension_filter": lambda b: exports.dimension_filter(
        b.customer_dimension, city="NATION_2", acquisition_channel="all"
    ),
    "membership_flag": lambda b: rel.membership_flag(
        b.orders.select("order_id", "customer_id"), b.discounts, "order_id", "is_discounted"
    ),
    "second_order_pick": lambda b: rel.pick_nth(
        delivered(b.orders).select("customer_id", "order_id", "order_date"), "customer_id", _by_time(), 2
    ),
    "renamed_projection": lambda b: b.customer_dimension.select(
        F.col("city").alias("City"), F.col("customer_id").alias("CustomerID")
    ),
    "typed_nulls": lambda b: delivered(b.orders).select(
        "order_id", F.lit(None).cast("string").alias("label"), F.lit(None).cast("decimal(12,2)").alias("amount")
    ),
    "known_outcomes_only": lambda b: rel.known_outcome(retention.retention_flags_strict(b.orders), "retained").select(
        "customer_id", "retained"
    ),
    "distinct_dimension_values": lambda b: rel.distinct_values(b.customer_dimension, "city"),
}

JOINS: dict[str, Callable[[B], DataFrame]] = {
    "join_inner": lambda b: b.orders.select("order_id", "customer_id").join(
        b.delivery_events.select("order_id", "delivery_delay_min"), "order_id"
    ),
    "join_left": lambda b: b.orders.select("order_id").join(
        b.discounts.select("order_id", "discount_pct"), "order_id", "left"
    ),
    "join_left_two_keys": _cohort_grid,
    "join_one_row": lambda b: customer_totals(delivered(b.orders).select("customer_id", "order_date")).select(
        "customer_id", F.datediff(snapshot_date(b.orders), F.col("last_date")).alias("days_since_last")
    ),
    "join_literal_vector": lambda b: rel.spread_over(
        b.customer_dimension.select("customer_id"), cohorts.OFFSETS, "offset"
    ),
    "join_theta_minimum": _theta,
    "join_first_with_second": lambda b: rel.first_two_dates(delivered(b.orders)),
    "join_anti": lambda b: rel.orphan_rows(b.orders.select("order_id"), b.delivery_events, "order_id"),
    "join_semi": lambda b: rel.rows_with_match(b.orders.select("order_id", "customer_id"), b.discounts, "order_id"),
    "scalar_subquery": lambda b: b.orders.groupBy("customer_id")
    .agg(F.max("order_date").alias("last_date"))
    .select("customer_id", F.datediff(snapshot_date(b.orders), F.col("last_date")).alias("recency_days")),
    "key_lookup": lambda b: customer_timeline(delivered(b.orders).select("customer_id", "order_id", "order_date"))
    .select("customer_id", F.col("first_order_id").alias("order_id"))
    .join(b.delivery_events.select("order_id", "delivery_delay_min"), "order_id", "left"),
    "reindex_to_list": lambda b: rel.reindexed(
        b.delivery_events.groupBy(bands.delay_bucket(F.col("delivery_delay_min") - 10).alias("bucket")).agg(
            _count_rows().alias("n")
        ),
        "bucket",
        bands.DELAY_LABELS,
    ),
}

AGGREGATES: dict[str, Callable[[B], DataFrame]] = {
    "count_rows": lambda b: delivered(b.orders).groupBy("customer_id").agg(_count_rows().alias("orders")),
    "count_distinct": lambda b: b.orders.groupBy(F.trunc("order_date", "month").alias("first_day"))
    .agg(F.countDistinct("customer_id").alias("customers"))
    .select(calendar.month_key(F.col("first_day")).alias("order_month"), "customers"),
    "sum_decimal": lambda b: revenue.customer_spend(delivered(b.orders)),
    "average": lambda b: b.delivery_events.groupBy("promised_delivery_min").agg(
        numeric.ratio(F.sum("delivery_delay_min"), F.count("delivery_delay_min")).alias("avg_delay")
    ),
    "min_max": lambda b: b.orders.groupBy("order_status").agg(
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    ),
    "conditional_pct": lambda b: b.facts.groupBy("order_status").agg(
        numeric.pct(
            numeric.count_if(F.col("delivery_delay_min") < 20), F.count("delivery_delay_min")
        ).alias("on_time_pct")
    ),
    "any_true": lambda b: b.facts.groupBy("customer_id").agg(F.bool_or("is_discounted").alias("ever_discounted")),
    "pct_ratio": lambda b: _share(b).select("customer_id", F.col("share").alias("discount_pct")),
    "global_aggregate": lambda b: revenue.customer_spend(delivered(b.orders)).agg(
        _count_rows().alias("total_customers"), F.sum("net_spend").alias("total_gmv")
    ),
    "group_by_label_and_order": lambda b: b.delivery_events.groupBy(
        bands.delay_bucket(F.col("delivery_delay_min")).alias("bucket"),
        bands.delay_bucket_order(F.col("delivery_delay_min")).alias("bucket_order"),
    )
    .agg(_count_rows().alias("n"))
    .orderBy("bucket_order"),
    "mean_of_customer_means": _mean_order_of_customer_means,
    "mean_of_flag": lambda b: retention.retention_flags_strict(b.orders).agg(
        F.avg(F.col("retained").cast("int")).alias("share")
    ),
    "group_size": lambda b: customer_totals(b.orders.select("customer_id")),
    "value_counts": lambda b: rel.value_counts(_cohort_members(b), "cohort_month"),
    "contingency_table": lambda b: rel.contingency(
        b.orders, "payment_method", "order_status", ["Delivered", "Refunded", "Cancelled"]
    ),
    "independence_test": _independence,
    "pivot_matrix": _by_year,
    "first_per_group": lambda b: rel.pick_nth(
        delivered(b.orders).select("customer_id", "order_id", "order_date"), "customer_id", _by_time(), 1
    ).select("customer_id", F.col("order_id").alias("first_order_id")),
}

WINDOWS: dict[str, Callable[[B], DataFrame]] = {
    "order_sequence": lambda b: rank_within(
        delivered(b.orders).select("customer_id", "order_id", "order_date"), "customer_id", _by_time()
    ).select("customer_id", "order_id", "rn"),
    "spend_rank": lambda b: _spend_order(b).ranked("rnk"),
    "frequency_quartile": _quartiles,
    "running_sum": lambda b: revenue.cumulative(_spend_order(b)).drop("rows_total", "cumulative_gmv_total"),
    "cumulative_share": lambda b: revenue.pareto_detail(_spend_order(b)).select(
        "rnk", "customer_id", "cumulative_customer_pct"
    ),
    "peer_average": _peer_average,
    "group_minimum_on_rows": _days_since_first,
    "first_index_at_target": lambda b: revenue.crossings(_spend_order(b), (25, 50, 75, 100)).select("target", "rnk"),
    "top_fraction_rows": lambda b: revenue.top_rows(_spend_order(b), 0.15).drop("gmv_total"),
}


def _dated(b: B) -> DataFrame:
    return b.orders.select("order_id", "order_date")


SORTS: dict[str, Callable[[B], DataFrame]] = {
    "order_mixed_direction": lambda b: segments.customer_rfm(b.orders).orderBy(F.desc("frequency"), "customer_id"),
    "order_milestones_first": lambda b: revenue.revenue_pareto(_spend_order(b)).select(
        "row_type", "rnk", "cumulative_gmv_pct"
    ),
    "order_stable_keys": lambda b: delivered(b.orders)
    .select("customer_id", "order_date", "order_id")
    .orderBy("customer_id", "order_date", "order_id"),
    "order_by_category": lambda b: b.delivery_events.select(
        "order_id",
        bands.delay_bucket(F.col("delivery_delay_min")).alias("bucket"),
        bands.delay_bucket_order(F.col("delivery_delay_min")).alias("bucket_order"),
    ).orderBy("bucket_order", "order_id"),
    "order_descending": lambda b: revenue.customer_spend(delivered(b.orders)).orderBy(
        F.desc("net_spend"), "customer_id"
    ),
    "union_all": lambda b: delivered(b.orders)
    .select("order_id", F.lit("delivered").alias("source"))
    .unionByName(b.discounts.select(F.lit("discounted").alias("source"), "order_id")),
    "unnest_array": lambda b: _cohort_members(b)
    .groupBy("cohort_month")
    .agg(_count_rows().alias("n"))
    .select("cohort_month", "n", F.explode(F.array(*[F.lit(k) for k in cohorts.OFFSETS])).alias("offset")),
    "values_table": lambda b: b.spark.sql(
        "SELECT label, count(*) AS orders FROM {orders} "
        "JOIN VALUES ('Delivered', 'kept'), ('Cancelled', 'lost') AS t(order_status, label) USING (order_status) "
        "GROUP BY label",
        orders=b.orders,
    ),
}

SCALARS: dict[str, Callable[[B], DataFrame]] = {
    "month_difference": lambda b: delivered(b.orders).select(
        "order_id", calendar.months_between_calendar(F.col("order_date"), F.lit("1995-01-31").cast("date")).alias("months")
    ),
    "day_difference": lambda b: _dated(b).select(
        "order_id", calendar.days_between(snapshot_date(b.orders), F.col("order_date")).alias("days")
    ),
    "date_plus_days": lambda b: _dated(b).select("order_id", F.date_add("order_date", 90).alias("window_end")),
    "split_month_key": lambda b: _cohort_members(b).select(
        "customer_id", calendar.month_key_index(F.col("cohort_month")).alias("month_index")
    ),
    "round_half_up": lambda b: _totals(b).select(
        "customer_id",
        numeric.rounded_ratio(F.col("spend"), F.col("orders"), 2).alias("avg_spend"),
        numeric.rounded_pct(F.col("discounted"), F.col("orders"), 3).alias("discount_pct"),
    ),
    "text_concat": lambda b: _totals(b).select(
        "customer_id",
        F.concat(F.col("orders").cast("string"), F.lit(" orders, "), F.col("spend").cast("string")).alias("label"),
    ),
    "type_casts": lambda b: b.orders.select(
        F.col("order_id").cast("string").alias("id_text"),
        F.col("net_order_value").cast("bigint").alias("whole"),
        F.col("order_hour").cast("decimal(10,2)").alias("hour_numeric"),
    ),
    "month_period": lambda b: _dated(b).select(
        "order_id",
        calendar.month_key(F.col("order_date")).alias("period"),
        calendar.month_index(F.col("order_date")).alias("month_index"),
    ),
    "month_in_set": lambda b: _dated(b).select(
        "order_id",
        F.month("order_date").alias("month"),
        calendar.in_months(F.col("order_date"), [7, 8, 9]).alias("in_season"),
    ),
    "clip_and_fill": lambda b: b.facts.select(
        "order_id",
        numeric.clipped(
            numeric.or_zero(F.col("delivery_delay_min")) - 6, F.lit(-5).cast("decimal(6,1)"), F.lit(30).cast("decimal(6,1)")
        ).alias("clipped"),
    ),
    "compact_money": lambda b: customer_totals(delivered(b.orders).select("customer_id", "net_order_value")).select(
        "customer_id", numeric.compact_money(F.col("spend")).alias("money")
    ),
}

QUERIES = {**FILTERS, **JOINS, **AGGREGATES, **WINDOWS, **SORTS, **SCALARS}
