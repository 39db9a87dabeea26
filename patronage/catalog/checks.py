"""Sources and sinks, data quality and order enrichment as named queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions import calendar
from patronage.operators.facts import delivered
from patronage.plans import enrichment, exports, kpis, quality, revenue, segments
from patronage.session import shared_dir
from patronage.sources import files
from patronage.sources.binding import BoundTables as B

RELATIONS = (
    ("orders", "customer_id", "customers"),
    ("order_items", "restaurant_id", "restaurants"),
    ("order_items", "order_id", "orders"),
    ("delivery_events", "order_id", "orders"),
    ("discounts", "order_id", "orders"),
)

ORDER_CSV = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("order_date", T.DateType(), False),
        T.StructField("order_hour", T.ShortType(), False),
        T.StructField("net_order_value", T.DecimalType(12, 2), False),
        T.StructField("payment_method", T.StringType(), False),
        T.StructField("order_status", T.StringType(), False),
    ]
)


def _scratch(b: B) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    return f"{shared_dir(b.spark).rstrip('/')}/patronage-{uuid.uuid4().hex}"


def _through_csv(b: B, df: DataFrame, schema: T.StructType) -> DataFrame:
    path = _scratch(b)
    files.write_csv(df, path)
    return files.read_csv(b.spark, path, schema)


def _model(b: B) -> dict[str, DataFrame]:
    return {
        "customers": b.customer_dimension,
        "restaurants": b.restaurants,
        "orders": b.orders,
        "order_items": b.order_items,
        "delivery_events": b.delivery_events,
        "discounts": b.discounts,
    }


def _kpi_sink(b: B) -> DataFrame:
    result = kpis.monthly_kpis(b.customers, b.facts)
    return _through_csv(b, result, result.schema)


def _flag_sink(b: B) -> DataFrame:
    result = files.flags_as_numbers(exports.customer_facts_all(b.customer_dimension, b.orders))
    return _through_csv(b, result, result.schema)


def _parquet_sink(b: B) -> DataFrame:
    """Orders written by month and read back."""
    path = _scratch(b)
    files.write_parquet(enrichment.with_calendar(b.orders), path, partition_by=["order_month"])
    kept = b.spark.read.parquet(path)
    return kept.groupBy(F.col("order_month").cast("string").alias("order_month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_order_value").alias("gmv")
    )


def _view_counts(b: B) -> DataFrame:
    files.register_views(
        {
            "monthly_kpis_view": kpis.monthly_kpis(b.customers, b.facts),
            "customer_segments_view": segments.customer_segments(b.customers, b.facts, b.orders),
        }
    )
    return b.spark.sql(
        """
        SELECT 'customer_segments_view' AS view_name, count(*) AS n FROM customer_segments_view
        UNION ALL
        SELECT 'monthly_kpis_view' AS view_name, count(*) AS n FROM monthly_kpis_view
        """
    )


def _preview(b: B) -> DataFrame:
    spend = revenue.customer_spend(delivered(b.orders))
    return files.preview(spend.orderBy(F.desc("net_spend"), "customer_id"))


def _reconcile(b: B) -> DataFrame:
    """All six tables against what was written of them: orders as CSV, the others as Parquet."""
    tables = _model(b)
    loaded = {"orders": _through_csv(b, b.orders, ORDER_CSV)}
    for name in tables.keys() - loaded.keys():
        path = _scratch(b)
        files.write_parquet(tables[name], path)
        loaded[name] = b.spark.read.schema(tables[name].schema).parquet(path)
    return quality.reconcile_counts(tables, loaded)


def _primary_keys(b: B) -> DataFrame:
    keys = {
        "customers": "customer_id",
        "restaurants": "restaurant_id",
        "orders": "order_id",
        "order_items": "order_item_id",
        "delivery_events": "delivery_event_id",
        "discounts": "discount_id",
    }
    tables = _model(b)
    return quality.primary_keys({name: (tables[name], key) for name, key in keys.items()})


def _summary(b: B) -> DataFrame:
    valued = b.orders.join(enrichment.order_values(b.order_items), "order_id", "left")
    parts = [
        quality.numeric_summary(valued, ["gross_order_value", "net_order_value", "items_count"]),
        quality.numeric_summary(b.delivery_events, ["delivery_delay_min", "promised_delivery_min"]),
    ]
    rounded = [p.select("metric", "n", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in p.columns[2:]]) for p in parts]
    return rounded[0].union(rounded[1])


def _six_places(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


def _promotions(b: B) -> DataFrame:
    """Discount rows with a kind and amounts derived from the order; see the binding's note."""
    gross = enrichment.order_values(b.order_items).select("order_id", "gross_order_value")
    priority = F.substring("payment_method", 1, 1)
    kind = (
        F.when(priority == "1", "Flat").when(priority == "2", "Percentage").when(priority == "3", "Free Delivery")
    ).otherwise("Buy1Get1")
    return (
        b.discounts.join(gross, "order_id")
        .join(b.orders.select("order_id", kind.alias("discount_type")), "order_id")
        .withColumn(
            "discount_value",
            enrichment.discount_value(
                F.col("discount_type"),
                (F.lit(20) + F.col("order_id") % 100).cast("decimal(18,2)"),
                (F.lit(25) + F.col("order_id") % 35).cast("decimal(18,2)"),
                F.col("discount_pct"),
                F.col("gross_order_value"),
            ),
        )
        .select("order_id", "discount_type", "discount_pct", "gross_order_value", "discount_value")
    )


def _net_values(b: B) -> DataFrame:
    orders = enrichment.order_values(b.order_items).select("order_id", "gross_order_value")
    return enrichment.with_net(orders, _promotions(b).select("order_id", "discount_value"))


def _timeline(b: B) -> DataFrame:
    events = b.delivery_events.select("order_id", "delivery_delay_min", "promised_delivery_min")
    timed = (
        b.orders.select("order_id", "order_date", "order_hour")
        .join(events, "order_id")
        .withColumn("prep_min", (F.lit(8) + F.col("order_id") % 17).cast("int"))
        .withColumn("dispatch_min", (F.lit(3) + F.col("order_id") % 9).cast("int"))
    )
    return enrichment.with_timeline(timed).select("order_id", "dispatched_time", "pickup_time", "delivered_time")


QUERIES: dict[str, Callable[[B], DataFrame]] = {
    # sources and sinks
    "csv_load_orders": lambda b: _through_csv(b, b.orders, ORDER_CSV),
    "csv_dates_by_month": lambda b: _through_csv(b, b.orders, ORDER_CSV)
    .groupBy(calendar.month_key(F.col("order_date")).alias("order_month"))
    .agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")),
    "view_row_counts": _view_counts,
    "csv_result_sink": _kpi_sink,
    "csv_flags_as_numbers": _flag_sink,
    "parquet_by_month_sink": _parquet_sink,
    "result_preview": _preview,
    # data quality
    "row_count_reconciliation": _reconcile,
    "foreign_key_orphans": lambda b: quality.foreign_keys(_model(b), RELATIONS),
    "primary_key_checks": _primary_keys,
    "order_coverage": lambda b: quality.order_coverage(b.orders, b.order_items, b.delivery_events),
    "lifecycle_shares": lambda b: quality.lifecycle_shares(b.orders, b.customer_dimension),
    "discounted_order_share": lambda b: quality.discounted_share(b.orders, b.discounts),
    "weekend_uplift": lambda b: quality.weekend_uplift(b.orders),
    "season_uplift": lambda b: quality.season_uplift(b.orders),
    "top_customer_share": lambda b: quality.top_share(b.orders),
    "delay_by_order_count": lambda b: _six_places(quality.delay_by_order_count(b.facts)),
    "numeric_summary": _summary,
    "table_row_counts": lambda b: quality.row_counts(_model(b)),
    # enrichment
    "order_gross_value": lambda b: enrichment.order_values(b.order_items).select("order_id", "gross_order_value"),
    "order_item_count": lambda b: enrichment.order_values(b.order_items).select("order_id", "items_count"),
    "discount_values": _promotions,
    "net_order_values": _net_values,
    "calendar_attributes": lambda b: enrichment.with_calendar(b.orders.select("order_id", "order_date")),
    "signup_cohort_month": lambda b: enrichment.with_cohort(b.customers.select("customer_id", "signup_date")),
    "delivery_status": lambda b: enrichment.with_delivery_status(
        # a grace of ten minutes, so that all four statuses occur
        b.delivery_events.select("order_id", (F.col("delivery_delay_min") - 10).alias("delivery_delay_min"))
    ),
    "delivery_timeline": _timeline,
}
