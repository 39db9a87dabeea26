"""Schemas of the six model tables and the relations between them."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DATE, SHORT = T.StringType(), T.DateType(), T.ShortType()
MONEY, MOMENT = T.DecimalType(10, 2), T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    "customers": _table(
        customer_id=STRING, signup_date=DATE, acquisition_channel=STRING, city=STRING, cohort_month=STRING
    ),
    "restaurants": _table(
        restaurant_id=STRING, city=STRING, cuisine_type=STRING, price_band=STRING, active_flag=SHORT
    ),
    "orders": _table(
        order_id=STRING,
        customer_id=STRING,
        restaurant_id=STRING,
        order_date=DATE,
        order_hour=SHORT,
        order_day_of_week=STRING,
        order_month=STRING,
        is_weekend=SHORT,
        items_count=SHORT,
        gross_order_value=MONEY,
        net_order_value=MONEY,
        payment_method=STRING,
        order_status=STRING,
    ),
    "order_items": _table(
        order_item_id=STRING, order_id=STRING, item_id=STRING, item_category=STRING, quantity=SHORT, item_price=MONEY
    ),
    "delivery_events": _table(
        delivery_event_id=STRING,
        order_id=STRING,
        pickup_time=MOMENT,
        dispatched_time=MOMENT,
        delivered_time=MOMENT,
        delivery_delay_min=T.DecimalType(6, 1),
        promised_delivery_min=SHORT,
        delivery_status=STRING,
    ),
    "discounts": _table(
        discount_id=STRING,
        order_id=STRING,
        discount_type=STRING,
        discount_value=MONEY,
        discount_pct=T.DecimalType(5, 1),
        promo_source=STRING,
    ),
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "restaurants": "restaurant_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "delivery_events": "delivery_event_id",
    "discounts": "discount_id",
}

# unique besides the primary keys: an order has at most one delivery event
UNIQUE = (("delivery_events", "order_id"),)

# (child table, key, parent table)
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers"),
    ("orders", "restaurant_id", "restaurants"),
    ("order_items", "order_id", "orders"),
    ("delivery_events", "order_id", "orders"),
    ("discounts", "order_id", "orders"),
)
