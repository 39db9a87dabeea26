"""Checking SQL of :mod:`patronage.catalog.checks`."""

from __future__ import annotations

from patronage.catalog.oracle_analyses import ORACLE as ANALYSES
from patronage.catalog.oracle_base import HISTORY, MODEL, share

_ORDER_ROWS = MODEL + """
SELECT oid AS order_id, cid AS customer_id, d::VARCHAR AS order_date, hr AS order_hour, net::DOUBLE AS net_order_value,
       pay AS payment_method, status AS order_status FROM fact"""

_GROSS = """,
gross AS (
    SELECT l_orderkey AS oid, count(*) AS items,
           sum(CAST(l_quantity AS BIGINT) * CAST(round(100 * l_extendedprice) AS BIGINT))::HUGEINT AS g
    FROM lineitem GROUP BY ALL
),
promo AS (
    SELECT oid, g, CASE left(pay, 1) WHEN '1' THEN 'Flat' WHEN '2' THEN 'Percentage' WHEN '3' THEN 'Free Delivery' ELSE 'Buy1Get1' END AS kind,
           CAST(round(1000 * top_disc) AS BIGINT) AS tenths
    FROM fact JOIN gross USING (oid) JOIN parcel USING (oid) WHERE disc
),
valued AS (
    -- in thousandths of a money unit
    SELECT *, least(7 * g,
        CASE kind WHEN 'Flat' THEN 1000 * (20 + oid % 100) WHEN 'Free Delivery' THEN 1000 * (25 + oid % 35)
                  ELSE 10 * ((2 * g * tenths + 1000) // 2000) END) AS v
    FROM promo
)"""


def _orphans(label: str, child: str, key: str, parent: str, parent_key: str) -> str:
    missing = f"count(*) FILTER ({key} NOT IN (SELECT {parent_key} FROM {parent}))"
    return (
        f"SELECT '{label}' AS relation, {missing} AS orphans, CASE WHEN {missing} = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM {child}"
    )


def _key(label: str, table: str, key: str) -> str:
    distinct = f"count(DISTINCT {key})"
    return (
        f"SELECT '{label}' AS key_name, count(*) AS n, count(*) - {distinct} AS surplus, 0::BIGINT AS nulls, "
        f"(count(*) = {distinct})::INT::BIGINT AS is_unique FROM {table}"
    )


def _summary(table: str, metric: str, column: str) -> str:
    places = ", ".join(
        f"round(quantile_cont({column}::DOUBLE, {p}), 2) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    return (
        f"SELECT '{metric}' AS metric, count({column}) AS n, round(avg({column}::DOUBLE), 2) AS mean, "
        f"round(stddev_samp({column}::DOUBLE), 2) AS std, round(min({column})::DOUBLE, 2) AS min, {places}, "
        f"round(max({column})::DOUBLE, 2) AS max FROM {table}"
    )


ORACLE: dict[str, str] = {
    "csv_load_orders": _ORDER_ROWS,
    "csv_dates_by_month": """
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_day,
       CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_day FROM orders GROUP BY ALL""",
    "view_row_counts": MODEL + """
SELECT 'customer_segments_view' AS view_name, count(DISTINCT cid) AS n FROM good WHERE delay IS NOT NULL
UNION ALL SELECT 'monthly_kpis_view', count(DISTINCT strftime(d, '%Y-%m')) FROM good""",
    "csv_result_sink": ANALYSES["monthly_kpis"],
    "csv_flags_as_numbers": ANALYSES["customer_facts_all"],
    "parquet_by_month_sink": MODEL + """
SELECT strftime(d, '%Y-%m') AS order_month, count(*) AS orders, CAST(sum(cents) AS DOUBLE) / 100 AS gmv FROM fact GROUP BY ALL""",
    "result_preview": HISTORY + """
SELECT cid AS customer_id, CAST(cents AS DOUBLE) / 100 AS net_spend FROM diary ORDER BY cents DESC, cid LIMIT 5""",
    "row_count_reconciliation": """
SELECT 'orders' AS table_name, count(*) AS expected, count(*) AS actual, 'OK' AS status FROM orders
UNION ALL SELECT 'customers', count(*), count(*), 'OK' FROM customer
UNION ALL SELECT 'restaurants', count(*), count(*), 'OK' FROM supplier
UNION ALL SELECT 'order_items', count(*), count(*), 'OK' FROM lineitem
UNION ALL SELECT 'delivery_events', count(DISTINCT l_orderkey), count(DISTINCT l_orderkey), 'OK' FROM lineitem
UNION ALL SELECT 'discounts', count(DISTINCT l_orderkey), count(DISTINCT l_orderkey), 'OK' FROM lineitem WHERE l_discount >= 0.09""",
    "foreign_key_orphans": " UNION ALL ".join(
        [
            _orphans("orders.customer_id -> customers", "orders", "o_custkey", "customer", "c_custkey"),
            _orphans("order_items.restaurant_id -> restaurants", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
            _orphans("order_items.order_id -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            _orphans("delivery_events.order_id -> orders", "(SELECT DISTINCT l_orderkey FROM lineitem)", "l_orderkey", "orders", "o_orderkey"),
            _orphans(
                "discounts.order_id -> orders",
                "(SELECT DISTINCT l_orderkey FROM lineitem WHERE l_discount >= 0.09)", "l_orderkey", "orders", "o_orderkey",
            ),
        ]
    ),
    "primary_key_checks": " UNION ALL ".join(
        [
            _key("customers.customer_id", "customer", "c_custkey"),
            _key("restaurants.restaurant_id", "supplier", "s_suppkey"),
            _key("orders.order_id", "orders", "o_orderkey"),
            _key("order_items.order_item_id", "lineitem", "(l_orderkey, l_linenumber)"),
            _key("delivery_events.delivery_event_id", "(SELECT DISTINCT l_orderkey FROM lineitem)", "l_orderkey"),
            _key("discounts.discount_id", "(SELECT DISTINCT l_orderkey FROM lineitem WHERE l_discount >= 0.09)", "l_orderkey"),
        ]
    ),
    "order_coverage": """
WITH c AS (SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders)
SELECT count(*) AS orders, count(*) FILTER (n = 0) AS orders_without_item, count(*) FILTER (n = 0) AS orders_without_delivery,
       0::BIGINT AS orders_with_several_deliveries, bool_and(n > 0)::INT::BIGINT AS every_order_has_item,
       bool_and(n > 0)::INT::BIGINT AS exactly_one_delivery FROM c""",
    "lifecycle_shares": f"""
WITH c AS (SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer)
SELECT {share('count(*) FILTER (n = 1)', 'count(*) FILTER (n > 0)')} AS one_order_pct,
       {share('count(*) FILTER (n <= 1)', 'count(*)')} AS at_most_one_order_pct, max(n) AS max_orders FROM c""",
    "discounted_order_share": MODEL + f"""
SELECT count(*) FILTER (disc) AS discounted_orders, {share('count(*) FILTER (disc)', 'count(*)')} AS discounted_pct FROM fact""",
    "weekend_uplift": """
WITH c AS (SELECT count(*) FILTER (isodow(o_orderdate) >= 6) AS we, count(*) FILTER (isodow(o_orderdate) < 6) AS wd FROM orders)
SELECT we AS weekend_orders, wd AS weekday_orders,
       ((we::DOUBLE / 208::DOUBLE) / (wd::DOUBLE / 520::DOUBLE) - 1) * 100 AS uplift_pct FROM c""",
    "season_uplift": """
WITH c AS (
    SELECT count(*) FILTER (month(o_orderdate) IN (7, 8, 9)) AS s, count(*) FILTER (month(o_orderdate) NOT IN (7, 8, 9)) AS r,
           730::DOUBLE / 30.44::DOUBLE AS span FROM orders)
SELECT s AS season_orders, r AS other_orders,
       ((s::DOUBLE / (0.25::DOUBLE * span)) / (r::DOUBLE / (0.75::DOUBLE * span)) - 1) * 100 AS uplift_pct FROM c""",
    "top_customer_share": MODEL + """,
spend AS (SELECT cid, sum(cents) AS c FROM fact GROUP BY cid),
pick AS (SELECT *, row_number() OVER (ORDER BY c DESC, cid) AS r, count(*) OVER () AS n FROM spend)
SELECT count(*) FILTER (r <= greatest(floor(n * 0.15::DOUBLE), 1)) AS top_customers,
       100.0::DOUBLE * (CAST(sum(c) FILTER (r <= greatest(floor(n * 0.15::DOUBLE), 1)) AS DOUBLE) / 100)
           / (CAST(sum(c) AS DOUBLE) / 100) AS top_share_pct
FROM pick""",
    "delay_by_order_count": MODEL + """,
c AS (
    SELECT cid, count(*) AS n, CAST(CAST(sum(delay) AS DOUBLE) / count(delay) AS DECIMAL(24,12)) AS a
    FROM fact GROUP BY cid HAVING count(delay) > 0)
SELECT round(CAST(sum(a) FILTER (n = 1) AS DOUBLE) / count(*) FILTER (n = 1), 6) AS avg_delay_one_order,
       round(CAST(sum(a) FILTER (n > 1) AS DOUBLE) / count(*) FILTER (n > 1), 6) AS avg_delay_several FROM c""",
    "numeric_summary": """
WITH line AS (
    SELECT l_orderkey AS oid, count(*) AS items, CAST(sum(CAST(l_quantity AS BIGINT) * CAST(round(100 * l_extendedprice) AS BIGINT)) AS DOUBLE) / 100 AS gross,
           max(l_quantity) AS delay, 25 + max(l_linenumber) AS promised
    FROM lineitem GROUP BY l_orderkey
), valued AS (SELECT round(o_totalprice, 2) AS net, line.* FROM orders LEFT JOIN line ON oid = o_orderkey)
"""
    + " UNION ALL ".join(
        [
            _summary("valued", "gross_order_value", "gross"),
            _summary("valued", "net_order_value", "net"),
            _summary("valued", "items_count", "items"),
            _summary("line", "delivery_delay_min", "delay"),
            _summary("line", "promised_delivery_min", "promised"),
        ]
    ),
    "table_row_counts": """
SELECT 'customers' AS table_name, count(*) AS n FROM customer
UNION ALL SELECT 'restaurants', count(*) FROM supplier
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'order_items', count(*) FROM lineitem
UNION ALL SELECT 'delivery_events', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'discounts', count(DISTINCT l_orderkey) FROM lineitem WHERE l_discount >= 0.09""",
    "order_gross_value": MODEL + _GROSS + """
SELECT oid AS order_id, CAST(g AS DOUBLE) / 100 AS gross_order_value FROM gross""",
    "order_item_count": "SELECT l_orderkey AS order_id, count(*) AS items_count FROM lineitem GROUP BY ALL",
    "discount_values": MODEL + _GROSS + """
SELECT oid AS order_id, kind AS discount_type, CAST(tenths AS DOUBLE) / 10 AS discount_pct, CAST(g AS DOUBLE) / 100 AS gross_order_value,
       CAST(v AS DOUBLE) / 1000 AS discount_value FROM valued""",
    "net_order_values": MODEL + _GROSS + """
SELECT oid AS order_id, CAST(gross.g AS DOUBLE) / 100 AS gross_order_value,
       CAST((10 * gross.g - coalesce(v, 0) + 5) // 10 AS DOUBLE) / 100 AS net_order_value
FROM gross LEFT JOIN valued USING (oid)""",
    "calendar_attributes": """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE)::VARCHAR AS order_date, dayname(o_orderdate) AS order_day_of_week,
       strftime(o_orderdate, '%Y-%m') AS order_month, (isodow(o_orderdate) >= 6)::INT::BIGINT AS is_weekend FROM orders""",
    "signup_cohort_month": MODEL + """
SELECT cid AS customer_id, signup::VARCHAR AS signup_date, strftime(signup, '%Y-%m') AS cohort_month FROM person""",
    "delivery_status": MODEL + """
SELECT oid AS order_id, (top_qty - 10)::DOUBLE AS delivery_delay_min,
       CASE WHEN top_qty > 55 THEN 'Very Late' WHEN top_qty > 25 THEN 'Late' WHEN top_qty > 10 THEN 'Slightly Late' ELSE 'On Time' END
           AS delivery_status FROM parcel""",
    "delivery_timeline": MODEL + """,
t AS (
    SELECT oid, d + to_hours(hr) + to_minutes(8 + oid % 17) AS a, 3 + oid % 9 AS disp,
           greatest(5, 25 + top_line + delay - (8 + oid % 17) - (3 + oid % 9))::BIGINT AS travel
    FROM fact JOIN parcel USING (oid))
SELECT oid AS order_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS dispatched_time,
       strftime(a + to_minutes(disp), '%Y-%m-%d %H:%M:%S') AS pickup_time,
       strftime(a + to_minutes(disp + travel), '%Y-%m-%d %H:%M:%S') AS delivered_time FROM t""",
}
