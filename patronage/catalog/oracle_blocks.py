"""Checking SQL of :mod:`patronage.catalog.blocks`."""

from __future__ import annotations

from patronage.catalog.oracle_analyses import _COHORT, _PARETO
from patronage.catalog.oracle_base import (
    HISTORY,
    MODEL,
    band_label,
    band_place,
    delay_label,
    delay_place,
    rounded,
    segment_label,
    share,
)

_REC = HISTORY + """,
rec AS (SELECT cid, n, cents, date_diff('day', dn, d_all) AS days FROM flag, edge)"""
_OFFSETS = "[0, 1, 2, 3, 6, 9, 12]"
_MONEY = "CAST({} AS DOUBLE) / 100"

ORACLE: dict[str, str] = {
    # filters and expressions
    "delivered_orders": MODEL + " SELECT oid AS order_id, cid AS customer_id, d::VARCHAR AS order_date FROM good",
    "delay_buckets": MODEL + f"""
SELECT oid AS order_id, {delay_label('top_qty')} AS bucket, {delay_place('top_qty')} AS bucket_order FROM parcel""",
    "discount_bands": HISTORY + f"""
SELECT cid AS customer_id, {band_label('nd', 'n')} AS band, {band_place('nd', 'n')} AS band_order FROM diary""",
    "repeat_discount_bands": HISTORY + """
SELECT cid AS customer_id, CASE WHEN nd = 0 THEN 'Never' WHEN 100 * nd > 60 * n THEN 'Heavy' ELSE 'Light/Moderate' END AS band
FROM diary WHERE n >= 2""",
    "segment_rule": _REC + f" SELECT cid AS customer_id, {segment_label('days', 'n')} AS segment FROM rec",
    "churn_flag": _REC + " SELECT cid AS customer_id, days AS recency_days, (days > 90)::INT::BIGINT AS is_churned FROM rec",
    "horizon_mask": _COHORT + ' SELECT cohort AS cohort_month, k::BIGINT AS "offset", active FROM cell',
    "null_default": MODEL + """
SELECT c_custkey AS customer_id, (SELECT count(*) FROM good WHERE cid = c_custkey) AS orders FROM customer""",
    "zero_divide_guard": MODEL + """
SELECT cid AS customer_id, CASE WHEN NOT bool_and(disc)
    THEN CAST(count(*) FILTER (disc) AS DOUBLE) / CAST(count(*) FILTER (NOT disc) AS DOUBLE) END AS discounted_per_plain
FROM fact GROUP BY cid""",
    "date_cutoff": MODEL + f"""
SELECT strftime(d, '%Y-%m') AS order_month, {_MONEY.format('sum(cents)')} AS gmv FROM good WHERE d < DATE '1999-12-16' GROUP BY ALL""",
    "dimension_filter": """
SELECT c_custkey AS customer_id, n_name AS city, c_mktsegment AS acquisition_channel
FROM customer, nation WHERE c_nationkey = n_nationkey AND n_name = 'NATION_2'""",
    "membership_flag": MODEL + " SELECT oid AS order_id, cid AS customer_id, disc::INT::BIGINT AS is_discounted FROM fact",
    "second_order_pick": MODEL + """
SELECT cid AS customer_id, oid AS order_id, d::VARCHAR AS order_date FROM good
QUALIFY row_number() OVER (PARTITION BY cid ORDER BY d, oid) = 2""",
    "renamed_projection": """
SELECT n_name AS "City", c_custkey AS "CustomerID" FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "typed_nulls": MODEL + " SELECT oid AS order_id, NULL::VARCHAR AS label, NULL::DOUBLE AS amount FROM good",
    "known_outcomes_only": HISTORY + """
SELECT cid AS customer_id, strict::INT::BIGINT AS retained FROM flag, edge WHERE n > 1 OR d_good - d1 >= 90""",
    "distinct_dimension_values": "SELECT DISTINCT n_name AS city FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)",
    # joins
    "join_inner": MODEL + """
SELECT oid AS order_id, cid AS customer_id, delay::DOUBLE AS delivery_delay_min FROM fact WHERE delay IS NOT NULL""",
    "join_left": MODEL + """
SELECT f.oid AS order_id, CASE WHEN disc THEN round(top_disc * 1000) / 10 END AS discount_pct
FROM fact f LEFT JOIN parcel USING (oid)""",
    "join_left_two_keys": _COHORT + """
SELECT cohort AS cohort_month, k::BIGINT AS "offset", size AS cohort_size, nullif(active, 0) AS active FROM grid""",
    "join_one_row": HISTORY + """
SELECT cid AS customer_id, date_diff('day', dn, d_all) AS days_since_last FROM flag, edge""",
    "join_literal_vector": f"""
SELECT c_custkey AS customer_id, unnest({_OFFSETS})::BIGINT AS "offset" FROM customer""",
    "join_theta_minimum": _PARETO + " SELECT t::BIGINT AS target, r AS rnk FROM goal",
    "join_first_with_second": HISTORY + """
SELECT cid AS customer_id, ds[1]::VARCHAR AS first_order_date, ds[2]::VARCHAR AS second_order_date FROM diary""",
    "join_anti": "SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "join_semi": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount >= 0.09)""",
    "scalar_subquery": """
SELECT o_custkey AS customer_id,
       date_diff('day', CAST(max(o_orderdate) AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS recency_days
FROM orders GROUP BY o_custkey""",
    "key_lookup": HISTORY + " SELECT cid AS customer_id, oid1 AS order_id, delay1::DOUBLE AS delivery_delay_min FROM diary",
    "reindex_to_list": MODEL + f"""
SELECT label AS bucket, place::BIGINT AS bucket_order, n
FROM (VALUES ('0-10 min', 1), ('10-20 min', 2), ('20-35 min', 3), ('35-50 min', 4), ('50+ min', 5)) v(label, place)
LEFT JOIN (SELECT {delay_label('(top_qty - 10)')} AS b, count(*) AS n FROM parcel GROUP BY b) ON b = label""",
    # aggregates
    "count_rows": MODEL + " SELECT cid AS customer_id, count(*) AS orders FROM good GROUP BY cid",
    "count_distinct": MODEL + """
SELECT strftime(d, '%Y-%m') AS order_month, count(DISTINCT cid) AS customers FROM fact GROUP BY ALL""",
    "sum_decimal": MODEL + f" SELECT cid AS customer_id, {_MONEY.format('sum(cents)')} AS net_spend FROM good GROUP BY cid",
    "average": MODEL + """
SELECT (25 + top_line)::BIGINT AS promised_delivery_min, sum(top_qty) / count(*) AS avg_delay FROM parcel GROUP BY top_line""",
    "min_max": MODEL + """
SELECT status AS order_status, min(d)::VARCHAR AS first_day, max(d)::VARCHAR AS last_day FROM fact GROUP BY status""",
    "conditional_pct": MODEL + f"""
SELECT status AS order_status, {share('count(*) FILTER (delay < 20)', 'count(delay)')} AS on_time_pct FROM fact GROUP BY status""",
    "any_true": MODEL + " SELECT cid AS customer_id, max(disc::INT)::BIGINT AS ever_discounted FROM fact GROUP BY cid",
    "pct_ratio": HISTORY + f" SELECT cid AS customer_id, {share('nd', 'n')} AS discount_pct FROM diary",
    "global_aggregate": MODEL + f"""
SELECT count(DISTINCT cid) AS total_customers, {_MONEY.format('sum(cents)')} AS total_gmv FROM good""",
    "group_by_label_and_order": MODEL + f"""
SELECT {delay_label('top_qty')} AS bucket, {delay_place('top_qty')} AS bucket_order, count(*) AS n FROM parcel GROUP BY ALL""",
    "mean_of_customer_means": HISTORY + f""",
own AS (
    SELECT {segment_label("date_diff('day', dn, d_good)", 'n')} AS segment,
           CAST(CAST(cents AS DOUBLE) / 100 / n AS DECIMAL(24,8)) AS m
    FROM flag, edge)
SELECT segment, round(CAST(sum(m) AS DOUBLE) / count(*), 4) AS mean_of_means, count(*) AS customers FROM own GROUP BY segment""",
    "mean_of_flag": HISTORY + """
SELECT CAST(count(*) FILTER (strict) AS DOUBLE) / count(*) AS share FROM flag, edge WHERE n > 1 OR d_good - d1 >= 90""",
    "group_size": "SELECT o_custkey AS customer_id, count(*) AS orders FROM orders GROUP BY o_custkey",
    "value_counts": HISTORY + """
SELECT strftime(signup, '%Y-%m') AS cohort_month, count(*) AS n FROM person SEMI JOIN diary USING (cid) GROUP BY ALL""",
    "contingency_table": """
SELECT o_orderpriority AS payment_method, count(*) FILTER (o_orderstatus = 'F') AS "n_Delivered",
       count(*) FILTER (o_orderstatus = 'O') AS "n_Refunded", count(*) FILTER (o_orderstatus = 'P') AS "n_Cancelled",
       count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) AS n_other
FROM orders GROUP BY ALL""",
    "independence_test": """
WITH obs AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*)::DOUBLE AS o FROM orders GROUP BY ALL),
e AS (
    SELECT p, s, o, sum(o) OVER (PARTITION BY p) * sum(o) OVER (PARTITION BY s) / sum(o) OVER () AS e FROM obs),
x AS (SELECT sum(power(o - e, 2) / e) AS x, ((count(DISTINCT p) - 1) * (count(DISTINCT s) - 1))::BIGINT AS dof FROM e)
SELECT round(x, 6) AS statistic, dof,
       round(exp(-x / 2) * (1 + x / 2 + power(x / 2, 2) / 2 + power(x / 2, 3) / 6), 6) AS p_value FROM x""",
    "pivot_matrix": MODEL + " SELECT pay AS payment_method, "
    + ", ".join(f"CAST(sum(cents) FILTER (year(d) = {y}) AS DOUBLE) / 100 AS y{y}" for y in range(1995, 2002))
    + " FROM fact GROUP BY pay",
    "first_per_group": HISTORY + " SELECT cid AS customer_id, oid1 AS first_order_id FROM diary",
    # windows
    "order_sequence": MODEL + """
SELECT cid AS customer_id, oid AS order_id, row_number() OVER (PARTITION BY cid ORDER BY d, oid) AS rn FROM good""",
    "spend_rank": _PARETO + f" SELECT cid AS customer_id, {_MONEY.format('cents')} AS net_spend, r AS rnk FROM rk",
    "frequency_quartile": HISTORY + """
SELECT cid AS customer_id, ntile(4) OVER (ORDER BY n, cid) AS quartile FROM diary""",
    "running_sum": _PARETO + f"""
SELECT cid AS customer_id, {_MONEY.format('cents')} AS net_spend, r AS rnk, {_MONEY.format('cs')} AS cumulative_gmv FROM cum""",
    "cumulative_share": _PARETO + f"""
SELECT r AS rnk, cid AS customer_id, {rounded('r', 'n', 3, 100)} AS cumulative_customer_pct FROM cum""",
    "peer_average": MODEL + f""",
m AS (SELECT strftime(d, '%Y-%m') AS mo, year(d) AS y, sum(cents) AS c FROM good GROUP BY ALL)
SELECT mo AS order_month, {_MONEY.format('c')} AS gmv,
       {_MONEY.format('sum(c) OVER (PARTITION BY y)')} / count(*) OVER (PARTITION BY y) AS year_mean FROM m""",
    "group_minimum_on_rows": MODEL + """
SELECT oid AS order_id, cid AS customer_id, d::VARCHAR AS order_date,
       date_diff('day', min(d) OVER (PARTITION BY cid), d) AS days_since_first
FROM good""",
    "first_index_at_target": _PARETO + """
SELECT t::BIGINT AS target, min(r) AS rnk FROM cum, (VALUES (25), (50), (75), (100)) v(t) WHERE 100 * cs >= t * total GROUP BY t""",
    "top_fraction_rows": _PARETO + f"""
SELECT cid AS customer_id, {_MONEY.format('cents')} AS net_spend, r AS rnk FROM cum WHERE r <= greatest(1, floor(n * 0.15::DOUBLE))""",
    # sorts, unions, literals
    "order_mixed_direction": _REC + f"""
SELECT cid AS customer_id, days AS recency_days, n AS frequency, {_MONEY.format('cents')} AS monetary
FROM rec ORDER BY n DESC, cid""",
    "order_milestones_first": _PARETO + f"""
SELECT 'milestone' AS row_type, NULL::BIGINT AS rnk, t::DOUBLE AS cumulative_gmv_pct FROM goal
UNION ALL SELECT 'detail', r, {rounded('cs', 'total', 3, 100)} FROM cum""",
    "order_stable_keys": MODEL + """
SELECT cid AS customer_id, d::VARCHAR AS order_date, oid AS order_id FROM good ORDER BY ALL""",
    "order_by_category": MODEL + f"""
SELECT oid AS order_id, {delay_label('top_qty')} AS bucket, {delay_place('top_qty')} AS bucket_order FROM parcel ORDER BY 3, 1""",
    "order_descending": HISTORY + f"""
SELECT cid AS customer_id, {_MONEY.format('cents')} AS net_spend FROM diary ORDER BY cents DESC, cid""",
    "union_all": MODEL + """
SELECT oid AS order_id, 'delivered' AS source FROM good UNION ALL SELECT oid, 'discounted' FROM fact WHERE disc""",
    "unnest_array": HISTORY + f""",
s AS (SELECT strftime(signup, '%Y-%m') AS m, count(*) AS n FROM person SEMI JOIN diary USING (cid) GROUP BY m)
SELECT m AS cohort_month, n, unnest({_OFFSETS})::BIGINT AS "offset" FROM s""",
    "values_table": MODEL + """
SELECT CASE status WHEN 'Delivered' THEN 'kept' ELSE 'lost' END AS label, count(*) AS orders
FROM fact WHERE status <> 'Refunded' GROUP BY ALL""",
    # scalar functions
    "month_difference": MODEL + """
SELECT oid AS order_id, date_diff('month', DATE '1995-01-31', d) AS months FROM good""",
    "day_difference": MODEL + """
SELECT oid AS order_id, date_diff('day', d, (SELECT max(d) FROM fact)) AS days FROM fact""",
    "date_plus_days": MODEL + " SELECT oid AS order_id, (d + 90)::VARCHAR AS window_end FROM fact",
    "split_month_key": HISTORY + """
SELECT cid AS customer_id, 12 * year(signup) + month(signup) AS month_index FROM person SEMI JOIN diary USING (cid)""",
    "round_half_up": HISTORY + f"""
SELECT cid AS customer_id, {rounded('cents', '(100 * n)', 2)} AS avg_spend, {rounded('nd', 'n', 3, 100)} AS discount_pct FROM diary""",
    "text_concat": HISTORY + """
SELECT cid AS customer_id, n || ' orders, ' || CAST(sum(net) AS DECIMAL(38,2)) AS label
FROM (SELECT cid, count(*) OVER (PARTITION BY cid) AS n, net FROM good) GROUP BY cid, n""",
    "type_casts": MODEL + """
SELECT oid::VARCHAR AS id_text, cents // 100 AS whole, hr::DOUBLE AS hour_numeric FROM fact""",
    "month_period": MODEL + """
SELECT oid AS order_id, strftime(d, '%Y-%m') AS period, 12 * year(d) + month(d) AS month_index FROM fact""",
    "month_in_set": MODEL + """
SELECT oid AS order_id, month(d) AS month, (month(d) IN (7, 8, 9))::INT::BIGINT AS in_season FROM fact""",
    "clip_and_fill": MODEL + """
SELECT oid AS order_id, least(greatest(coalesce(delay, 0) - 6, -5), 30)::DOUBLE AS clipped FROM fact""",
    "compact_money": HISTORY + """
SELECT cid AS customer_id, '₹' || CASE
    WHEN cents >= 1000000000 THEN CAST(((2 * cents + 10000000) // 20000000)::DECIMAL(38,0) / 100 AS DECIMAL(38,2)) || 'Cr'
    WHEN cents >= 10000000 THEN CAST(((2 * cents + 100000) // 200000)::DECIMAL(38,0) / 100 AS DECIMAL(38,2)) || 'L'
    ELSE format('{:,}', ((cents + 50) // 100)::BIGINT) END AS money FROM diary""",
}
