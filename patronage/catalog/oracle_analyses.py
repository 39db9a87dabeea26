"""Checking SQL of :mod:`patronage.catalog.analyses`, written independently of the operators."""

from __future__ import annotations

from patronage.catalog.analyses import CHANNEL
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

_COHORT = HISTORY + f""",
member AS (SELECT cid, strftime(signup, '%Y-%m') AS cohort, year(signup) * 12 + month(signup) AS ci FROM person SEMI JOIN diary USING (cid)),
hit AS (
    SELECT DISTINCT cid, (year(g.d) - year(f.d1)) * 12 + month(g.d) - month(f.d1) AS k
    FROM good g JOIN flag f USING (cid)
),
grid AS (
    SELECT cohort, ci, k, count(*) AS size,
           count(*) FILTER (EXISTS (SELECT 1 FROM hit WHERE hit.cid = member.cid AND hit.k = o.k)) AS active
    FROM member, (SELECT unnest([0, 1, 2, 3, 6, 9, 12]) AS k) o
    GROUP BY cohort, ci, k
),
cell AS (
    SELECT cohort, k, size, CASE WHEN ci + k <= (SELECT max(ci) FROM member) THEN active END AS active,
           CASE WHEN ci + k <= (SELECT max(ci) FROM member) THEN {rounded('active', 'size', 2, 100)} END AS pct
    FROM grid
)"""

_MONTH1 = _COHORT + """
SELECT round(avg(100.0::DOUBLE * active / size), 6) AS month1_avg_pct FROM grid WHERE k = 1"""

_GAP = HISTORY + """,
diary2 AS (
    SELECT cid, list(d ORDER BY d, oid) AS ds, list(delay ORDER BY d, oid)[1] AS delay1
    FROM good WHERE delay IS NOT NULL GROUP BY cid
),
known AS (
    SELECT delay1, coalesce(date_diff('day', ds[1], ds[2]) <= 90, FALSE) AS kept
    FROM diary2
    WHERE len(ds) > 1 OR date_diff('day', ds[1], (SELECT max(d) FROM good WHERE delay IS NOT NULL)) >= 90
)"""

_KNOWN = HISTORY + """,
known AS (SELECT f.* FROM flag f, edge WHERE n > 1 OR date_diff('day', d1, d_good) >= 90)"""

_SEGMENT = HISTORY + f""",
seg AS (
    SELECT cid, n, cents, {segment_label("date_diff('day', dn, d_good)", 'n')} AS segment FROM flag, edge
)"""

_TRIO = _KNOWN + """,
trio AS (
    SELECT CASE WHEN nd = 0 THEN 'Never' WHEN 100 * nd > 60 * n THEN 'Heavy' ELSE 'Light/Moderate' END AS grp,
           CASE WHEN nd = 0 THEN 1 WHEN 100 * nd > 60 * n THEN 3 ELSE 2 END::BIGINT AS place,
           count(*) AS c, sum(cents) AS cents, sum(strict::INT) AS kept
    FROM known WHERE n >= 2 GROUP BY ALL
),
ltv AS (SELECT *, CAST(cents / 100.0 AS DECIMAL(38,2))::DOUBLE / c AS avg_ltv FROM trio)"""

_PARETO = HISTORY + """,
rk AS (SELECT cid, cents, row_number() OVER (ORDER BY cents DESC, cid) AS r FROM diary),
cum AS (
    SELECT cid, cents, r, sum(cents) OVER (ORDER BY r) AS cs,
           (SELECT count(*) FROM rk) AS n, (SELECT sum(cents) FROM rk) AS total
    FROM rk
),
goal AS (
    SELECT t, min(r) AS r, min(cs) AS cs, any_value(n) AS n, any_value(total) AS total
    FROM cum JOIN (VALUES (50), (65), (80)) v(t) ON 100 * cs >= t * total GROUP BY t
)"""

_DETAIL = f"""SELECT r AS rnk, cid AS customer_id, {rounded('r', 'n', 3, 100)} AS cumulative_customer_pct,
       CAST(cs AS DOUBLE) / 100 AS cumulative_gmv, {rounded('cs', 'total', 3, 100)} AS cumulative_gmv_pct
FROM cum"""

_GOALS = f"""SELECT 'Top ' || CAST(CAST({rounded('r', 'n', 2, 100)} AS DECIMAL(10,2)) AS VARCHAR)
           || '% of customers drive ' || t || '% of GMV' AS milestone_label,
       {rounded('r', 'n', 3, 100)} AS cumulative_customer_pct, t::DOUBLE AS cumulative_gmv_pct
FROM goal"""

_ALL = HISTORY + """,
everyone AS (
    SELECT p.cid, city, channel, coalesce(n, 0) AS n, coalesce(cents, 0) AS cents, d1, coalesce(strict, FALSE) AS strict
    FROM person p LEFT JOIN flag USING (cid)
)"""


def _kpi(where: str) -> str:
    known = f"n > 0 AND {where} AND (n > 1 OR date_diff('day', d1, d_all) >= 90)"
    return _ALL + f"""
SELECT count(*) FILTER (n > 0) AS ordering_customers, CAST(sum(cents) AS DOUBLE) / 100 AS total_gmv,
       count(*) FILTER ({where}) AS filtered_customers,
       count(*) FILTER ({known}) AS eligible_customers,
       count(*) FILTER ({known} AND strict) AS retained_customers,
       {share(f'count(*) FILTER ({known} AND strict)', f'count(*) FILTER ({known})')} AS retention_pct
FROM everyone, edge"""


ORACLE: dict[str, str] = {
    "cohort_retention": _COHORT + """
SELECT cohort AS cohort_month, k::BIGINT AS months_since_first, active AS customer_count, pct AS retention_pct FROM cell""",
    "cohort_retention_indexed": _COHORT + f"""
SELECT cohort AS cohort_month, k::BIGINT AS months_since_first, size AS cohort_size, active AS customer_count,
       pct AS retention_pct,
       CASE WHEN pct IS NOT NULL AND sum(pct) OVER p > 0 THEN {rounded('round(100 * pct) * count(pct) OVER p', 'round(100 * sum(pct) OVER p)', 3)} END
           AS retention_index
FROM cell WINDOW p AS (PARTITION BY k)""",
    "cohort_matrix": _COHORT + """
SELECT cohort AS cohort_month, """ + ", ".join(f"max(pct) FILTER (k = {k}) AS month_{k}" for k in (0, 1, 2, 3, 6, 9, 12)) + """
FROM cell GROUP BY cohort""",
    "month1_average": _MONTH1,
    "month1_average_masked": _MONTH1 + " AND ci + 1 <= (SELECT max(ci) FROM member)",
    "delay_retention_gap": _GAP + f"""
SELECT {delay_label('delay1')} AS delay_bucket, {delay_place('delay1')} AS bucket_order, count(*) AS customer_count,
       count(*) FILTER (kept) AS retained_count, {rounded('count(*) FILTER (kept)', 'count(*)', 2, 100)} AS retention_pct
FROM known GROUP BY ALL""",
    "delay_retention_strict": _KNOWN + f"""
SELECT label AS delay_bucket, place::BIGINT AS bucket_order, c AS customer_count, pct AS retention_pct
FROM (VALUES ('0-10 min', 1), ('10-20 min', 2), ('20-35 min', 3), ('35-50 min', 4), ('50+ min', 5)) v(label, place)
LEFT JOIN (SELECT {delay_label('delay1')} AS b, count(*) AS c, {share('count(*) FILTER (strict)', 'count(*)')} AS pct
           FROM known WHERE delay1 IS NOT NULL GROUP BY b) ON b = label""",
    "delay_significance": _KNOWN + f""",
obs AS (SELECT {delay_place('delay1')} AS b, strict AS s, count(*)::DOUBLE AS o FROM known WHERE delay1 IS NOT NULL GROUP BY ALL),
full_grid AS (
    SELECT rb.b, cs.s, coalesce(obs.o, 0) AS o, rb.rt * cs.ct / (SELECT sum(o) FROM obs) AS e
    FROM (SELECT b, sum(o) AS rt FROM obs GROUP BY b) rb CROSS JOIN (SELECT s, sum(o) AS ct FROM obs GROUP BY s) cs
    LEFT JOIN obs ON obs.b = rb.b AND obs.s = cs.s
),
x AS (SELECT sum((o - e) * (o - e) / e) AS x, ((count(DISTINCT b) - 1) * (count(DISTINCT s) - 1))::BIGINT AS dof FROM full_grid)
SELECT round(x, 6) AS statistic, dof, round(exp(-x / 2) * (1 + x / 2), 6) AS p_value FROM x""",
    "delay_overall_average": _GAP + f"""
SELECT {share('count(*) FILTER (kept)', 'count(*)')} AS retention_pct FROM known""",
    "retention_flags_strict": HISTORY + """
SELECT cid AS customer_id, strict::INT::BIGINT AS retained_raw,
       (n > 1 OR date_diff('day', d1, d_good) >= 90)::INT::BIGINT AS eligible,
       CASE WHEN n > 1 OR date_diff('day', d1, d_good) >= 90 THEN strict::INT::BIGINT END AS retained
FROM flag, edge""",
    "retention_summary": _KNOWN + f"""
SELECT count(*) FILTER (strict) AS retained_customers, count(*) AS eligible_customers,
       {share('count(*) FILTER (strict)', 'count(*)')} AS retention_pct,
       100.0::DOUBLE - {share('count(*) FILTER (strict)', 'count(*)')} AS churn_pct
FROM known""",
    "rfm_scores": HISTORY + f""",
scored AS (
    SELECT cid, n, cents, date_diff('day', dn, d_all) AS rec,
           ntile(4) OVER (ORDER BY dn, cid) AS r, ntile(4) OVER (ORDER BY n, cid) AS f, ntile(4) OVER (ORDER BY cents, cid) AS m
    FROM flag, edge
)
SELECT cid AS customer_id, r AS r_score, f AS f_score, m AS m_score, r + f + m AS rfm_total,
       {segment_label('rec', 'n')} AS segment, CAST(cents AS DOUBLE) / 100 AS total_spend
FROM scored""",
    "rfm_summary": _SEGMENT + f"""
SELECT label AS segment, place::BIGINT AS segment_order, customers, gmv, pct_customers, pct_gmv, avg_frequency
FROM (VALUES ('Champion', 1), ('Loyal', 2), ('At Risk', 3), ('About to Lapse', 4), ('Lost', 5)) v(label, place)
LEFT JOIN (
    SELECT segment, count(*) AS customers, CAST(sum(cents) AS DOUBLE) / 100 AS gmv,
           {share('count(*)', '(SELECT count(*) FROM seg)')} AS pct_customers,
           100.0::DOUBLE * (CAST(sum(cents) AS DOUBLE) / 100) / (SELECT CAST(sum(cents) AS DOUBLE) / 100 FROM seg) AS pct_gmv,
           CAST(sum(n) AS DOUBLE) / count(*) AS avg_frequency
    FROM seg GROUP BY segment) s ON s.segment = label""",
    "segment_avg_frequency": _SEGMENT + """
SELECT segment, CAST(sum(n) AS DOUBLE) / count(*) AS avg_frequency FROM seg GROUP BY segment""",
    "customer_segments": HISTORY + f""",
lag AS (SELECT cid, CAST(sum(delay) AS DOUBLE) / count(delay) AS avg_delay FROM good WHERE delay IS NOT NULL GROUP BY cid)
SELECT cid AS customer_id, city, channel AS acquisition_channel, strftime(signup, '%Y-%m') AS cohort_month,
       signup::VARCHAR AS signup_date, n AS total_orders, CAST(cents AS DOUBLE) / 100 AS total_spend,
       CAST(cents AS DOUBLE) / 100 / n AS avg_order_value, d1::VARCHAR AS first_order_date, dn::VARCHAR AS last_order_date,
       date_diff('day', dn, d_all) AS days_since_last_order, avg_delay AS avg_delivery_delay,
       {rounded('nd', 'n', 2, 100)} AS discount_pct_of_orders, {band_label('nd', 'n')} AS discount_group,
       {segment_label("date_diff('day', dn, d_all)", 'n')} AS rfm_segment,
       (date_diff('day', dn, d_all) > 90)::INT::BIGINT AS is_churned
FROM person JOIN flag USING (cid) JOIN lag USING (cid), edge""",
    "discount_ltv": HISTORY + f""",
lag AS (SELECT cid, CAST(CAST(sum(delay) AS DOUBLE) / count(delay) AS DECIMAL(24,12)) AS avg_delay FROM good WHERE delay IS NOT NULL GROUP BY cid),
k AS (SELECT * FROM flag JOIN lag USING (cid), edge WHERE n > 1 OR date_diff('day', d1, d_all) >= 90)
SELECT {band_label('nd', 'n')} AS discount_group, {band_place('nd', 'n')} AS group_order, count(*) AS customer_count,
       {rounded('sum(n)', 'count(*)', 2)} AS avg_total_orders,
       {rounded('sum(cents)', '(100 * count(*))', 2)} AS avg_net_spend,
       {rounded('count(*) FILTER (gap)', 'count(*)', 2, 100)} AS avg_90day_retention_pct,
       {rounded('(sum(avg_delay)::DECIMAL(24,12) * 1000000)', '(1000000 * count(*))', 2)} AS avg_delivery_delay
FROM k GROUP BY ALL""",
    "discount_ltv_repeat": _TRIO + f"""
SELECT grp AS discount_group, place AS group_order, c AS customers, avg_ltv, {share('kept', 'c')} AS retention_pct FROM ltv""",
    "heavy_vs_light_gap": _TRIO + """
SELECT round((max(avg_ltv) FILTER (place = 3) / max(avg_ltv) FILTER (place = 2) - 1) * 100, 6) AS heavy_vs_light_pct FROM ltv""",
    "revenue_pareto_detail": _PARETO + _DETAIL,
    "revenue_pareto_milestones": _PARETO + _GOALS,
    "revenue_pareto": _PARETO + f""",
shown AS ({_DETAIL}), marks AS ({_GOALS})
SELECT 'detail' AS row_type, NULL::VARCHAR AS milestone_label, rnk, customer_id, cumulative_customer_pct, cumulative_gmv,
       cumulative_gmv_pct FROM shown
UNION ALL
SELECT 'milestone', milestone_label, NULL, NULL, cumulative_customer_pct, NULL, cumulative_gmv_pct FROM marks""",
    "concentration": _PARETO + f"""
SELECT t::BIGINT AS target, {share('r', 'n')} AS top_customers_pct, CAST(total AS DOUBLE) / 100 AS total_gmv FROM goal WHERE t <> 65""",
    "lorenz_curve": _PARETO + f"""
SELECT r AS rnk, {share('r', 'n')} AS customers_pct,
       100.0::DOUBLE * (CAST(cs AS DOUBLE) / 100) / (CAST(total AS DOUBLE) / 100) AS gmv_pct FROM cum""",
    "monthly_kpis": MODEL + f""",
joined AS (SELECT strftime(signup, '%Y-%m') AS m, count(*) AS c FROM person GROUP BY m),
placed AS (SELECT strftime(d, '%Y-%m') AS m, * FROM good),
late AS (
    SELECT m, {rounded('sum(delay)', 'count(*)', 2)} AS avg_delay, {rounded('count(*) FILTER (delay < 20)', 'count(*)', 2, 100)} AS on_time
    FROM placed WHERE delay IS NOT NULL GROUP BY m
)
SELECT p.m AS order_month, coalesce(any_value(joined.c), 0) AS new_customers, count(*) AS total_orders,
       CAST(sum(cents) AS DOUBLE) / 100 AS total_gmv, {rounded('sum(cents)', '(100 * count(*))', 2)} AS avg_order_value,
       {rounded('count(*) FILTER (disc)', 'count(*)', 2, 100)} AS discount_rate_pct,
       any_value(avg_delay) AS avg_delivery_delay, any_value(on_time) AS on_time_delivery_pct
FROM placed p LEFT JOIN joined ON joined.m = p.m LEFT JOIN late ON late.m = p.m GROUP BY p.m""",
    "monthly_gmv": MODEL + """
SELECT strftime(d, '%Y-%m') AS order_month, CAST(sum(cents) AS DOUBLE) / 100 AS gmv FROM good GROUP BY ALL""",
    "one_time_share": HISTORY + f"""
SELECT count(*) FILTER (n = 1) AS one_time_customers, count(*) AS ordering_customers,
       {share('count(*) FILTER (n = 1)', 'count(*)')} AS one_time_pct_orderers,
       {share('count(*) FILTER (n = 1)', '(SELECT count(*) FROM person)')} AS one_time_pct_all FROM diary""",
    "no_delivered_order": MODEL + f"""
SELECT count(*) AS customers, {share('count(*)', '(SELECT count(*) FROM customer)')} AS pct_of_all
FROM customer WHERE c_custkey NOT IN (SELECT cid FROM good)""",
    "never_ordered": "SELECT c_custkey AS customer_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "avg_delivery_delay": MODEL + """
SELECT CAST(sum(delay) AS DOUBLE) / count(delay) AS avg_delivery_delay FROM good""",
    "discount_rate": MODEL + f"""
SELECT {share('count(*) FILTER (disc)', 'count(*)')} AS discount_rate_pct FROM good""",
    "customer_funnel": _KNOWN + """
SELECT 1::BIGINT AS step, 'Signed Up' AS stage, count(*) AS customers FROM customer
UNION ALL SELECT 2, '1st Order', count(*) FROM diary
UNION ALL SELECT 3, 'Repeat (90d)', count(*) FROM known WHERE strict""",
    "customer_facts": MODEL + f""",
seen AS (
    SELECT cid, list(d ORDER BY d, oid) AS ds, list(delay ORDER BY d, oid)[1] AS delay1, list(oid ORDER BY d, oid)[1] AS oid1,
           count(*) AS n, sum(cents) AS cents
    FROM good WHERE delay IS NOT NULL GROUP BY cid
)
SELECT cid AS customer_id, ds[1]::VARCHAR AS "FirstOrderDate", ds[n]::VARCHAR AS "LastOrderDate", n AS "OrderCount",
       CAST(cents AS DOUBLE) / 100 AS "TotalLTV",
       EXISTS (SELECT 1 FROM good g WHERE g.cid = seen.cid AND delay IS NOT NULL AND g.d > ds[1] AND g.d <= ds[1] + 90)::INT::BIGINT
           AS "Retained90d",
       oid1 AS "FirstOrderID", delay1::DOUBLE AS "FirstOrderDelay", {delay_label('delay1')} AS "DelayBucket"
FROM seen""",
    "customer_facts_all": _ALL + """
SELECT cid AS customer_id, city, channel AS acquisition_channel, n AS order_count, CAST(cents AS DOUBLE) / 100 AS net_gmv,
       d1::VARCHAR AS first_order_date, strict::INT::BIGINT AS retained_90d_raw FROM everyone""",
    "filtered_kpis": _kpi(f"channel = '{CHANNEL}'"),
    "filtered_kpis_unfiltered": _kpi("TRUE"),
    "key_accounts": _PARETO + """
SELECT r AS key_customers, CAST(cs AS DOUBLE) / 100 AS key_gmv, CAST(cs AS DOUBLE) / 100 / r AS key_avg_spend,
       CAST(total AS DOUBLE) / 100 / n AS base_avg_spend,
       (CAST(cs AS DOUBLE) / 100 / r) / (CAST(total AS DOUBLE) / 100 / n) AS multiple_of_base
FROM goal WHERE t = 50""",
    "revenue_at_risk": _PARETO + f"""
SELECT ({rounded('5 * g.r', '100', 0)})::BIGINT AS customers_lost, CAST(5 * g.cs AS DOUBLE) / 100 / 100 AS gmv_at_risk,
       (SELECT count(*) FROM (SELECT sum(cents) OVER (ORDER BY cents, cid DESC) AS up FROM diary) WHERE 100 * up <= 5 * g.cs)
           AS equal_bottom_customers
FROM goal g WHERE t = 50""",
    "foregone_ltv": _TRIO + """
SELECT max(c) FILTER (place = 3) AS heavy_customers,
       round(max(avg_ltv) FILTER (place = 2) - max(avg_ltv) FILTER (place = 3), 4) AS ltv_gap,
       round(max(c) FILTER (place = 3) * (max(avg_ltv) FILTER (place = 2) - max(avg_ltv) FILTER (place = 3)), 4) AS foregone_ltv
FROM ltv""",
}
