"""Shared parts of the checking SQL: the model over the test tables, and exact rounding."""

from __future__ import annotations

MODEL = """
WITH parcel AS (
    SELECT l_orderkey AS oid, max(l_quantity) AS top_qty, max(l_discount) AS top_disc, max(l_linenumber) AS top_line
    FROM lineitem GROUP BY ALL
),
fact AS (
    SELECT o_orderkey AS oid, o_custkey AS cid, CAST(o_orderdate AS DATE) AS d,
           CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Refunded' ELSE 'Cancelled' END AS status,
           CAST(o_totalprice AS DECIMAL(12,2)) AS net, CAST(100 * CAST(o_totalprice AS DECIMAL(12,2)) AS BIGINT) AS cents,
           o_orderpriority AS pay, o_orderkey % 24 AS hr,
           CAST(top_qty AS BIGINT) AS delay, coalesce(top_disc >= 0.09, FALSE) AS disc
    FROM orders LEFT JOIN parcel ON oid = o_orderkey
),
good AS (SELECT * FROM fact WHERE status = 'Delivered'),
person AS (
    SELECT c_custkey AS cid, n_name AS city, c_mktsegment AS channel,
           (SELECT min(f.d) FROM fact f WHERE f.cid = c_custkey) AS signup
    FROM customer JOIN nation ON n_nationkey = c_nationkey
)"""

# Per customer with a delivered order: the sorted list of its order dates and derived flags.
HISTORY = MODEL + """,
diary AS (
    SELECT cid, list(d ORDER BY d, oid) AS ds, count(*) AS n, sum(cents) AS cents, sum(disc::INT) AS nd,
           list(delay ORDER BY d, oid)[1] AS delay1, list(oid ORDER BY d, oid)[1] AS oid1
    FROM good GROUP BY cid
),
flag AS (
    SELECT *, ds[1] AS d1, ds[n] AS dn,
           coalesce(date_diff('day', ds[1], ds[2]) <= 90, FALSE) AS gap,
           EXISTS (SELECT 1 FROM good g WHERE g.cid = diary.cid AND g.d > ds[1] AND g.d <= ds[1] + 90) AS strict
    FROM diary
),
edge AS (SELECT max(d) AS d_all, max(d) FILTER (status = 'Delivered') AS d_good FROM fact)"""


def rounded(num: str, den: str, digits: int, scale: int = 1) -> str:
    """Half-up rounding of scale * num / den on whole numbers, as double."""
    unit = 10**digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"CAST(({2 * unit * scale} * {n} + {d}) // (2 * {d}) AS DOUBLE) / {unit}.0::DOUBLE"


def share(num: str, den: str) -> str:
    return f"100.0::DOUBLE * CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"


def delay_label(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 50 THEN '50+ min' WHEN {x} >= 35 THEN '35-50 min' "
        f"WHEN {x} >= 20 THEN '20-35 min' WHEN {x} >= 10 THEN '10-20 min' ELSE '0-10 min' END"
    )


def delay_place(x: str) -> str:
    return f"CAST(1 + ({x} >= 10)::INT + ({x} >= 20)::INT + ({x} >= 35)::INT + ({x} >= 50)::INT AS BIGINT)"


def band_label(nd: str, n: str) -> str:
    """Four bands, from whole counts."""
    return (
        f"CASE WHEN {nd} = 0 THEN 'Never' WHEN 100 * {nd} > 60 * {n} THEN 'Heavy' "
        f"WHEN 100 * {nd} > 30 * {n} THEN 'Moderate' ELSE 'Light' END"
    )


def band_place(nd: str, n: str) -> str:
    return f"CAST(1 + ({nd} > 0)::INT + (100 * {nd} > 30 * {n})::INT + (100 * {nd} > 60 * {n})::INT AS BIGINT)"


def segment_label(rec: str, freq: str) -> str:
    return (
        f"CASE WHEN {freq} >= 5 AND {rec} <= 30 THEN 'Champion' WHEN {freq} >= 3 AND {rec} <= 60 THEN 'Loyal' "
        f"WHEN {rec} > 180 THEN 'Lost' WHEN {rec} > 90 THEN 'About to Lapse' ELSE 'At Risk' END"
    )
