"""Buckets, bands, segment and status rules. Every rule is one CASE chain; the first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the analyses.
DELAY_EDGES = (10, 20, 35, 50)
DELAY_LABELS = ("0-10 min", "10-20 min", "20-35 min", "35-50 min", "50+ min")
DISCOUNT_EDGES = (0, 30, 60)
DISCOUNT_LABELS = ("Never", "Light", "Moderate", "Heavy")
REPEAT_DISCOUNT_EDGES = (0, 60)
REPEAT_DISCOUNT_LABELS = ("Never", "Light/Moderate", "Heavy")
SEGMENTS = ("Champion", "Loyal", "At Risk", "About to Lapse", "Lost")
STATUS_EDGES = (0, 15, 45)
STATUS_LABELS = ("On Time", "Slightly Late", "Late", "Very Late")


def _chain(value: Column, edges: Sequence, results: Sequence, closed_right: bool) -> Column:
    rule = None
    for edge, result in zip(edges, results):
        inside = value <= F.lit(edge) if closed_right else value < F.lit(edge)
        rule = F.when(inside, F.lit(result)) if rule is None else rule.when(inside, F.lit(result))
    return rule.when(value.isNotNull(), F.lit(results[-1]))


def left_closed(value: Column, edges: Sequence, labels: Sequence) -> Column:
    """Label of ``[edge, next edge)``; below the first edge is the first label; NULL stays NULL."""
    return _chain(value, edges, labels, closed_right=False)


def right_closed(value: Column, edges: Sequence, labels: Sequence) -> Column:
    """Label of ``(previous edge, edge]``; above the last edge is the last label."""
    return _chain(value, edges, labels, closed_right=True)


def left_closed_order(value: Column, edges: Sequence) -> Column:
    """1-based sort position of :func:`left_closed`."""
    return _chain(value, edges, range(1, len(edges) + 2), closed_right=False)


def right_closed_order(value: Column, edges: Sequence) -> Column:
    return _chain(value, edges, range(1, len(edges) + 2), closed_right=True)


def delay_bucket(delay: Column) -> Column:
    return left_closed(delay, DELAY_EDGES, DELAY_LABELS)


def delay_bucket_order(delay: Column) -> Column:
    return left_closed_order(delay, DELAY_EDGES)


def discount_band(share: Column) -> Column:
    """Never, Light, Moderate or Heavy from the percentage of orders with a discount.

    The edges are continuous: 30.5 is Moderate.
    """
    return right_closed(share, DISCOUNT_EDGES, DISCOUNT_LABELS)


def discount_band_order(share: Column) -> Column:
    return right_closed_order(share, DISCOUNT_EDGES)


def repeat_discount_band(share: Column) -> Column:
    return right_closed(share, REPEAT_DISCOUNT_EDGES, REPEAT_DISCOUNT_LABELS)


def repeat_discount_band_order(share: Column) -> Column:
    return right_closed_order(share, REPEAT_DISCOUNT_EDGES)


def segment(recency: Column, frequency: Column) -> Column:
    """Customer segment. A new customer with few orders lands in At Risk: rule order matters."""
    return (
        F.when((recency <= 30) & (frequency >= 5), F.lit("Champion"))
        .when((recency <= 60) & (frequency >= 3), F.lit("Loyal"))
        .when(recency <= 90, F.lit("At Risk"))
        .when(recency <= 180, F.lit("About to Lapse"))
        .otherwise(F.lit("Lost"))
    )


def churned(days_since_last: Column, limit: int = 90) -> Column:
    return F.when(days_since_last > limit, F.lit(1)).otherwise(F.lit(0))


def delivery_status(delay: Column) -> Column:
    return right_closed(delay, STATUS_EDGES, STATUS_LABELS)


def within_horizon(index: Column, offset: Column, horizon: Column, value: Column) -> Column:
    """The value, or NULL where month ``index + offset`` lies beyond the horizon."""
    return F.when(index + offset <= horizon, value)
