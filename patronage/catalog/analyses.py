"""The composite analyses as named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.facts import delivered, snapshot_date
from patronage.plans import cohorts, exports, kpis, retention, revenue, segments
from patronage.sources.binding import BoundTables as B

# A city and a channel of the test tables, for the filtered figures.
CHANNEL, CITY = "BUILDING", "NATION_2"


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """For averages of fractions, whose last bits depend on the order of addition."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def _all_customers(b: B) -> DataFrame:
    return exports.customer_facts_all(b.customer_dimension, b.orders)


def _bands(b: B) -> DataFrame:
    return segments.discount_ltv_repeat(b.facts, snapshot_date(delivered(b.orders)))


def _strict(b: B) -> DataFrame:
    return retention.retention_flags_strict(b.orders)


def _outcomes(b: B) -> DataFrame:
    return retention.delay_outcomes_strict(b.facts)


QUERIES: dict[str, Callable[[B], DataFrame]] = {
    "cohort_retention": lambda b: cohorts.cohort_retention(b.orders, b.customers),
    "cohort_retention_indexed": lambda b: cohorts.cohort_retention_indexed(b.orders, b.customers),
    "cohort_matrix": lambda b: cohorts.cohort_matrix(cohorts.cohort_retention(b.orders, b.customers)),
    "month1_average": lambda b: _rounded(cohorts.month1_average(b.orders, b.customers)),
    "month1_average_masked": lambda b: _rounded(cohorts.month1_average(b.orders, b.customers, mask=True)),
    "delay_retention_gap": lambda b: retention.delay_retention_gap(b.facts),
    "delay_retention_strict": lambda b: retention.delay_retention_strict(_outcomes(b)),
    "delay_significance": lambda b: _rounded(retention.delay_significance(_outcomes(b))),
    "delay_overall_average": lambda b: retention.delay_overall_average(retention.delay_retention_gap(b.facts)),
    "retention_flags_strict": _strict,
    "retention_summary": lambda b: retention.retention_summary(_strict(b)),
    "rfm_scores": lambda b: segments.rfm_scores(b.orders),
    "rfm_summary": lambda b: segments.rfm_summary(segments.customer_segment(b.orders)),
    "segment_avg_frequency": lambda b: segments.segment_avg_frequency(segments.customer_segment(b.orders)),
    "customer_segments": lambda b: segments.customer_segments(b.customers, b.facts, b.orders),
    "discount_ltv": lambda b: segments.discount_ltv(b.facts, snapshot_date(b.orders)),
    "discount_ltv_repeat": _bands,
    "heavy_vs_light_gap": lambda b: _rounded(segments.heavy_vs_light_gap(_bands(b))),
    "revenue_pareto_detail": lambda b: revenue.pareto_detail(revenue.by_spend(b.orders)),
    "revenue_pareto_milestones": lambda b: revenue.pareto_milestones(revenue.by_spend(b.orders)),
    "revenue_pareto": lambda b: revenue.revenue_pareto(revenue.by_spend(b.orders)),
    "concentration": lambda b: revenue.concentration(revenue.by_spend(b.orders)),
    "lorenz_curve": lambda b: revenue.lorenz_curve(revenue.by_spend(b.orders)),
    "monthly_kpis": lambda b: kpis.monthly_kpis(b.customers, b.facts),
    "monthly_gmv": lambda b: revenue.monthly_gmv(b.orders),
    "one_time_share": lambda b: kpis.one_time_share(b.customer_dimension, b.orders),
    "no_delivered_order": lambda b: kpis.no_delivered_order(b.customer_dimension, b.orders),
    "never_ordered": lambda b: kpis.never_ordered(b.customer_dimension, b.orders).select("customer_id"),
    "avg_delivery_delay": lambda b: kpis.avg_delivery_delay(b.facts),
    "discount_rate": lambda b: kpis.discount_rate(b.facts),
    "customer_funnel": lambda b: kpis.customer_funnel(b.customer_dimension, _strict(b)),
    "customer_facts": lambda b: exports.customer_facts(b.facts),
    "customer_facts_all": _all_customers,
    "filtered_kpis": lambda b: exports.filtered_kpis(_all_customers(b), snapshot_date(b.orders), channel=CHANNEL),
    "filtered_kpis_unfiltered": lambda b: exports.filtered_kpis(_all_customers(b), snapshot_date(b.orders), city="all"),
    "key_accounts": lambda b: revenue.key_accounts(revenue.by_spend(b.orders)),
    "revenue_at_risk": lambda b: revenue.revenue_at_risk(revenue.by_spend(b.orders)),
    "foregone_ltv": lambda b: _rounded(segments.foregone_ltv(_bands(b)), 4),
}
