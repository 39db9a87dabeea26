"""Load the model tables, verify them, and write every analysis.

    spark-submit patronage/job.py --source csv --input <folder> --output <folder>

The tables are parsed once and landed as Parquet. The load gate then checks row counts, NULLs, keys
and foreign keys; if a row breaks one, the job writes what it found and stops with exit status 1.
Order facts are joined and written once; the analyses scan that table. Landed tables and facts are
deleted at the end.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if __package__ in (None, ""):  # started as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronage.operators.facts import delivered, snapshot_date  # noqa: E402
from patronage.plans import cohorts, exports, kpis, quality, retention, revenue, segments  # noqa: E402
from patronage.operators.ranking import Ordered  # noqa: E402
from patronage.session import remove, shared_dir  # noqa: E402
from patronage.sources import files  # noqa: E402
from patronage.sources.model import ModelTables  # noqa: E402
from patronage.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, UNIQUE  # noqa: E402

Result = Callable[[ModelTables], DataFrame]

VIEWS: dict[str, Result] = {
    "v_cohort_retention": lambda m: cohorts.cohort_retention_indexed(m.orders, m.customers),
    "v_customer_segments": lambda m: segments.customer_segments(m.customers, m.facts, m.orders),
    "v_monthly_kpis": lambda m: kpis.monthly_kpis(m.customers, m.facts),
}


def _all_customers(m: ModelTables) -> DataFrame:
    return exports.customer_facts_all(m.customers, m.orders)


def _bands(m: ModelTables) -> DataFrame:
    return segments.discount_ltv_repeat(m.facts, snapshot_date(delivered(m.orders)))


def _spenders(m: ModelTables) -> Ordered:
    return revenue.by_spend(m.orders)


RESULTS: dict[str, Result] = {
    "cohort_retention": lambda m: cohorts.cohort_retention(m.orders, m.customers),
    "delay_churn": lambda m: retention.delay_retention_gap(m.facts),
    "delay_churn_strict": lambda m: retention.delay_retention_strict(retention.delay_outcomes_strict(m.facts)),
    "delay_significance": lambda m: retention.delay_significance(retention.delay_outcomes_strict(m.facts)),
    "rfm_segments": lambda m: segments.rfm_scores(m.orders).orderBy(F.desc("rfm_total"), "customer_id"),
    "discount_ltv": lambda m: segments.discount_ltv(m.facts, snapshot_date(m.orders)),
    "revenue_pareto": lambda m: revenue.revenue_pareto(_spenders(m)),
    "customer_facts": lambda m: exports.customer_facts(m.facts).orderBy("customer_id"),
    "customer_facts_all": lambda m: _all_customers(m).orderBy("customer_id"),
    "retention_summary": lambda m: retention.retention_summary(retention.retention_flags_strict(m.orders)),
    "rfm_summary": lambda m: segments.rfm_summary(segments.customer_segment(m.orders)),
    "segment_avg_frequency": lambda m: segments.segment_avg_frequency(segments.customer_segment(m.orders)),
    "discount_ltv_repeat": _bands,
    "heavy_vs_light_gap": lambda m: segments.heavy_vs_light_gap(_bands(m)),
    "monthly_gmv": lambda m: revenue.monthly_gmv(m.orders),
    "cohort_matrix": lambda m: cohorts.cohort_matrix(cohorts.cohort_retention(m.orders, m.customers)),
    "month1_average": lambda m: cohorts.month1_average(m.orders, m.customers, mask=True),
    "concentration": lambda m: revenue.concentration(_spenders(m)),
    "lorenz_curve": lambda m: revenue.lorenz_curve(_spenders(m)),
    "key_accounts": lambda m: revenue.key_accounts(_spenders(m)),
    "revenue_at_risk": lambda m: revenue.revenue_at_risk(_spenders(m)),
    "one_time_share": lambda m: kpis.one_time_share(m.customers, m.orders),
    "no_delivered_order": lambda m: kpis.no_delivered_order(m.customers, m.orders),
    "avg_delivery_delay": lambda m: kpis.avg_delivery_delay(m.facts),
    "discount_rate": lambda m: kpis.discount_rate(m.facts),
    "customer_funnel": lambda m: kpis.customer_funnel(m.customers, retention.retention_flags_strict(m.orders)),
    "filtered_kpis": lambda m: exports.filtered_kpis(_all_customers(m), snapshot_date(m.orders)),
}

KEYS = (*PRIMARY_KEYS.items(), *UNIQUE)


def verify(source: ModelTables, loaded: ModelTables) -> DataFrame:
    """The load gate over what was read and what was landed. Schemas name the columns that may not be NULL."""
    required = {name: [f.name for f in schema if not f.nullable] for name, schema in SCHEMAS.items()}
    return quality.load_gate(source.tables(), loaded.tables(), required, KEYS, FOREIGN_KEYS)


def run(spark: SparkSession, source: str, folder: str, output: str, sink: str = "parquet") -> bool:
    """True if every constraint of the load holds and every result is written under ``output``."""
    write = {"csv": files.write_csv, "parquet": files.write_parquet}[sink]
    scratch = f"{shared_dir(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    try:
        given = ModelTables.read(spark, folder, source)
        model = ModelTables(spark=spark, **files.land(given.tables(), f"{scratch}/landed"))
        write(quality.row_counts(model.tables()), f"{output}/row_counts")
        files.write_parquet(verify(given, model), f"{scratch}/load_checks")
        checked = spark.read.parquet(f"{scratch}/load_checks")
        write(checked.coalesce(1), f"{output}/load_checks")  # a few dozen rows
        if not checked.filter("status <> 'OK'").isEmpty():
            return False
        model = model.with_written_facts(f"{scratch}/order-facts")
        for name, build in {**VIEWS, **RESULTS}.items():
            result = build(model)
            write(result, f"{output}/{name}")
            if name in VIEWS and sink == "parquet":
                spark.read.schema(result.schema).parquet(f"{output}/{name}").createOrReplaceTempView(name)
    finally:
        remove(spark, scratch)
    return True


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--source", choices=("csv", "parquet"), default="parquet")
    parser.add_argument("--sink", choices=("csv", "parquet"), default="parquet")
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("patronage").getOrCreate()
    return 0 if run(spark, chosen.source, chosen.input, chosen.output, chosen.sink) else 1


if __name__ == "__main__":
    sys.exit(main())
