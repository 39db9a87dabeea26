"""Data quality and profiling. Each check returns rows; nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions import calendar, numeric
from patronage.operators.facts import customer_totals
from patronage.operators.ranking import value_histogram
from patronage.operators.relational import membership_flag
from patronage.plans.revenue import by_spend, top_fraction_share

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
#: A sketch of quantiles errs by at most one in so many ranks.
SKETCH = 10_000


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stacked(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    )


def reconcile_counts(source: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Expected and actual rows per table, OK or MISMATCH. A table missing on one side is a mismatch."""
    expected = row_counts(source).withColumnRenamed("n", "expected")
    actual = row_counts(loaded).withColumnRenamed("n", "actual")
    same = F.coalesce(F.col("expected") == F.col("actual"), F.lit(False))
    return expected.join(actual, "table_name", "full").select(
        "table_name", "expected", "actual", F.when(same, "OK").otherwise("MISMATCH").alias("status")
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is NULL or has no parent.

    The child is counted per key before the join, so a key that holds a third of the child rows
    crosses the network as one row per task.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphans"))


def foreign_keys(tables: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str]]) -> DataFrame:
    return _stacked(
        [
            orphans(tables[child], tables[parent], key).select(
                F.lit(f"{child}.{key} -> {parent}").alias("relation"), "orphans"
            )
            for child, key, parent in relations
        ]
    ).withColumn("status", F.when(F.col("orphans") == 0, "OK").otherwise("FAIL"))


def primary_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, surplus rows of a repeated key, NULL keys, and whether the key is unique."""

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        zero = F.lit(0).cast("bigint")
        return per_key.agg(
            F.coalesce(F.sum("_n"), zero).alias("n"),
            (F.coalesce(F.sum("_n"), zero) - F.count(F.lit(1))).alias("surplus"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n")).otherwise(zero)), zero).alias("nulls"),
        ).select(F.lit(f"{name}.{key}").alias("key_name"), "n", "surplus", "nulls")

    checked = _stacked([one(name, df, key) for name, (df, key) in tables.items()])
    return checked.withColumn("is_unique", F.col("surplus") == 0)


def null_counts(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """NULLs per table and column; one pass over each table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        cells = [F.struct(F.lit(f"{name}.{c}").alias("column_name"), numeric.or_zero(numeric.count_if(F.col(c).isNull())).cast("bigint").alias("nulls")) for c in columns[name]]
        return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("cell")).select("cell.*")

    return _stacked([one(name, tables[name]) for name in columns])


def load_gate(
    source: Mapping[str, DataFrame],
    loaded: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]],
    keys: Sequence[tuple[str, str]],
    relations: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Every constraint of the load as a row: what was checked, on what, how many rows break it, OK or FAIL.

    ``required`` lists columns that may not be NULL, ``keys`` pairs of table and unique column,
    ``relations`` child table, key and parent table.
    """
    counts = reconcile_counts(source, loaded).select(
        F.lit("row count").alias("check"),
        F.col("table_name").alias("subject"),
        F.coalesce(F.abs(F.col("expected") - F.col("actual")), F.lit(1)).cast("bigint").alias("faults"),
    )
    nulls = null_counts(loaded, required).select(F.lit("not null").alias("check"), F.col("column_name").alias("subject"), F.col("nulls").alias("faults"))
    unique = _stacked([primary_keys({table: (loaded[table], key)}) for table, key in keys]).select(
        F.lit("unique").alias("check"), F.col("key_name").alias("subject"), F.col("surplus").cast("bigint").alias("faults")
    )
    related = foreign_keys(loaded, relations).select(
        F.lit("foreign key").alias("check"), F.col("relation").alias("subject"), F.col("orphans").alias("faults")
    )
    return _stacked([counts, nulls, unique, related]).withColumn("status", F.when(F.col("faults") == 0, "OK").otherwise("FAIL"))


def order_coverage(orders: DataFrame, items: DataFrame, delivery: DataFrame) -> DataFrame:
    """Does every order have at least one item and exactly one delivery event?"""
    per_item = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_items"))
    per_event = delivery.groupBy("order_id").agg(F.count(F.lit(1)).alias("_events"))
    counted = (
        orders.select("order_id")
        .join(per_item, "order_id", "left")
        .join(per_event, "order_id", "left")
        .select(numeric.or_zero(F.col("_items")).alias("_items"), numeric.or_zero(F.col("_events")).alias("_events"))
    )
    return counted.agg(
        F.count(F.lit(1)).alias("orders"),
        numeric.count_if(F.col("_items") == 0).alias("orders_without_item"),
        numeric.count_if(F.col("_events") == 0).alias("orders_without_delivery"),
        numeric.count_if(F.col("_events") > 1).alias("orders_with_several_deliveries"),
        (F.min("_items") >= 1).alias("every_order_has_item"),
        ((F.min("_events") == 1) & (F.max("_events") == 1)).alias("exactly_one_delivery"),
    )


def lifecycle_shares(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One-order share of orderers, share with at most one order of all customers, highest count. All statuses."""
    per_customer = customer_totals(orders.select("customer_id"))
    known = customers.select("customer_id", F.lit(True).alias("_known"))
    # both sides have one row per customer
    everyone = per_customer.join(known, "customer_id", "full")
    at_most_one = F.col("_known").isNotNull() & (numeric.or_zero(F.col("orders")) <= 1)
    return everyone.agg(
        numeric.pct(numeric.count_if(F.col("orders") == 1), F.count("orders")).alias("one_order_pct"),
        numeric.pct(numeric.count_if(at_most_one), F.count("_known")).alias("at_most_one_order_pct"),
        F.max("orders").alias("max_orders"),
    )


def discounted_share(orders: DataFrame, discounts: DataFrame) -> DataFrame:
    """Orders with a discount, of all orders whatever their status."""
    marked = membership_flag(orders, discounts, "order_id", "_discounted")
    n = numeric.count_if(F.col("_discounted"))
    return marked.agg(n.alias("discounted_orders"), numeric.pct(n, F.count(F.lit(1))).alias("discounted_pct"))


def weekend_uplift(orders: DataFrame, weeks: int = 104) -> DataFrame:
    """Orders per weekend day against orders per weekday, over a window of whole weeks."""
    weekend = F.col("_weekend").cast("double") / (2 * weeks)
    weekday = F.col("_weekday").cast("double") / (5 * weeks)
    split = calendar.is_weekend(F.col("order_date")) == 1
    counted = orders.agg(
        numeric.count_if(split).alias("_weekend"), numeric.count_if(~split).alias("_weekday")
    )
    return counted.select(
        F.col("_weekend").alias("weekend_orders"),
        F.col("_weekday").alias("weekday_orders"),
        ((weekend / F.nullif(weekday, F.lit(0.0)) - 1) * 100).alias("uplift_pct"),
    )


def season_uplift(orders: DataFrame, months: Sequence[int] = (7, 8, 9), window_days: int = 730) -> DataFrame:
    """Orders per month in the season against the other months, normalised by the window length."""
    span = window_days / 30.44
    part = len(months) / 12
    inside = F.col("season_orders").cast("double") / (part * span)
    outside = F.col("other_orders").cast("double") / ((1 - part) * span)
    in_season = calendar.in_months(F.col("order_date"), list(months))
    return orders.agg(
        numeric.count_if(in_season).alias("season_orders"), numeric.count_if(~in_season).alias("other_orders")
    ).withColumn("uplift_pct", (inside / F.nullif(outside, F.lit(0.0)) - 1) * 100)


def top_share(orders: DataFrame, fraction: float = 0.15) -> DataFrame:
    """GMV share of the top customers, over orders of all statuses."""
    return top_fraction_share(by_spend(orders, status_filter=False), fraction)


def delay_by_order_count(facts: DataFrame) -> DataFrame:
    """Mean of customer mean delays: customers with one order against the rest. All statuses."""
    totals = customer_totals(facts.select("customer_id", "delivery_delay_min")).filter(F.col("delay_orders") > 0)
    own = numeric.ratio(F.col("delay_sum"), F.col("delay_orders")).cast("decimal(24,12)")
    single = F.col("orders") == 1
    return totals.agg(
        numeric.ratio(F.sum(F.when(single, own)), F.count(F.when(single, own))).alias("avg_delay_one_order"),
        numeric.ratio(F.sum(F.when(~single, own)), F.count(F.when(~single, own))).alias("avg_delay_several"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample deviation, min, quartiles (linear), max. Columns are numeric.

    Values keep their precision: whole numbers and decimals meet in a decimal of the largest scale,
    and as soon as one column is floating, all are doubles. Two passes over the rows, for all columns
    together, without a sort of the rows: the first, made at once, gives count, mean, deviation and bounds and, from sketches of
    bounded size, two values around each quartile; the second counts what lies below them exactly. Only
    values between them are counted one by one, and the quartile is the one at its exact rank.
    """
    kinds = [df.schema[c].dataType for c in columns]
    floating = any(isinstance(k, (T.DoubleType, T.FloatType)) for k in kinds)
    scale = max((k.scale for k in kinds if isinstance(k, T.DecimalType)), default=0)
    common = "double" if floating else f"decimal(38,{scale})"
    moments = df.agg(
        *[
            F.struct(
                F.lit(c).alias("metric"),
                F.count(c).alias("n"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast(common)).alias("min"),
                F.max(F.col(c).cast(common)).alias("max"),
                F.approx_percentile(F.col(c).cast("double"), [x for p in QUARTILES.values() for x in (p - 2 / SKETCH, p + 2 / SKETCH)], SKETCH).alias("around"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).select(F.array(*[f"c{i}" for i in range(len(columns))]).alias("m"))
    found = moments.first()["m"]  # one row of figures and sketched bounds
    quartiles = _exact_quartiles(df.select(*[F.col(c).cast(common).alias(f"v{i}") for i, c in enumerate(columns)]), [row.around for row in found], columns)
    literal = [F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in moments.schema["m"].dataType.elementType.fields if f.name != "around"]) for row in found]
    summed = df.sparkSession.range(1).select(F.inline(F.array(*literal))).filter("n > 0")
    return summed.join(F.broadcast(quartiles), "metric").select("metric", "n", "mean", "std", "min", *QUARTILES, "max")  # one row per column


def _exact_quartiles(values: DataFrame, around: Sequence[Sequence[float] | None], columns: Sequence[str]) -> DataFrame:
    """metric and its quartiles, from the values v0, v1, ... and two values around each quartile.

    A sketch errs by less than the margin taken. Among few rows the quartile may be the value next to the
    two, so these neighbours are kept as well; anything else would be an error of the sketch and ends the job.
    """
    every = [(i, j) for i in range(len(columns)) for j in range(len(QUARTILES))]
    part = {ij: k for k, ij in enumerate(every)}

    @cache
    def sides(i: int, j: int) -> tuple[Column, Column, Column]:
        """Whether a value lies below, between or above; with a margin for what a double cannot hold."""
        value = F.col(f"v{i}").cast("double")
        if around[i] is None:  # a column without a value
            return (F.lit(False),) * 3
        low, high = around[i][2 * j : 2 * j + 2]
        low, high = low - abs(low) * 1e-15, high + abs(high) * 1e-15
        return value < low, (value >= low) & (value <= high), value > high

    counted = values.agg(
        *[
            F.struct(
                F.lit(part[i, j]).alias("part"),
                F.lit(columns[i]).alias("metric"),
                ((F.count(f"v{i}") - 1) * F.lit(float(p))).alias("point"),
                F.count_if(sides(i, j)[0]).alias("n_below"),
                F.count_if(sides(i, j)[1]).alias("n_between"),
                F.max(F.when(sides(i, j)[0], F.col(f"v{i}"))).alias("below"),
                F.min(F.when(sides(i, j)[2], F.col(f"v{i}"))).alias("above"),
            ).alias(f"p{part[i, j]}")
            for i in range(len(columns))
            for j, p in enumerate(QUARTILES.values())
        ]
    ).select(F.inline(F.array(*[f"p{k}" for k in range(len(every))])))
    inside = F.array_compact(F.array(*[F.when(sides(i, j)[1], F.struct(F.lit(part[i, j]).alias("part"), F.col(f"v{i}").alias("value"))) for i, j in every]))
    # where the ranges of values may be cut, as the sketch knows; this takes the place of a sample
    cuts = [Row(part=part[i, j], value=low + (high - low) * k / 8) for i, j in every if around[i] for low, high in [around[i][2 * j : 2 * j + 2]] for k in range(9)]
    between = value_histogram(values.select(F.inline(inside)), "part", "value", cuts)
    upto = F.col("n_below") + F.col("upto")
    picked = between.join(F.broadcast(counted), "part").groupBy("part").agg(  # one row per column and quartile
        F.min(F.when(upto > F.floor("point"), F.col("value"))).alias("low"), F.min(F.when(upto > F.ceil("point"), F.col("value"))).alias("high")
    )

    def at(rank: Column, found: str) -> Column:
        wrong = (rank < F.col("n_below") - 1) | (rank > F.col("n_below") + F.col("n_between"))
        return (
            F.when(wrong, F.raise_error(F.lit("a quartile lies outside its sketch")).cast("double"))
            .when(rank < F.col("n_below"), F.col("below").cast("double"))
            .when(rank >= F.col("n_below") + F.col("n_between"), F.col("above").cast("double"))
            .otherwise(F.col(found).cast("double"))
        )

    low, high = at(F.floor("point"), "low"), at(F.ceil("point"), "high")
    exact = counted.filter("point >= 0").join(picked, "part", "left").select("metric", (F.col("part") % len(QUARTILES)).alias("which"), (low + (high - low) * (F.col("point") - F.floor("point"))).alias("quartile"))
    return exact.groupBy("metric").agg(*[F.max(F.when(F.col("which") == j, F.col("quartile"))).alias(name) for j, name in enumerate(QUARTILES)])
