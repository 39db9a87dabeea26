"""Joins, picks and reshapes the analyses are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def membership_flag(df: DataFrame, keys: DataFrame, key: str, into: str) -> DataFrame:
    """Whether each row's key occurs in ``keys``; repeated keys do not multiply rows."""
    found = keys.select(key).distinct().withColumn(into, F.lit(True))
    return df.join(found, key, "left").withColumn(into, F.coalesce(into, F.lit(False)))


def pick_nth(df: DataFrame, group: str, keys: Sequence[Column], n: int) -> DataFrame:
    """The ``n``-th row per group, for a small fixed ``n``.

    Spark turns the filter into a limit per group that runs before the shuffle, so a group that
    holds most rows sends at most ``n`` rows per task.
    """
    rn = F.row_number().over(W.partitionBy(group).orderBy(*keys))
    return df.withColumn("_rn", rn).filter(F.col("_rn") == n).drop("_rn")


def first_rows(df: DataFrame, group: str, keys: Sequence[Column], n: int, into: str = "rn") -> DataFrame:
    """The first ``n`` rows per group with their number; limited per group before the shuffle."""
    return df.withColumn(into, F.row_number().over(W.partitionBy(group).orderBy(*keys))).filter(F.col(into) <= n)


def first_two_dates(orders: DataFrame) -> DataFrame:
    """Dates of the first and second order per customer, as one grouping instead of a self-join."""
    early = first_rows(orders, "customer_id", [F.col("order_date"), F.col("order_id")], 2)
    return early.groupBy("customer_id").agg(
        F.min(F.when(F.col("rn") == 1, F.col("order_date"))).alias("first_order_date"),
        F.min(F.when(F.col("rn") == 2, F.col("order_date"))).alias("second_order_date"),
    )


def spread_over(df: DataFrame, values: Sequence, into: str) -> DataFrame:
    """Each row once per literal value."""
    return df.withColumn(into, F.explode(F.array(*[F.lit(v) for v in values])))


def listed(spark: SparkSession, key: str, values: Sequence[str], order: str) -> DataFrame:
    """A literal table of labels and their 1-based position."""
    rows = [F.struct(F.lit(v).alias(key), F.lit(place).alias(order)) for place, v in enumerate(values, start=1)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def reindexed(df: DataFrame, key: str, values: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per listed key, in the given order; keys without a row have NULLs.

    ``df`` is already grouped by the label, so what is left of it here has at most one row per listed key.
    """
    order = order or f"{key}_order"
    asked = df.filter(F.col(key).isin(*values))
    return listed(df.sparkSession, key, values, order).join(F.broadcast(asked), key, "left").orderBy(order)


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def rows_with_match(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def up_to_date(df: DataFrame, last: Column, column: str = "order_date") -> DataFrame:
    return df.filter(F.col(column) <= last)


def known_outcome(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[column])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def contingency(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts per row label: one column per listed value, and ``n_other`` for rows of any other value or none."""
    given = [F.sum(F.when(F.col(column) == F.lit(v), 1).otherwise(0)).alias(f"n_{v}") for v in values]
    other = F.sum(F.when(F.coalesce(F.col(column).isin(*values), F.lit(False)), 0).otherwise(1)).alias("n_other")
    return df.groupBy(row).agg(*given, other)
