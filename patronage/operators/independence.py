"""Pearson chi-square test of independence from a small table of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0: Stirling's series ten places above z, and the factors in between."""
    high = z + 10.0
    series = 1 / (12 * high) - 1 / (360 * F.pow(high, F.lit(3.0))) + 1 / (1260 * F.pow(high, F.lit(5.0))) - 1 / (1680 * F.pow(high, F.lit(7.0)))
    stirling = (high - 0.5) * F.log(high) - high + F.log(F.lit(2.0) * F.pi()) / 2 + series
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda total, k: total + F.log(z + k))
    return stirling - steps


def upper_tail(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) of the chi-square distribution, by incomplete gamma series or fraction.

    Below the mean the power series of the lower part converges fast; above it the continued
    fraction of the upper part does, and keeps its relative precision where the tail is tiny. The
    common factor is computed in logarithms. Near the mean either needs terms as the square root
    of the degrees of freedom; their number grows with it. The result is always within 0 and 1.
    """
    a, x = dof / 2.0, statistic / 2.0
    front = F.exp(a * F.log(x) - x - log_gamma(a))
    terms = F.sequence(F.lit(1), (F.lit(200) + 20 * F.sqrt(a)).cast("int"))
    series = F.aggregate(
        terms,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, i: F.struct(
            (s["term"] * x / (a + i)).alias("term"), (s["sum"] + s["term"] * x / (a + i)).alias("sum")
        ),
        lambda s: s["sum"],
    )
    fraction = F.aggregate(
        F.reverse(terms), F.lit(0.0), lambda below, i: i * (F.lit(0.0) + i - a) / (x + 2 * i + 1 - a - below)
    )
    tail = F.when(x < a + 1, 1 - front * series / a).otherwise(front / (x + 1 - a - fraction))
    return F.when((dof < 1) | (statistic <= 0), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def chi_square(counts: DataFrame, row: str, column: str, n: str) -> DataFrame:
    """``statistic``, ``dof`` and ``p_value`` of a (row, column, n) table without zero totals.

    Absent rows and columns do not count towards the degrees of freedom. With one degree of
    freedom the continuity correction applies.

    ``counts`` is already grouped: it has one row per cell with a customer, and a window below sees
    the cells of one label or all cells, never data rows; it is evaluated once. A cell nobody falls in adds its expected count, and these add up to
    what the other cells leave of the total.
    """
    with_totals = counts.select(
        F.col(row).alias("_r"),
        F.col(column).alias("_c"),
        F.col(n).cast("double").alias("_o"),
        F.sum(n).over(W.partitionBy(row)).cast("double").alias("_row"),
        F.count(n).over(W.partitionBy(row)).alias("_row_cells"),
        F.sum(n).over(W.partitionBy(column)).cast("double").alias("_column"),
        F.count(n).over(W.partitionBy(column)).alias("_column_cells"),
        F.sum(n).over(W.partitionBy()).cast("double").alias("_all"),
    ).withColumn("_e", F.col("_row") * F.col("_column") / F.col("_all"))
    gap = F.col("_o") - F.col("_e")
    sums = with_totals.agg(
        F.count_distinct("_r").alias("_rows"),
        F.count_distinct("_c").alias("_columns"),
        F.count(F.lit(1)).alias("_cells"),
        F.sum(gap * gap / F.col("_e")).alias("_plain"),
        F.sum("_e").alias("_expected"),
        F.max("_all").alias("_all"),
        F.max(F.abs(gap)).alias("_gap"),
        F.sum(1 / (F.col("_row") * F.col("_row_cells"))).alias("_inverse_rows"),
        F.sum(1 / (F.col("_column") * F.col("_column_cells"))).alias("_inverse_columns"),
    )
    empty = F.when(F.col("_cells") < F.col("_rows") * F.col("_columns"), F.col("_all") - F.col("_expected"))
    dof = (F.col("_rows") - 1) * (F.col("_columns") - 1)
    # two by two: all four gaps are equal
    nearer = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    corrected = nearer * nearer * F.col("_all") * F.col("_inverse_rows") * F.col("_inverse_columns")
    plain = F.col("_plain") + F.coalesce(empty, F.lit(0.0))
    return sums.select(F.when(dof == 1, corrected).otherwise(plain).alias("statistic"), dof.alias("dof")).select(
        "statistic", "dof", upper_tail(F.col("statistic"), F.col("dof")).alias("p_value")
    )
