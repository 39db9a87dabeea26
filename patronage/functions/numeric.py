"""Exact rounding, ratios, null and zero guards, compact money text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    """``scale * num / den`` to ``digits`` places, half away from zero; NULL when ``den`` is 0.

    The rounding is done on whole numbers, because rounding a binary fraction differs
    between engines (0.145 to two places). ``num`` and ``den`` are integers or decimals.
    """
    unit = 10**digits
    den = F.nullif(den, F.lit(0))
    steps = F.call_function("div", F.abs(num) * F.lit(2 * unit * scale) + den, den * F.lit(2))
    return F.when(num < 0, -steps).otherwise(steps).cast("double") / F.lit(float(unit))


def rounded_pct(num: Column, den: Column, digits: int = 2) -> Column:
    return rounded_ratio(num, den, digits, scale=100)


def ratio(num: Column, den: Column) -> Column:
    """Unrounded double division of exact sums; NULL on a zero divisor."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column) -> Column:
    """100 * num / den. Multiplying first keeps whole percentages exact at band edges."""
    return F.lit(100.0) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def clipped(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def count_if(condition: Column) -> Column:
    """Rows where the condition holds, as a sum that can be combined before the shuffle."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def compact_money(amount: Column) -> Column:
    """The currency sign, then 1e7 and up in crore (Cr), 1e5 and up in lakh (L), else whole units with Indian grouping."""
    two_places = "decimal(38,2)"
    plain = F.round(amount.cast(two_places), 0).cast("decimal(38,0)")
    digits = F.abs(plain).cast("string")
    head = F.substring(digits, F.lit(1), F.length(digits) - 3)
    pairs = F.regexp_replace(head, r"(?<=\d)(?=(\d\d)+$)", ",")
    grouped = F.when(F.length(digits) > 3, F.concat(pairs, F.lit(","), F.right(digits, F.lit(3)))).otherwise(digits)
    signed = F.concat(F.when(plain < 0, F.lit("-")).otherwise(F.lit("")), grouped)
    text = (
        F.when(amount >= 10_000_000, F.concat((amount / 10_000_000).cast(two_places).cast("string"), F.lit("Cr")))
        .when(amount >= 100_000, F.concat((amount / 100_000).cast(two_places).cast("string"), F.lit("L")))
        .otherwise(signed)
    )
    return F.concat(F.lit("₹"), text)
