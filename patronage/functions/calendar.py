"""Date arithmetic: month index, month key, day differences, calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(day: Column) -> Column:
    """Months since year 0, so that a difference counts calendar months."""
    return F.year(day) * 12 + F.month(day)


def month_start(day: Column) -> Column:
    """First day of the month: a key to group many rows by, formatted once per group afterwards."""
    return F.trunc(day, "month")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_key_index(key: Column) -> Column:
    """The month index of a ``yyyy-MM`` text."""
    year = F.split_part(key, F.lit("-"), F.lit(1)).cast("int")
    month = F.split_part(key, F.lit("-"), F.lit(2)).cast("int")
    return year * 12 + month


def months_between_calendar(later: Column, earlier: Column) -> Column:
    return month_index(later) - month_index(earlier)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday, as 0/1."""
    return F.dayofweek(day).isin(1, 7).cast("int")


def in_months(day: Column, months: list[int]) -> Column:
    return F.month(day).isin(*months)


def at_hour(day: Column, hour: Column) -> Column:
    """The timestamp (without time zone) of a date and an hour of the day."""
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), hour.cast("int"), F.lit(0), F.lit(0)
    )


def plus_minutes(moment: Column, minutes: Column) -> Column:
    """Whole or fractional minutes later, to the second."""
    seconds = F.round(minutes.cast("decimal(18,4)") * 60, 0).cast("int")
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
