"""Calendar parts of dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def week_of_month(moment: Column) -> Column:
    """1 for days 1-7, 2 for days 8-14, and so on up to 5."""
    return F.ceil(F.dayofmonth(moment) / 7).cast("int")


def weekday(moment: Column) -> Column:
    """0 for Monday up to 6 for Sunday."""
    return F.weekday(moment)


def weekend(moment: Column) -> Column:
    return (F.weekday(moment) >= 5).cast("int")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def next_month(month_start: Column) -> Column:
    return F.add_months(month_start, 1)
