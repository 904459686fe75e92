"""Time expressions. The session time zone decides the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; both ends are floored to the second first."""
    return end.cast("timestamp").cast("long") - start.cast("timestamp").cast("long")


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def year_text(day: Column) -> Column:
    """Year as four-digit text (integer arithmetic, no date formatter per row)."""
    year = F.year(day)
    text = year.cast("string")
    return F.when(year < 1000, F.lpad(text, 4, "0")).otherwise(text)


def month_text(day: Column) -> Column:
    return F.lpad(F.month(day).cast("string"), 2, "0")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def event_range(start: str, end: str, event: str = "pickup_datetime") -> Column:
    """``start <= event < end`` plus what that implies for the month partitions.

    The month columns are separate strings, so Spark cannot derive the second
    half by itself; without it a range over one day lists and opens every month.
    The end is exclusive, so the last month is that of the microsecond before it.
    """
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    in_range = (F.col(event) >= first) & (F.col(event) < last)
    low, high = F.to_date(first), F.to_date(last - F.expr("INTERVAL '0.000001' SECOND"))
    year, month = F.col("pickup_year"), F.col("pickup_month")
    from_low = (year > year_text(low)) | (
        (year == year_text(low)) & (month >= month_text(low))
    )
    to_high = (year < year_text(high)) | (
        (year == year_text(high)) & (month <= month_text(high))
    )
    return in_range & from_low & to_high
