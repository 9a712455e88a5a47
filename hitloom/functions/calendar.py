"""Calendar columns over zone-less timestamps and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def start_of_hour(ts: Column) -> Column:
    # date_trunc would go through the session time zone; this stays zone-less.
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def start_of_second(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts)
    )


def day_name(date: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(date, "EEEE")


def day_order(date: Column) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(date) - 1


def is_weekend(date: Column) -> Column:
    return F.coalesce(day_order(date).isin(0, 6), F.lit(False))


def day_of(ts: Column) -> Column:
    """20240131 of a clock reading; 0 without one."""
    number = F.year(ts) * 10_000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return F.coalesce(number, F.lit(0))


def day_number() -> Column:
    """20240131 from the columns year, month and day; 0 for rows without a time."""
    number = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    return F.coalesce(number, F.lit(0))
