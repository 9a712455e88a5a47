"""Status flags, ratios and sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_error(status: Column) -> Column:
    return status >= 400


def status_class(status: Column) -> Column:
    """``4xx`` for 404; division truncates."""
    return F.concat(F.call_function("div", status, F.lit(100)).cast("string"), F.lit("xx"))


def wide_sum(value: Column) -> Column:
    """Exact sum of bigints that cannot overflow, however many rows there are."""
    return F.sum(value.cast("decimal(19,0)"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places, multiplied first to round alike everywhere."""
    return F.round(ratio(part.cast("double") * 100.0, whole), 2)
