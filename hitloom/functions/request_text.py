"""Columns that read the text fields of one access-log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time layout of the log format.
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def bracketed_time(date_part: Column, offset_part: Column) -> Column:
    """``[22/Jan/2019:03:56:14`` and ``+0330]`` joined, without the brackets."""
    joined = F.concat_ws(" ", date_part, offset_part)
    return F.substring(joined, F.lit(2), F.length(joined) - 2)


def log_instant(time_text: Column) -> Column:
    """The instant named by a log time; null for unreadable text."""
    return F.try_to_timestamp(time_text, F.lit(LOG_TIME_FORMAT))


def utc_wall_clock(instant: Column) -> Column:
    """UTC clock reading of an instant, whatever the session's time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def instant(clock: Column) -> Column:
    """The instant of a UTC clock reading; the inverse of ``utc_wall_clock``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(F.timestamp_diff("SECOND", epoch, clock))


def request_part(request: Column, position: int) -> Column:
    """Item ``position`` of the space-separated request line; null when absent."""
    return F.get(F.split(request, " "), F.lit(position))


def number(text: Column, data_type: str) -> Column:
    """Text as a number; null for ``-`` and other non-numbers."""
    return text.try_cast(data_type)
