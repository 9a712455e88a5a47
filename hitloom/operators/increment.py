"""High-water mark and the rows above it."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.sources.commits import newest
from hitloom.sources.folders import matching

PARTITION_COLUMNS = ("year", "month", "day")


def latest_event_time(requests: DataFrame) -> DataFrame:
    """One row, ``max_timestamp``: the latest event time."""
    return requests.agg(F.max("timestamp").alias("max_timestamp"))


def high_water_mark(requests: DataFrame | None) -> datetime | None:
    """The latest event time as a value; None when there are no requests."""
    return None if requests is None else latest_event_time(requests).first()[0]


def stored_days(spark: SparkSession, root: str) -> list[tuple[int, int, int]]:
    """Days that silver has folders for, newest first, from folder names alone.

    The folder of requests without a time is no day.
    """
    day = "year=*/month=*/day=*"
    days = set()
    for path in (path for above in ("", "batch_id=*/", "load=*/")
                 for path in matching(spark, f"{root}/{above}{day}")):
        values = [part.split("=", 1)[1] for part in path.rstrip("/").split("/")[-3:]]
        if all(value.isdigit() for value in values):
            days.add(tuple(map(int, values)))
    return sorted(days, reverse=True)


def newest_day(spark: SparkSession, root: str, silver: DataFrame | None) -> DataFrame | None:
    """The requests of silver's newest day that has any; no other day's file is opened."""
    for values in stored_days(spark, root) if silver is not None else []:
        named = zip(PARTITION_COLUMNS, values, strict=True)
        day = silver.filter(reduce(lambda a, b: a & b, (F.col(c) == v for c, v in named)))
        if not day.select("timestamp").filter("timestamp IS NOT NULL").isEmpty():
            return day
    return None


def stored_high_water_mark(spark: SparkSession, root: str,
                           silver: DataFrame | None) -> datetime | None:
    """The latest event time of stored silver; None when it is missing or empty.

    Where loads were committed, their newest commit tells it and no data file is opened.
    """
    commit = newest(spark, root)
    if commit is not None:
        return commit.mark
    return high_water_mark(newest_day(spark, root, silver))


def newer_than(requests: DataFrame, mark: datetime | None) -> DataFrame:
    """Rows strictly after the mark, so none without a time; all rows if there is no mark."""
    if mark is None:
        return requests
    # As text, so that neither Python's nor the session's time zone shifts it.
    return requests.filter(F.col("timestamp") > F.lit(mark.isoformat()).cast("timestamp_ntz"))
