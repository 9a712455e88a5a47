"""One row per request key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions import request_text
from hitloom.functions.calendar import day_number

# Time leads: logs arrive nearly in time order, which makes the sorts cheap.
REQUEST_KEY = ("timestamp", "remote_addr", "method", "url")
SURVIVOR_ORDER = ("status", "body_bytes_sent", "protocol", "http_referer", "user_agent",
                  "client_hostname")


def dedup_requests(requests: DataFrame) -> DataFrame:
    """Keep the smallest row per key by a fixed column order, nulls last.

    Filtering on rank 1 lets Spark keep one row per key in every map task before
    the single shuffle, so a key that holds most of the data shrinks to at most
    one row per task and cannot skew it.
    """
    order = [F.col(c).asc_nulls_last() for c in SURVIVOR_ORDER if c in requests.columns]
    ranked = Window.partitionBy(*REQUEST_KEY).orderBy(*order)
    return (
        requests.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def first_within(requests: DataFrame, delay: str) -> DataFrame:
    """Of a stream's rows with equal keys the first to arrive, told by state.

    A key is remembered until the watermark, ``delay`` behind the latest request seen, has
    passed its time by ``delay``, so the state holds the keys of a stretch of time, however
    much silver holds. Rows that are older than the watermark are left out, first ones too.
    Rows without a time are compared within a batch only. Which of the rows that differ in
    other columns comes first is not fixed.
    """
    timed = requests.withColumn("_instant", request_text.instant(F.col("timestamp")))
    return timed.withWatermark("_instant", delay).dropDuplicatesWithinWatermark(
        list(REQUEST_KEY)).drop("_instant")


def not_yet_stored(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of deduplicated requests whose key stored silver does not hold.

    Equal keys lie on the same day, so only the days at hand are read from silver,
    and only its key columns. The set of days is a subquery of one value; it is no
    larger than the calendar.
    """
    days = requests.select(F.collect_set(day_number())).scalar()
    # The bounds drop most partitions before the days are searched one by one.
    at_hand = (day_number().between(F.array_min(days), F.array_max(days))
               & F.array_contains(days, day_number()))
    same_days = stored.filter(at_hand).select(
        *(F.col(c).alias(f"stored_{c}") for c in REQUEST_KEY)
    )
    same_key = reduce(
        lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"stored_{c}")) for c in REQUEST_KEY)
    )
    return requests.join(same_days, same_key, "left_anti")
