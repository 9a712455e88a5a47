"""Summary tables over the star.

The fact is reduced to per-key hit counts before it meets a dimension. A hot
status or URL then reaches the join as one row, whatever its share of the
requests, and hit counts serve several summaries from one pass over the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import calendar
from hitloom.functions.measures import percent, ratio, wide_sum
from hitloom.schemas import conform

TOP_ENDPOINTS = 8
TOP_ERRORS = 10


def hits(fact: DataFrame, *by: str) -> DataFrame:
    """Requests (``n``), bytes, and requests with a byte count (``sized``) per key."""
    return fact.groupBy(*by).agg(
        F.count("*").alias("n"),
        wide_sum(F.col("body_bytes_sent")).alias("bytes"),
        F.count("body_bytes_sent").alias("sized"),
    )


def regroup(counted: DataFrame, *by: str) -> DataFrame:
    """Hit counts by fewer keys."""
    return counted.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sum("sized").alias("sized")
    )


def hits_by_hour(fact: DataFrame) -> DataFrame:
    hour = calendar.start_of_hour(F.col("request_timestamp"))
    return hits(fact.withColumn("hour", hour), "hour", "date_sk", "status_sk")


def hits_by_ip(fact: DataFrame) -> DataFrame:
    return hits(fact, "ip_sk", "status_sk")


def hits_by_request(fact: DataFrame) -> DataFrame:
    return fact.groupBy("request_sk").agg(F.count("*").alias("n"))


def _total(n: Column) -> Column:
    return F.coalesce(F.sum(n), F.lit(0))


def _n_where(condition: Column) -> Column:
    return _total(F.when(condition, F.col("n")))


def _with_share(counted: DataFrame, count: str) -> DataFrame:
    """Add ``pct``, each group's percentage of all groups.

    The total is a scalar subquery over the same counts, so no window gathers the
    groups in one task.
    """
    total = counted.select(F.sum(count)).scalar()
    return counted.withColumn("pct", percent(F.col(count), total))


def _kpi_totals() -> list[Column]:
    return [
        _total(F.col("n")).alias("total_requests"),
        _n_where(F.col("is_error")).alias("errors"),
        F.sum("bytes").alias("bytes"),
        F.sum("sized").alias("sized"),
    ]


def kpi_summary(ip_hits: DataFrame, dim_status: DataFrame) -> DataFrame:
    """Requests, distinct addresses, error rate and mean size, in one row."""
    joined = ip_hits.join(dim_status.select("status_sk", "is_error"), "status_sk")
    return _kpi(joined.agg(*_kpi_totals(), F.countDistinct("ip_sk").alias("unique_ips")))


def kpi_of_hits(status_hits: DataFrame, dim_status: DataFrame, unique_ips: Column) -> DataFrame:
    """The same from hits by status and a count of distinct addresses made elsewhere."""
    joined = regroup(status_hits, "status_sk").join(
        dim_status.select("status_sk", "is_error"), "status_sk")
    return _kpi(joined.agg(*_kpi_totals()).withColumn("unique_ips", unique_ips))


def _kpi(totals: DataFrame) -> DataFrame:
    return conform(totals.select(
        "total_requests",
        "unique_ips",
        percent(F.col("errors"), F.col("total_requests")).alias("error_rate_pct"),
        F.round(ratio(F.col("bytes"), F.col("sized")) / 1024.0, 2).alias("avg_kb_per_req"),
    ), "kpi_summary")


def agg_hourly_traffic(hour_hits: DataFrame, dim_status: DataFrame) -> DataFrame:
    """Requests, successes and errors per hour."""
    joined = hour_hits.join(dim_status, "status_sk")
    return conform(joined.groupBy("hour").agg(
        F.sum("n").alias("total_requests"),
        _n_where(F.col("status_class") == "2xx").alias("success_2xx"),
        _n_where(F.col("is_error")).alias("errors_4xx5xx"),
    ), "agg_hourly_traffic")


def agg_status_breakdown(hour_hits: DataFrame, dim_status: DataFrame) -> DataFrame:
    """Requests per status class."""
    joined = regroup(hour_hits, "status_sk").join(dim_status, "status_sk")
    return conform(
        joined.groupBy("status_class").agg(F.sum("n").alias("request_count")),
        "agg_status_breakdown",
    )


def agg_top_endpoints(request_hits: DataFrame, dim_request: DataFrame,
                      k: int = TOP_ENDPOINTS) -> DataFrame:
    """The k most requested (URL, method) pairs, ties by URL and method."""
    joined = request_hits.join(dim_request, "request_sk")
    counted = joined.groupBy("url", "method").agg(F.sum("n").alias("request_count"))
    top = counted.orderBy(F.desc("request_count"), "url", "method").limit(k)
    return conform(top, "agg_top_endpoints")


def agg_method_split(request_hits: DataFrame, dim_request: DataFrame) -> DataFrame:
    """Requests and their share per method."""
    joined = request_hits.join(dim_request, "request_sk")
    counted = joined.groupBy("method").agg(F.sum("n").alias("request_count"))
    return conform(_with_share(counted, "request_count"), "agg_method_split")


def agg_error_detail(hour_hits: DataFrame, dim_status: DataFrame,
                     k: int = TOP_ERRORS) -> DataFrame:
    """The k most frequent error codes with their share of all errors."""
    errors = dim_status.filter(F.col("is_error"))
    joined = regroup(hour_hits, "status_sk").join(errors, "status_sk")
    counted = joined.groupBy("status_code", "status_class").agg(
        F.sum("n").alias("error_count")
    )
    shared = _with_share(counted, "error_count")
    top = shared.orderBy(F.desc("error_count"), "status_code", "status_class").limit(k)
    return conform(top, "agg_error_detail")


def agg_day_of_week(hour_hits: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Requests per weekday, and per hour of one such day."""
    joined = regroup(hour_hits, "date_sk").join(dim_date, "date_sk")
    grouped = joined.groupBy(
        "day_name", calendar.day_order(F.col("full_date")).alias("day_order"), "is_weekend"
    ).agg(F.sum("n").alias("total_requests"))
    return conform(grouped.withColumn(
        "avg_req_per_hour", F.round(F.col("total_requests") / F.lit(24.0), 2)
    ), "agg_day_of_week")


def agg_daily_bytes(hour_hits: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Volume, requests and mean size per day."""
    joined = regroup(hour_hits, "date_sk").join(dim_date, "date_sk")
    day_type = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    grouped = joined.groupBy("full_date", "is_weekend", day_type.alias("day_type")).agg(
        F.sum("n").alias("request_count"),
        F.sum("bytes").alias("bytes"),
        F.sum("sized").alias("sized"),
    )
    gib = 1024.0 * 1024 * 1024
    return conform(grouped.select(
        "full_date",
        "is_weekend",
        "day_type",
        (F.col("bytes").cast("double") / gib).alias("total_gb"),
        "request_count",
        (ratio(F.col("bytes"), F.col("sized")) / 1024.0).alias("avg_kb_per_req"),
    ), "agg_daily_bytes")


# Reading order of each summary; stored tables have none.
PRESENTATION = {
    "agg_hourly_traffic": ("hour", "asc"),
    "agg_status_breakdown": ("request_count", "desc"),
    "agg_top_endpoints": ("request_count", "desc"),
    "agg_method_split": ("request_count", "desc"),
    "agg_error_detail": ("error_count", "desc"),
    "agg_day_of_week": ("day_order", "asc"),
    "agg_daily_bytes": ("full_date", "asc"),
}


def presented(summary: DataFrame, name: str) -> DataFrame:
    """A stored summary in its reading order, ties by the remaining columns."""
    if name not in PRESENTATION:
        return summary
    column, direction = PRESENTATION[name]
    first = F.col(column).desc() if direction == "desc" else F.col(column).asc()
    rest = [c for c in summary.columns if c != column]
    return summary.orderBy(first, *rest)
