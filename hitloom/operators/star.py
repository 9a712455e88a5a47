"""Staging, dimensions and the request fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions import calendar, keys
from hitloom.schemas import conform


def stg_requests(silver: DataFrame) -> DataFrame:
    """One row per silver row with its request id and date."""
    staged = silver.select(
        keys.request_id(F.col("remote_addr"), F.col("timestamp"), F.col("method"),
                        F.col("url")).alias("request_id"),
        "remote_addr",
        "client_hostname",
        F.col("timestamp").alias("request_timestamp"),
        F.col("timestamp").cast("date").alias("request_date"),
        "method",
        "url",
        "protocol",
        "status",
        "status_class",
        "is_error",
        "body_bytes_sent",
        "http_referer",
        "user_agent",
    )
    return conform(staged, "stg_requests")


# Each dimension takes distinct source values first and hashes only those.

def dim_ip(staged: DataFrame) -> DataFrame:
    """Distinct addresses with their hostname."""
    distinct = staged.select("remote_addr", "client_hostname").distinct()
    return conform(distinct.select(
        keys.ip_key(F.col("remote_addr")).alias("ip_sk"),
        F.col("remote_addr").alias("ip_address"),
        "client_hostname",
    ), "dim_ip")


def dim_status(staged: DataFrame) -> DataFrame:
    """Distinct status codes with class and error flag."""
    distinct = staged.select("status", "status_class", "is_error").distinct()
    return conform(distinct.select(
        keys.status_key(F.col("status")).alias("status_sk"),
        F.col("status").alias("status_code"),
        "status_class",
        "is_error",
    ), "dim_status")


def dim_request(staged: DataFrame) -> DataFrame:
    """Distinct method, URL and protocol."""
    distinct = staged.select("method", "url", "protocol").distinct()
    return conform(distinct.select(
        keys.request_key(F.col("method"), F.col("url"), F.col("protocol")).alias("request_sk"),
        "method",
        "url",
        "protocol",
    ), "dim_request")


def dim_date(staged: DataFrame) -> DataFrame:
    """Observed dates with calendar attributes."""
    date = F.col("request_date")
    distinct = staged.select("request_date").distinct()
    return conform(distinct.select(
        keys.date_key(date).alias("date_sk"),
        date.alias("full_date"),
        F.year(date).cast("bigint").alias("year"),
        F.month(date).cast("bigint").alias("month"),
        F.dayofmonth(date).cast("bigint").alias("day"),
        calendar.day_name(date).alias("day_name"),
        calendar.is_weekend(date).alias("is_weekend"),
    ), "dim_date")


def fact_requests(staged: DataFrame) -> DataFrame:
    """One row per request with its four keys, computed without a lookup or shuffle."""
    return conform(staged.select(
        "request_id",
        keys.ip_key(F.col("remote_addr")).alias("ip_sk"),
        keys.date_key(F.col("request_date")).alias("date_sk"),
        keys.status_key(F.col("status")).alias("status_sk"),
        keys.request_key(F.col("method"), F.col("url"), F.col("protocol")).alias("request_sk"),
        "request_timestamp",
        "body_bytes_sent",
        "http_referer",
        "user_agent",
    ), "fact_requests")


STAR = {
    "dim_ip": dim_ip,
    "dim_status": dim_status,
    "dim_request": dim_request,
    "dim_date": dim_date,
    "fact_requests": fact_requests,
}
