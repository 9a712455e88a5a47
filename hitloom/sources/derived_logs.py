"""Access logs derived from the ``events`` and ``customer`` tables.

Stands in for a web server: each event becomes a request, every fiftieth twice,
and some carry an unreadable request line or status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions.calendar import start_of_second


def _address(number: Column) -> Column:
    high = F.floor(number / 256).cast("bigint").cast("string")
    return F.concat(F.lit("10.0."), high, F.lit("."), (number % 256).cast("string"))


def access_log(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """Typed requests, planted duplicates included; ``clean`` leaves nothing unreadable."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    )
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    e = events.withColumn("dup", F.explode(copies))
    every = lambda n: F.col("event_id") % n == 0
    kind = F.col("event_type")
    bad_request = F.lit(False) if clean else every(97)
    bad_status = F.lit(False) if clean else every(101)
    url = F.concat(F.lit("/"), kind, F.lit("/"), (F.col("k") % 20).cast("string"))
    remainder = F.col("k") % 4
    error_status = (
        F.when(remainder == 0, 404).when(remainder == 1, 500).when(remainder == 2, 403)
        .otherwise(499)
    )
    return e.select(
        _address(F.col("user_id")).alias("remote_addr"),
        start_of_second(F.col("ts")).alias("timestamp"),
        F.when(kind == "purchase", "POST").when(kind == "signup", "PUT").otherwise("GET")
        .alias("method"),
        F.when(~bad_request, url).alias("url"),
        F.when(bad_request, F.lit(None)).when(every(3), "HTTP/2.0").otherwise("HTTP/1.1")
        .alias("protocol"),
        F.when(bad_status, F.lit(None)).when(kind == "error", error_status)
        .when(every(11), 302).otherwise(200).alias("status"),
        (F.floor(F.col("value") * 1000).cast("bigint") + F.col("dup")).alias("body_bytes_sent"),
        F.when(every(5), "-")
        .otherwise(F.concat(F.lit("https://example.org/"), F.col("user_id").cast("string")))
        .alias("http_referer"),
        F.concat(
            F.lit("Mozilla/5.0 (X11; id "),
            (F.col("user_id") % 7 + F.col("dup")).cast("string"),
            F.lit(")"),
        ).alias("user_agent"),
    )


def hostname_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; every third has an address without a hostname."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    name = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("-")))
    return customers.select(
        _address(F.col("c_custkey")).alias("client_ip"),
        F.when(F.col("c_custkey") % 3 != 0, F.concat(name, F.lit(".example.net")))
        .alias("hostname"),
    )


def log_lines(requests: DataFrame) -> DataFrame:
    """Requests as log lines in local time at +0330, in one column ``value``."""
    local = F.col("timestamp") + F.expr("INTERVAL '210' MINUTE")
    # A request without a time gets one that does not parse.
    clock = F.coalesce(F.date_format(local, "dd/MMM/yyyy:HH:mm:ss"), F.lit("notatime"))
    request = F.concat_ws(" ", "method", "url", "protocol")
    status = F.coalesce(F.col("status").cast("string"), F.lit("abc"))
    return requests.select(F.format_string(
        '%s - - [%s +0330] "%s" %s %s "%s" "%s" "-"',
        "remote_addr", clock, request, status, F.col("body_bytes_sent").cast("string"),
        "http_referer", "user_agent",
    ).alias("value"))


def land_lines(lines: DataFrame, landing: str, year: int, month: int) -> None:
    """Write lines where the log reader looks for the given month's upload."""
    lines.write.mode("errorifexists").text(
        f"{landing}/year={year}/month={month:02d}/logs/access.log"
    )


def land_lookup(lookup: DataFrame, landing: str, year: int, month: int) -> None:
    """Write a lookup where the lookup reader looks for it."""
    lookup.write.mode("errorifexists").option("header", True).csv(
        f"{landing}/year={year}/month={month:02d}/lookup/client_hostname.csv"
    )
