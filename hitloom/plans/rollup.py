"""Summaries kept up to date day by day.

Partial aggregates are stored by day. A refresh looks up in silver's commits which days
later loads have touched, reads these days alone, and replaces their partials; the eight
summaries are then computed from the partials of all days, which are small, and equal
those of a full build. A refresh that dies is simply run again: the days it has replaced
are replaced by the same rows, and only its mark, written last, moves it on.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions import calendar
from hitloom.operators import addresses, quality, star, summaries
from hitloom.plans.warehouse import SUMMARIES
from hitloom.sources import commits
from hitloom.sources.folders import matching, write_text_once
from hitloom.sources.lookup import path_missing
from hitloom.sources.silver import read_silver

#: The day of a partial, 20240131; 0 for requests without a time.
DAY = "day"
#: Days that a task writes the partials of, about.
DAYS_EACH = 64
Day = tuple[int | None, int | None, int | None]


def _hits_by_hour(staged: DataFrame) -> DataFrame:
    fact = star.fact_requests(staged)
    hour = calendar.start_of_hour(F.col("request_timestamp"))
    by_hour = _with_day(fact.withColumn("hour", hour))
    return summaries.hits(by_hour, DAY, "hour", "date_sk", "status_sk")


def _hits_by_request(staged: DataFrame) -> DataFrame:
    fact = _with_day(star.fact_requests(staged))
    return fact.groupBy(DAY, "request_sk").agg(F.count("*").alias("n"))


def _with_day(requests: DataFrame) -> DataFrame:
    return requests.withColumn(DAY, calendar.day_of(F.col("request_timestamp")))


def _repeated_requests(staged: DataFrame) -> DataFrame:
    """Request ids of each day that stand more than once.

    An id holds the address, the time and the request, run together, so equal ids have
    equal times, unless an address holds the text of a time itself. Those addresses are
    counted: their ids can only be compared over all days.
    """
    ids = _with_day(staged).where("request_id IS NOT NULL").groupBy(
        DAY, F.unhex("request_id").alias("id")).agg(
            F.count("*").alias("n"), F.max(_holds_a_time("remote_addr")).alias("odd"))
    return ids.groupBy(DAY).agg(
        F.count_if(F.col("n") > 1).alias("repeated"), F.count_if("odd").alias("odd"))


def _holds_a_time(address: str) -> Column:
    return F.col(address).rlike(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d")


#: Partials straight from the staged requests of a day.
COUNTS = {"hits_by_hour": _hits_by_hour, "hits_by_request": _hits_by_request,
          "repeated_requests": _repeated_requests}
#: Dimensions that the summaries need, with the columns that tell their rows apart.
DIMENSIONS = {
    "dim_status": (star.dim_status, ("status", "status_class", "is_error")),
    "dim_request": (star.dim_request, ("method", "url", "protocol")),
    "dim_date": (star.dim_date, ("request_date",)),
}


def _marks(spark: SparkSession, root: str) -> list[int]:
    names = (path.rsplit("/", 1)[1] for path in matching(spark, f"{root}/_marks/*.json"))
    return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit())


def touched_days(loads: list[commits.Load]) -> list[Day]:
    """Days that any of these loads has rows for."""
    days = {(day.year, day.month, day.day) for load in loads for day in load.days}
    return sorted(days, key=lambda day: [part or 0 for part in day])


def on_days(silver: DataFrame, days: list[Day]) -> DataFrame:
    """The requests of these days; only their partitions are read.

    The days are one set of numbers: as conditions joined by ``or`` they nest as deep as
    there are days, which some thousand are too many for.
    """
    numbers = [0 if None in day else day[0] * 10_000 + day[1] * 100 + day[2] for day in days]
    return silver.where(calendar.day_number().isin(numbers))


def _gathered(partial: DataFrame, days: int) -> DataFrame:
    """The rows of each day side by side.

    Rebalancing puts as many days into one task as are small, and that writes their folders
    one after the other; beyond ``DAYS_EACH`` days they are therefore dealt out by number,
    and only among fewer days is a far larger one split.
    """
    tasks = math.ceil(days / DAYS_EACH)
    return partial.hint("rebalance", DAY) if tasks < 2 else partial.repartition(tasks, DAY)


def _replace(partial: DataFrame, folder: str, days: int) -> None:
    """Replace the days, so many, that the partial holds; others stay as they are."""
    (_gathered(partial, days).write.mode("overwrite").partitionBy(DAY)
     .option("partitionOverwriteMode", "dynamic").parquet(folder))


def _numbers(spark: SparkSession, root: str, before: int) -> DataFrame:
    """(remote_addr, number) as numbered by refreshes up to ``before``."""
    schema = "remote_addr STRING, number BIGINT"
    try:
        stored = spark.read.schema(schema).parquet(f"{root}/addresses")
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], schema)
    if "refresh" not in stored.columns:
        return spark.createDataFrame([], schema)
    return stored.where(F.col("refresh") <= before).select("remote_addr", "number")


def refresh(spark: SparkSession, silver_root: str, root: str) -> list[Day]:
    """Bring the partials below ``root`` up to silver's newest commit; returns the days
    that were replaced."""
    marks = _marks(spark, root)
    loads = commits.loads_since(spark, silver_root, marks[-1] if marks else 0)
    days = touched_days(loads)
    if not loads:
        return []
    mark = loads[-1].number
    if days:
        rows = on_days(read_silver(spark, silver_root), days)
        staged = star.stg_requests(rows)
        for name, count in COUNTS.items():
            _replace(count(staged), f"{root}/{name}", len(days))
        for name, (_, columns) in DIMENSIONS.items():
            _replace(_with_day(staged).select(DAY, *columns).distinct(), f"{root}/{name}",
                     len(days))
        known = _numbers(spark, root, marks[-1] if marks else 0)
        # Of a refresh that died, the numbers are given again, and alike.
        addresses.number_new(rows, known).write.mode("overwrite").parquet(
            f"{root}/addresses/refresh={mark}")
        # The key figures leave out requests without a status.
        counted = _with_day(staged).where("status IS NOT NULL")
        _replace(addresses.address_bitmaps(counted, _numbers(spark, root, mark), DAY),
                 f"{root}/addresses_by_day", len(days))
    write_text_once(spark, f"{root}/_marks/{mark:012d}.json", "{}")
    return days


def partial(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def dimension(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The dimension over all days."""
    model, columns = DIMENSIONS[name]
    return model(partial(spark, root, name).select(*columns))


def kpi_summary(spark: SparkSession, root: str) -> DataFrame:
    """The key figures, with the addresses of all days merged."""
    unique = addresses.count_addresses(partial(spark, root, "addresses_by_day"))
    return summaries.kpi_of_hits(
        partial(spark, root, "hits_by_hour"), dimension(spark, root, "dim_status"),
        unique.select("unique_ips").scalar())


def summary_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The eight summaries from the partials of all days; silver is not read."""
    tables = {
        name: model(partial(spark, root, counted), dimension(spark, root, needed))
        for name, (model, counted, needed) in SUMMARIES.items() if name != "kpi_summary"
    }
    return {"kpi_summary": kpi_summary(spark, root), **tables}


def unique_requests(spark: SparkSession, silver_root: str, root: str) -> DataFrame:
    """The check that request ids are unique, from the days' own counts.

    All of silver is compared only where an address could make ids of two days equal.
    """
    counts = partial(spark, root, "repeated_requests")
    if counts.where("odd > 0").isEmpty():
        failures = counts.agg(F.coalesce(F.sum("repeated"), F.lit(0)).alias("failures"))
        return quality.result(failures.withColumn("column", F.lit("request_id")), "unique",
                              "fact_requests")
    staged = star.stg_requests(read_silver(spark, silver_root))
    return quality.check_unique(staged, "fact_requests", "request_id", F.unhex("request_id"))
