"""Every query by name, each over the whole test tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.operators import addresses, quality
from hitloom.operators.dedup import REQUEST_KEY, dedup_requests
from hitloom.operators.enrich import enrich_hostnames
from hitloom.operators.increment import (
    high_water_mark,
    latest_event_time,
    newer_than,
    newest_day,
    stored_high_water_mark,
)
from hitloom.operators.parse import describe_requests, parse_requests
from hitloom.operators.quarantine import REASONS
from hitloom.operators.sinks import register_tables as register
from hitloom.operators.sinks import store
from hitloom.operators.star import STAR, stg_requests
from hitloom.operators.summaries import PRESENTATION, presented
from hitloom.plans import rollup
from hitloom.plans.ingest import load_increment, refine
from hitloom.plans.warehouse import (
    SUMMARIES,
    build_bucketed,
    build_checked,
    build_warehouse,
    star_tables,
    summary_over,
)
from hitloom.session import fresh_folder
from hitloom.sources.commits import loads_since, read_quarantine
from hitloom.sources.derived_logs import (
    access_log,
    hostname_lookup,
    land_lines,
    land_lookup,
    log_lines,
)
from hitloom.sources.lookup import read_lookup
from hitloom.sources.raw_logs import fields_of_lines, read_access_logs
from hitloom.sources.silver import flat_silver_view, read_silver, silver_view
from hitloom.streaming.file_ingest import ingest_new_files, ingest_within


def _cut() -> Column:
    """The moment between two uploads in the increment queries."""
    return F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")


def _with_untimed(requests: DataFrame) -> DataFrame:
    """Make the time of some requests unreadable, so that a null partition arises."""
    return requests.withColumn(
        "timestamp", F.when(F.col("body_bytes_sent") % 89 != 0, F.col("timestamp"))
    )


def _landing(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> str:
    """A fresh landing folder with one upload of lines and the lookup."""
    landing = fresh_folder(spark, "landing")
    if lines is None:
        lines = log_lines(access_log(spark, sf_dir))
    land_lines(lines, landing, 2024, 1)
    land_lookup(hostname_lookup(spark, sf_dir), landing, 2024, 1)
    return landing


def _stored_silver(spark: SparkSession, sf_dir: str) -> str:
    """A fresh silver folder loaded from landed text."""
    silver = fresh_folder(spark, "silver")
    load_increment(spark, _landing(spark, sf_dir), silver)
    return silver


def parse_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_requests(read_access_logs(spark, _landing(spark, sf_dir)))


def parse_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = log_lines(access_log(spark, sf_dir))
    return parse_requests(fields_of_lines(lines, F.col("value")))


def type_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_requests(access_log(spark, sf_dir))


def status_class_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = describe_requests(access_log(spark, sf_dir))
    return described.groupBy("status", "status_class", "is_error").agg(
        F.count("*").alias("request_count")
    )


def enriched_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_hostnames(access_log(spark, sf_dir), hostname_lookup(spark, sf_dir))


def enriched_by_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by two lookups whose columns stand in different orders."""
    lookup, landing = hostname_lookup(spark, sf_dir), fresh_folder(spark, "landing")
    even = F.pmod(F.hash("client_ip"), F.lit(2)) == 0
    land_lookup(lookup.filter(even), landing, 2024, 1)
    land_lookup(lookup.filter(~even).select("hostname", "client_ip"), landing, 2024, 2)
    return enrich_hostnames(access_log(spark, sf_dir), read_lookup(spark, landing))


def enriched_by_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by the join that a lookup too large to broadcast takes."""
    return enrich_hostnames(
        access_log(spark, sf_dir), hostname_lookup(spark, sf_dir), broadcast_bytes=0
    )


def enriched_by_unusable_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup whose header tells no address and no host: every name is null."""
    landing = fresh_folder(spark, "landing")
    lookup = hostname_lookup(spark, sf_dir).toDF("key", "value")
    land_lookup(lookup, landing, 2024, 1)
    return enrich_hostnames(access_log(spark, sf_dir), read_lookup(spark, landing))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_requests(access_log(spark, sf_dir))


def silver_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(access_log(spark, sf_dir), hostname_lookup(spark, sf_dir))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = log_lines(_with_untimed(access_log(spark, sf_dir)))
    silver = fresh_folder(spark, "silver")
    load_increment(spark, _landing(spark, sf_dir, lines), silver)
    return silver_view(spark, silver)


def silver_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = log_lines(_with_untimed(access_log(spark, sf_dir)))
    silver = fresh_folder(spark, "silver")
    load_increment(spark, _landing(spark, sf_dir, lines), silver)
    return flat_silver_view(spark, silver)


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = fresh_folder(spark, "silver")
    rows = load_increment(spark, _landing(spark, sf_dir), silver)
    return spark.createDataFrame(list(rows.items()), "stage STRING, rows BIGINT")


def _spoilt_lines(requests: DataFrame) -> DataFrame:
    """Log lines of which some lack fields, an address or a size, or have one too many."""
    lines = log_lines(requests)
    size = F.regexp_extract("value", '([0-9]+) "[^"]*" "[^"]*" "-"$', 1).cast("bigint")
    value = F.col("value")
    spoilt = (
        F.when(size % 41 == 0, F.substring_index(value, " ", 5))
        .when(size % 43 == 0, F.concat(value, F.lit(" surplus")))
        .when(size % 47 == 0, F.regexp_replace(value, r"^\S+", '""'))
        .when(size % 53 == 0, F.regexp_replace(value, r' [0-9]+ ("[^"]*" "[^"]*" "-")$', " x1 $1"))
        .when(size % 59 == 0, F.regexp_replace(value, r' [0-9]+ ("[^"]*" "[^"]*" "-")$', " - $1"))
        .otherwise(value)
    )
    return lines.select(spoilt.alias("value"))


def bad_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable lines by reason over two loads: as counted, and as stored in quarantine."""
    log, silver = _with_untimed(access_log(spark, sf_dir)), fresh_folder(spark, "silver")
    odd = F.col("remote_addr").substr(-1, 1).isin("1", "3", "5", "7", "9")
    landing = _landing(spark, sf_dir, _spoilt_lines(log.filter(odd)))
    counted = [load_increment(spark, landing, silver, quarantine=True)]
    land_lines(_spoilt_lines(log.filter(~odd)), landing, 2024, 2)
    counted.append(load_increment(spark, landing, silver, quarantine=True))
    rows = [(name, sum(load[f"bad_{name}"] for load in counted)) for name in REASONS]
    stored = read_quarantine(spark, silver).groupBy("reason").agg(
        F.count("*").alias("stored"), F.countDistinct("load").alias("loads"))
    return spark.createDataFrame(rows, "reason STRING, counted BIGINT").join(
        stored, "reason", "left")


def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the newest commit tells it, beside what the newest day's files hold."""
    root = _stored_silver(spark, sf_dir)
    silver = read_silver(spark, root)
    mark = stored_high_water_mark(spark, root, silver)
    day = newest_day(spark, root, silver)
    held = latest_event_time(silver.limit(0) if day is None else day)
    same = F.col("max_timestamp").eqNullSafe(
        F.lit(mark and mark.isoformat()).cast("timestamp_ntz"))
    return held.where(same)


def incremental_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = access_log(spark, sf_dir)
    loaded = describe_requests(log.filter(F.col("timestamp") <= _cut()))
    return newer_than(log, high_water_mark(loaded))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; early PUT requests arrive with the second and are too late for it."""
    log = access_log(spark, sf_dir)
    first = (F.col("timestamp") <= _cut()) & (F.col("method") != "PUT")
    silver = fresh_folder(spark, "silver")
    landing = _landing(spark, sf_dir, log_lines(log.filter(first)))
    load_increment(spark, landing, silver)
    land_lines(log_lines(log.filter(~first)), landing, 2024, 2)
    load_increment(spark, landing, silver)
    return read_silver(spark, silver)


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two uploads, the later requests first; the stream keeps both."""
    log = access_log(spark, sf_dir)
    silver = fresh_folder(spark, "silver")
    checkpoint = fresh_folder(spark, "stream-state")
    landing = _landing(spark, sf_dir, log_lines(log.filter(F.col("timestamp") > _cut())))
    ingest_new_files(spark, landing, silver, checkpoint)
    land_lines(log_lines(log.filter(F.col("timestamp") <= _cut())), landing, 2024, 2)
    ingest_new_files(spark, landing, silver, checkpoint)
    ingest_new_files(spark, landing, silver, checkpoint)
    return read_silver(spark, silver)


def incremental_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upload twice, deduplicated across batches."""
    lines = log_lines(access_log(spark, sf_dir))
    silver = fresh_folder(spark, "silver")
    checkpoint = fresh_folder(spark, "stream-state")
    landing = _landing(spark, sf_dir, lines)
    ingest_new_files(spark, landing, silver, checkpoint, dedup_across_batches=True)
    land_lines(lines, landing, 2024, 2)
    ingest_new_files(spark, landing, silver, checkpoint, dedup_across_batches=True)
    return read_silver(spark, silver)


def incremental_stream_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by their keys after two runs of the stateful stream.

    The second upload brings the first once more, with its PUT requests, which are new:
    those within a day of the latest request seen are kept, older ones are too late.
    """
    log = access_log(spark, sf_dir)
    first = (F.col("timestamp") <= _cut()) & (F.col("method") != "PUT")
    silver = fresh_folder(spark, "silver")
    checkpoint = fresh_folder(spark, "stream-state")
    landing = _landing(spark, sf_dir, log_lines(log.filter(first)))
    ingest_within(spark, landing, silver, checkpoint, "1 day")
    land_lines(log_lines(log), landing, 2024, 2)
    ingest_within(spark, landing, silver, checkpoint, "1 day")
    return read_silver(spark, silver).select(*REQUEST_KEY)


def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.time_range(silver_requests(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_requests(silver_requests(spark, sf_dir))


def star_table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return STAR[name](staged(spark, sf_dir))


def _checked_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver and star; silver is written first, so the many checks share its dedup."""
    silver = store(silver_requests(spark, sf_dir), fresh_folder(spark, "checked"))
    return {"silver": silver, **star_tables(silver)}


def summary_table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_over(name, silver_requests(spark, sf_dir))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_checks(_checked_tables(spark, sf_dir))


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null_checks(_checked_tables(spark, sf_dir))


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationship_checks(_checked_tables(spark, sf_dir))


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact addresses missing from a dimension that holds only named addresses."""
    star = star_tables(silver_requests(spark, sf_dir))
    named = star["dim_ip"].filter(F.col("client_hostname").isNotNull())
    return quality.orphans(star["fact_requests"], "ip_sk", named)


def silver_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and times of every stored day as committed, and whether the listing has files."""
    silver = _stored_silver(spark, sf_dir)
    days = [(d.year, d.month, d.day, d.rows, d.first, d.last)
            for load in loads_since(spark, silver) for d in load.days]
    committed = spark.createDataFrame(
        days, "year INT, month INT, day INT, row_count BIGINT, first STRING, last STRING")
    listed = quality.audited_days(quality.silver_files(spark, silver))
    clock = lambda name: F.col(name).cast("timestamp_ntz").alias(f"{name}_timestamp")
    return committed.join(listed, ["year", "month", "day"], "full").select(
        "year", "month", "day", "row_count", clock("first"), clock("last"), "has_files")


def summaries_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every summary in its reading order: place and ordering value of each row."""
    silver = store(silver_requests(spark, sf_dir), fresh_folder(spark, "ordered"))
    placed = []
    for name, (column, _) in PRESENTATION.items():
        # Sorted partitions follow one another, so this number rises with the order.
        rows = presented(summary_over(name, silver), name).select(
            F.lit(name).alias("summary"), F.col(column).cast("string").alias("value"),
            F.monotonically_increasing_id().alias("place"))
        placed.append(rows)
    every = reduce(DataFrame.unionByName, placed)
    in_order = Window.partitionBy("summary").orderBy("place")
    return every.select(
        "summary", F.row_number().over(in_order).cast("bigint").alias("position"), "value")


def _counted(spark: SparkSession, database: str, done: DataFrame) -> DataFrame:
    """Name, status and rows, as read by name, of the tables of a database made for this
    query, which is then dropped; the files stay."""
    rows = [
        (row["table"].rsplit(".", 1)[-1], row["status"], spark.table(row["table"]).count())
        for row in done.collect()
    ]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(rows, "table STRING, status STRING, row_count BIGINT")


def _new_database(spark: SparkSession) -> str:
    folder = fresh_folder(spark, "database")
    database = f"hits_{folder.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    return database


def _half_silver(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Landing and silver after the first of two uploads."""
    lines = log_lines(access_log(spark, sf_dir).filter(F.col("timestamp") <= _cut()))
    landing, silver = _landing(spark, sf_dir, lines), fresh_folder(spark, "silver")
    load_increment(spark, landing, silver)
    return landing, silver


def _load_other_half(spark: SparkSession, sf_dir: str, landing: str, silver: str) -> None:
    later = access_log(spark, sf_dir).filter(F.col("timestamp") > _cut())
    land_lines(log_lines(later), landing, 2024, 2)
    load_increment(spark, landing, silver)


def bucketed_top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top endpoints from bucketed tables, joined where they lie.

    The tables' names go with the database; the rows are computed before.
    """
    database, root = _new_database(spark), fresh_folder(spark, "bucketed")
    tables = build_bucketed(silver_requests(spark, sf_dir), root, database, 8)
    top = store(tables["agg_top_endpoints"], f"{root}/agg_top_endpoints")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return top


def register_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register silver, load more, then register it again with star and summaries."""
    database = _new_database(spark)
    landing, silver = _half_silver(spark, sf_dir)
    register(spark, {f"{database}.silver": silver})
    _load_other_half(spark, sf_dir, landing, silver)
    warehouse = fresh_folder(spark, "warehouse")
    tables = build_warehouse(read_silver(spark, silver), warehouse)
    paths = {"silver": silver, **{name: f"{warehouse}/{name}" for name in tables}}
    done = register(spark, {f"{database}.{name}": path for name, path in paths.items()})
    return _counted(spark, database, done)


def model_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and publish the models, load more, and replace them by a second build.

    The derived logs hold requests without URL or status, so failed checks only warn.
    """
    database, warehouse = _new_database(spark), fresh_folder(spark, "warehouse")
    landing, silver = _half_silver(spark, sf_dir)
    build_checked(read_silver(spark, silver), warehouse, "warn", database)
    _load_other_half(spark, sf_dir, landing, silver)
    _, _, done = build_checked(read_silver(spark, silver), warehouse, "warn", database)
    return _counted(spark, database, done)


def _rolled_up(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Silver, and partials by day after two loads, each followed by a refresh; one day is
    in both."""
    log = access_log(spark, sf_dir)
    noon = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    silver, partials = fresh_folder(spark, "silver"), fresh_folder(spark, "rollup")
    landing = _landing(spark, sf_dir, log_lines(log.filter(F.col("timestamp") <= noon)))
    load_increment(spark, landing, silver)
    rollup.refresh(spark, silver, partials)
    land_lines(log_lines(log.filter(F.col("timestamp") > noon)), landing, 2024, 2)
    load_increment(spark, landing, silver)
    rollup.refresh(spark, silver, partials)
    return silver, partials


# A table of each kind of partial; the tests compare all eight.
ROLLED = ("kpi_summary", "agg_hourly_traffic", "agg_top_endpoints", "agg_daily_bytes")


def rolled_summary(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary from partials that two increments have left."""
    return rollup.summary_tables(spark, _rolled_up(spark, sf_dir)[1])[name]


def rolled_unique_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uniqueness of request ids, checked day by day as they were loaded."""
    return rollup.unique_requests(spark, *_rolled_up(spark, sf_dir))


def unique_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct addresses of every day, and of all days merged, from the same bitmaps."""
    bitmaps = rollup.partial(spark, _rolled_up(spark, sf_dir)[1], "addresses_by_day")
    by_day = addresses.count_addresses(bitmaps, rollup.DAY)
    every = addresses.count_addresses(bitmaps).select(F.lit(None).cast("int").alias("day"), "*")
    return by_day.unionByName(every)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_access_log": parse_access_log,
    "parse_log_lines": parse_log_lines,
    "type_requests": type_requests,
    "status_class_flags": status_class_flags,
    "enrich_hostnames": enriched_requests,
    "enrich_hostnames_shuffled": enriched_by_shuffle,
    "enrich_hostnames_mixed_headers": enriched_by_mixed_headers,
    "enrich_unusable_lookup": enriched_by_unusable_lookup,
    "dedup_requests": deduplicated,
    "silver_requests": silver_requests,
    "silver_roundtrip": silver_roundtrip,
    "silver_unpartitioned": silver_unpartitioned,
    "ingest_metrics": ingest_metrics,
    "bad_line_counts": bad_line_counts,
    "high_water_mark": high_water,
    "incremental_new_rows": incremental_new_rows,
    "incremental_append": incremental_append,
    "incremental_stream": incremental_stream,
    "incremental_stream_dedup": incremental_stream_dedup,
    "incremental_stream_within": incremental_stream_within,
    "time_range": time_range,
    "stg_requests": staged,
    **{name: partial(star_table, name) for name in STAR},
    **{name: partial(summary_table, name) for name in SUMMARIES},
    **{f"rolled_{name}": partial(rolled_summary, name) for name in ROLLED},
    "rolled_unique_requests": rolled_unique_requests,
    "unique_addresses": unique_addresses,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_relationships": dq_relationships,
    "dq_orphans": dq_orphans,
    "silver_audit": silver_audit,
    "summaries_in_order": summaries_in_order,
    "bucketed_top_endpoints": bucketed_top_endpoints,
    "register_tables": register_tables,
    "model_tables": model_tables,
}
