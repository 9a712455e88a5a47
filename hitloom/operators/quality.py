"""Declared checks as Spark jobs; each yields (check, table, column, failures, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hitloom.schemas import conform
from hitloom.sources.commits import data_folders, loads_since, numbers
from hitloom.sources.lookup import path_missing

# Which checks are declared for which columns.
UNIQUE = (
    ("dim_ip", "ip_sk"),
    ("dim_status", "status_sk"),
    ("dim_date", "date_sk"),
    ("dim_request", "request_sk"),
    ("fact_requests", "request_id"),
)
NOT_NULL = {
    "dim_ip": ("ip_sk",),
    "dim_status": ("status_sk",),
    "dim_date": ("date_sk",),
    "dim_request": ("request_sk",),
    "fact_requests": ("request_id", "ip_sk", "status_sk", "date_sk", "request_sk"),
}
SOURCE_NOT_NULL = {"silver": ("remote_addr", "timestamp", "status")}
RELATIONSHIPS = (
    ("fact_requests", "ip_sk", "dim_ip"),
    ("fact_requests", "status_sk", "dim_status"),
    ("fact_requests", "date_sk", "dim_date"),
    ("fact_requests", "request_sk", "dim_request"),
)


def result(failures: DataFrame, check: str, table: str) -> DataFrame:
    """Shape (column, failures) rows as check results."""
    return conform(failures.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        "column",
        "failures",
        (F.col("failures") == 0).alias("passed"),
    ), "quality")


def check_unique(df: DataFrame, table: str, column: str,
                 value: Column | None = None) -> DataFrame:
    """Failures are values seen more than once; nulls are ignored.

    ``value`` may name a shorter form of the column to compare instead.
    """
    value = F.col(column) if value is None else value
    repeated = (
        df.filter(F.col(column).isNotNull()).groupBy(value.alias("value")).count()
        .filter(F.col("count") > 1)
    )
    failures = repeated.agg(F.count("*").alias("failures"))
    return result(failures.withColumn("column", F.lit(column)), "unique", table)


def check_not_null(df: DataFrame, table: str, columns: tuple[str, ...],
                   check: str = "not_null") -> DataFrame:
    """Failures are null rows; all columns are counted in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return result(counts.unpivot([], list(columns), "column", "failures"), check, table)


def orphans(child: DataFrame, column: str, parent: DataFrame,
            counted: bool = False) -> DataFrame:
    """Child keys that no parent row has, with their row count ``n``.

    Keys are counted before the join, so a hot key costs one row in it. ``counted`` says
    that each child row already stands for ``n`` rows.
    """
    n = F.sum("n") if counted else F.count("*")
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(n.alias("n"))
    return keys.join(parent.select(column), column, "left_anti")


def check_relationship(child: DataFrame, table: str, column: str, parent: DataFrame,
                       counted: bool = False) -> DataFrame:
    """Failures are child rows whose key is in no parent row; nulls are ignored."""
    failures = orphans(child, column, parent, counted).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("failures")
    )
    return result(failures.withColumn("column", F.lit(column)), "relationships", table)


def _all(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def unique_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Checks of the hash keys, shuffled as 16 bytes rather than 32 hex digits."""
    return _all([check_unique(tables[t], t, c, F.unhex(F.col(c))) for t, c in UNIQUE
                 if t in tables])


def not_null_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Checks of the star, and of silver when it is among the tables."""
    checks = [check_not_null(tables[t], t, cs) for t, cs in NOT_NULL.items() if t in tables]
    checks += [
        check_not_null(tables[t], t, cs, "source_not_null")
        for t, cs in SOURCE_NOT_NULL.items() if t in tables
    ]
    return _all(checks)


def relationship_checks(tables: dict[str, DataFrame],
                        counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """``counted`` may hold, by key column, stored rows with ``n`` requests each; such a
    key is checked over the counts instead of the fact."""
    counted = counted or {}
    return _all([
        check_relationship(counted.get(c, tables[t]), t, c, tables[p], c in counted)
        for t, c, p in RELATIONSHIPS if t in tables and p in tables
    ])


def all_checks(tables: dict[str, DataFrame],
               counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every declared check whose tables are given."""
    checks = []
    if any(t in tables for t, _ in UNIQUE):
        checks.append(unique_checks(tables))
    if any(t in tables for t in (*NOT_NULL, *SOURCE_NOT_NULL)):
        checks.append(not_null_checks(tables))
    if any(t in tables and p in tables for t, _, p in RELATIONSHIPS):
        checks.append(relationship_checks(tables, counted))
    return _all(checks)


class QualityError(RuntimeError):
    """Checks failed; ``failed`` holds their rows."""

    def __init__(self, failed: list[Row]):
        super().__init__("; ".join(
            f"{r['check']} {r['table']}.{r['column']}: {r['failures']}" for r in failed))
        self.failed = failed


def gate(results: list[Row], severity: str = "error") -> list[Row]:
    """The failed rows; an error unless ``severity`` is ``warn``."""
    failed = [row for row in results if not row["passed"]]
    if failed and severity == "error":
        raise QualityError(failed)
    return failed


def silver_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file: path and size, from the listing; no file is opened.

    Where loads were committed, files of these only.
    """
    folders = [root]
    if numbers(spark, root):
        folders = data_folders(spark, root, loads_since(spark, root))
        if not folders:
            return spark.createDataFrame([], "file_path STRING, file_bytes BIGINT")
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
            .load(folders)
        )
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], "file_path STRING, file_bytes BIGINT")
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes"))


def silver_audit(files: DataFrame) -> DataFrame:
    """File count and volume of a stored dataset; fails when there is no file."""
    return files.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("total_bytes"),
    ).withColumn("passed", F.col("file_count") > 0)


def audited_days(files: DataFrame) -> DataFrame:
    """(year, month, day, has_files) of every stored day; null for requests without a time."""
    parts = [
        F.expr(f"try_cast(regexp_extract(file_path, '/{name}=([^/]+)/', 1) AS INT)").alias(name)
        for name in ("year", "month", "day")
    ]
    return files.select(*parts, "file_bytes").groupBy("year", "month", "day").agg(
        (F.sum("file_bytes") > 0).alias("has_files"))


def time_range(requests: DataFrame) -> DataFrame:
    """Row count with first and last event time, in one pass."""
    return requests.agg(
        F.count("*").alias("row_count"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
    )
