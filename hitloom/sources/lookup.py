"""Client-to-hostname lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.sources.folders import matching

# Where lookups land, and what column names say.
LOOKUP_GLOB = "*/*/lookup/client_hostname.csv"
ADDRESS_HINTS = ("ip", "addr")
HOST_HINTS = ("host", "name")


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _last_match(columns: list[str], hints: tuple[str, ...]) -> str | None:
    matches = [c for c in columns if any(hint in c.lower() for hint in hints)]
    return matches[-1] if matches else None


def resolve_lookup_columns(columns: list[str]) -> tuple[str, str] | None:
    """(address column, host column) by name; the last match wins, None if one is missing."""
    address = _last_match(columns, ADDRESS_HINTS)
    host = _last_match(columns, HOST_HINTS)
    return (address, host) if address and host else None


def read_lookup(spark: SparkSession, landing: str) -> DataFrame | None:
    """All landed lookups, or None if there is none; other errors pass through.

    Files are read by position under one header, so files of different headers are read
    apart and joined by what their columns mean. There is one lookup per upload, so the
    headers are few. A file whose columns cannot be told among others that can is left out.
    """
    reader = spark.read.option("header", True)
    pattern = f"{landing.rstrip('/')}/{LOOKUP_GLOB}"
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(matching(spark, pattern)):
        by_header.setdefault(tuple(reader.csv(path).columns), []).append(path)
    if not by_header:
        return None
    frames = [reader.csv(paths) for paths in by_header.values()]
    if len(frames) == 1:
        return frames[0]
    named = [names for frame in frames if (names := address_names(frame)) is not None]
    if not named:
        return frames[0]
    return reduce(DataFrame.unionByName, named).select(
        F.col("lookup_ip").alias("client_ip"), F.col("client_hostname").alias("hostname"))


def address_names(lookup: DataFrame, address_column: str | None = None,
                  host_column: str | None = None) -> DataFrame | None:
    """(lookup_ip, client_hostname) rows, or None when the columns cannot be told."""
    if not (address_column and host_column):
        resolved = resolve_lookup_columns(lookup.columns)
        if resolved is None:
            return None
        address_column, host_column = resolved
    named = lookup.select(
        lookup[address_column].alias("lookup_ip"), lookup[host_column].alias("client_hostname")
    )
    return named.filter(F.col("lookup_ip").isNotNull())
