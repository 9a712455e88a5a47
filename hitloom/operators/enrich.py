"""Hostnames for request addresses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.session import MIB, fresh_folder
from hitloom.sources.lookup import address_names

BROADCAST_BYTES = 64 * MIB
ROW_OVERHEAD = 64
# An address is hot when it holds more than 1/HOT_SHARE of all rows, so there are
# fewer than HOT_SHARE of them.
HOT_SHARE = 10_000


@dataclass(frozen=True)
class LookupSize:
    """In-memory bytes of a lookup and of its widest row."""

    total: int
    widest: int


def measure(names: DataFrame) -> LookupSize:
    """Size of a lookup, by one pass over it."""
    widths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in names.columns]
    width = sum(widths, F.lit(ROW_OVERHEAD).cast("bigint"))
    row = names.agg(F.sum(width).alias("total"), F.max(width).alias("widest")).first()
    return LookupSize(row["total"] or 0, row["widest"] or ROW_OVERHEAD)


def one_name_per_address(names: DataFrame) -> DataFrame:
    """The smallest hostname of each address, so the join cannot multiply requests."""
    return names.groupBy("lookup_ip").agg(F.min("client_hostname").alias("client_hostname"))


def _matches(requests: DataFrame, names: DataFrame) -> Column:
    return requests["remote_addr"] == names["lookup_ip"]


def hot_addresses(requests: DataFrame, share: int) -> DataFrame:
    """Hashes of addresses that hold more than 1/share of the rows.

    There are fewer than ``share`` of them and each takes eight bytes, however
    long the address, so the result may always be broadcast.
    """
    counts = requests.groupBy(F.xxhash64("remote_addr").alias("hot_hash")).agg(
        F.count("*").alias("n")
    )
    total = counts.select(F.sum("n")).scalar()
    return counts.filter(F.col("n") * share > total).select("hot_hash")


def broadcast_names(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Left join that ships the whole lookup to every executor; no shuffle of requests."""
    return requests.join(F.broadcast(names), _matches(requests, names), "left").drop("lookup_ip")


def shuffled_names(requests: DataFrame, names: DataFrame, share: int) -> DataFrame:
    """Left join for a lookup too large to broadcast.

    Rows of hot addresses meet a broadcast of just those addresses' names and are
    not shuffled; every address left over is a small share of the rows, so the
    shuffle join of the rest is even. The hash only routes rows: both sides join
    on the address itself. The requests are read three times, so they should be stored.
    """
    hot = F.broadcast(hot_addresses(requests, share))
    is_hot_row = F.xxhash64(requests["remote_addr"]) == hot["hot_hash"]
    is_hot_name = F.xxhash64(names["lookup_ip"]) == hot["hot_hash"]
    hot_names = names.join(hot, is_hot_name, "left_semi")
    hot_rows = broadcast_names(requests.join(hot, is_hot_row, "left_semi"), hot_names)
    cold = requests.join(hot, is_hot_row, "left_anti")
    cold_rows = cold.join(names.hint("merge"), _matches(cold, names), "left").drop("lookup_ip")
    return hot_rows.unionByName(cold_rows)


def without_names(requests: DataFrame) -> DataFrame:
    return requests.withColumn("client_hostname", F.lit(None).cast("string"))


def enrich_hostnames(requests: DataFrame, lookup: DataFrame | None,
                     address_column: str | None = None, host_column: str | None = None,
                     broadcast_bytes: int = BROADCAST_BYTES,
                     folder: str | None = None) -> DataFrame:
    """Add ``client_hostname``; null where the lookup has no match or is unusable.

    The lookup is broadcast only when its measured size is within
    ``broadcast_bytes``; a larger one takes the shuffle join, where as many
    addresses count as hot as names of the widest row's size may be broadcast. That join
    reads the requests three times, so they are first stored in ``folder``, or one of its
    own: whatever brings them, such as the state of a stream, runs once, and what is counted
    on the way counts once.
    """
    names = None if lookup is None else address_names(lookup, address_column, host_column)
    if names is None:
        return without_names(requests)
    unique = one_name_per_address(names)
    size = measure(names)
    if size.total <= broadcast_bytes:
        return broadcast_names(requests, unique)
    share = max(1, min(HOT_SHARE, BROADCAST_BYTES // size.widest))
    folder = folder or fresh_folder(requests.sparkSession, "unnamed")
    requests.write.parquet(folder)
    stored = requests.sparkSession.read.schema(requests.schema).parquet(folder)
    return shuffled_names(stored, unique, share)
