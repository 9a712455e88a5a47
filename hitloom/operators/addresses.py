"""Exact distinct addresses that merge: numbers given once, bitmaps by bucket.

An address gets a number when it is first seen. The numbers of one hash cell follow one
another, so the bitmaps of 32,768 numbers are dense, and cells number their new addresses
side by side. Bitmaps of two days, or of two builds, merge by ``or``; the number of bits
that are set is the exact number of different addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash cells, each numbered by itself, and the room for numbers in each.
CELLS, ROOM_BITS = 1024, 40


def _cell(address: str):
    return F.pmod(F.xxhash64(address), F.lit(CELLS))


def number_new(seen: DataFrame, known: DataFrame) -> DataFrame:
    """(remote_addr, number) of the addresses in ``seen`` that are not in ``known``."""
    new = seen.select("remote_addr").where("remote_addr IS NOT NULL").distinct().join(
        known, "remote_addr", "left_anti").withColumn("cell", _cell("remote_addr"))
    used = known.groupBy(_cell("remote_addr").alias("cell")).agg(F.count("*").alias("used"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("remote_addr")) - 1
    return new.withColumn("place", place).join(F.broadcast(used), "cell", "left").select(
        "remote_addr",
        (F.shiftleft("cell", ROOM_BITS) + F.coalesce("used", F.lit(0)) + F.col("place"))
        .alias("number"))


def address_bitmaps(requests: DataFrame, numbers: DataFrame, *by: str) -> DataFrame:
    """(by..., bucket, bitmap) of the addresses of ``requests``, which all have numbers."""
    distinct = requests.select(*by, "remote_addr").distinct().join(numbers, "remote_addr")
    return distinct.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def count_addresses(bitmaps: DataFrame, *by: str, name: str = "unique_ips") -> DataFrame:
    """Different addresses per ``by`` over any number of merged bitmaps."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counted = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name)
    return merged.groupBy(*by).agg(counted)
