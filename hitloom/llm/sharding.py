"""Sharding by extendible hashing.

Rows have a string of hash bits. The directory starts as one bucket; a bucket over the
byte limit splits on its next bit, and only such buckets do, until every shard fits.
The first 60 bits hash the key; rows of one key that together exceed the limit are told
apart by further bits, which hash a number given to each stored row. A row that is
larger than the limit by itself ends alone, marked ``oversized``.

A bucket of one row is never split. Null texts count no bytes; null keys hash as the
word "null"; repeated rows are rows of their own; an empty table has no shards. Other
columns are left out of the result.

All is DataFrame work: sizes are summed per prefix at a depth where buckets are small,
then rolled up to every shallower depth at once, so no step runs once per bucket and
the directory stays a distributed table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.tables import written

LIMIT_BYTES = 1 << 20
KEY_BITS = 60
#: Bits beyond those that halve the total down to the limit, for uneven buckets.
SPARE_BITS = 3


def hash_bits(text: Column) -> Column:
    """The first 60 bits of the md5 of a text, as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _fitting(leaves: DataFrame, group: list[str], low: int, high: int, limit: int) -> DataFrame:
    """For every leaf, a prefix of ``high`` bits, the shallowest bucket that needs no split.

    ``leaves`` holds the group, prefix, bytes and rows; ``found`` is null for leaves that
    are themselves over the limit.
    """
    levels = leaves.select(
        *group, "prefix", "bytes", "rows",
        F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"),
    ).withColumn("ancestor", F.expr(f"shiftright(prefix, {high} - depth)"))
    whole = ["depth", "ancestor", *group]
    fits = (
        levels.groupBy(*whole).agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("n"))
        .where((F.col("shard_bytes") <= limit) | (F.col("n") == 1))
    )
    return (
        levels.join(fits, whole, "left")
        .groupBy(*group, "prefix")
        .agg(F.min(F.when(F.col("n").isNotNull(),
                          F.struct("depth", "ancestor", "shard_bytes", "n"))).alias("found"))
    )


def _leaves(rows: DataFrame, group: list[str], prefix: Column) -> DataFrame:
    return (rows.groupBy(*group, prefix.alias("prefix"))
            .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")))


def _bits_needed(n_bytes: int, limit: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n_bytes / limit)))) + SPARE_BITS


def _bit_text(value: str, width: str) -> Column:
    return F.expr(f"right(lpad(bin({value}), {KEY_BITS}, '0'), {width})")


def assign_shards(documents: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """key, shard (its bits as text), depth, n_bytes, shard_bytes and oversized of every row."""
    rows = written(documents.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        hash_bits(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("hash"),
        F.monotonically_increasing_id().alias("number"),
    ), "sized-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    first = min(KEY_BITS, _bits_needed(total, limit))
    at_first = F.shiftright("hash", KEY_BITS - first)
    placed = written(_fitting(_leaves(rows, [], at_first), [], 0, first, limit), "directory")
    joined = rows.withColumn("prefix", at_first).join(placed, "prefix").drop("prefix")
    done = [_placed(joined.where("found IS NOT NULL"), "", limit)]
    rest = joined.where("found IS NULL").drop("found")
    if not placed.where("found IS NULL").isEmpty():
        done += _deeper(written(rest, "unplaced-rows"), first, limit)
    shards = done[0]
    for part in done[1:]:
        shards = shards.unionByName(part)
    return shards.withColumnRenamed("key", key)


def _placed(rows: DataFrame, before: str, limit: int) -> DataFrame:
    """The result columns of rows whose bucket was found below the bits ``before``."""
    lead = _bit_text("hash", str(KEY_BITS)) if before else F.lit("")
    depth = F.col("found.depth") + (KEY_BITS if before else 0)
    return rows.select(
        "key",
        F.concat(lead, _bit_text("found.ancestor", "found.depth")).alias("shard"),
        depth.cast("int").alias("depth"), "n_bytes",
        F.col("found.shard_bytes").alias("shard_bytes"),
        (F.col("found.shard_bytes") > limit).alias("oversized"),
    )


def _deeper(rows: DataFrame, first: int, limit: int) -> list[DataFrame]:
    """Buckets over the limit at ``first`` bits: the other key bits, then bits of the row."""
    directory = written(
        _fitting(_leaves(rows, [], F.col("hash")), [], first + 1, KEY_BITS, limit), "directory")
    joined = rows.join(directory.withColumnRenamed("prefix", "hash"), "hash")
    done = [_placed(joined.where("found IS NOT NULL"), "", limit)]
    if directory.where("found IS NULL").isEmpty():
        return done
    rest = written(joined.where("found IS NULL").drop("found")
                   .withColumn("own", hash_bits(F.col("number").cast("string"))), "one-key-rows")
    most = rest.groupBy("hash").agg(F.sum("n_bytes").alias("n")).agg(F.max("n")).first()[0]
    bits, low = min(KEY_BITS, _bits_needed(most, limit)), 0
    while True:
        prefix = F.shiftright("own", KEY_BITS - bits)
        directory = written(
            _fitting(_leaves(rest, ["hash"], prefix), ["hash"], low, bits, limit), "directory")
        joined = rest.withColumn("prefix", prefix).join(directory, ["hash", "prefix"]).drop("prefix")
        done.append(_placed(joined.where("found IS NOT NULL"), "hash", limit))
        if bits == KEY_BITS or directory.where("found IS NULL").isEmpty():
            return done
        rest = written(joined.where("found IS NULL").drop("found"), "one-key-rows")
        low, bits = bits + 1, min(KEY_BITS, bits + 8)


def write_shards(documents: DataFrame, folder: str, limit: int = LIMIT_BYTES,
                 key: str = "doc_id", text: str = "text") -> None:
    """Stores the documents below one folder per shard; keys must be unique."""
    shards = assign_shards(documents, limit, key, text).select(key, "shard")
    (documents.join(shards, key).repartition("shard")
     .write.partitionBy("shard").parquet(folder))
