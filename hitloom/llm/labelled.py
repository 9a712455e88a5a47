"""Labelled rows for training and folds of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str, folds: int, remainder: int) -> Column:
    """Whether the crc32 of the key as text leaves ``remainder``; a null key is not held out."""
    fold = F.crc32(F.col(key).cast("string")) % folds
    return F.coalesce(fold == remainder, F.lit(False))


def one_text_per_id(sample: DataFrame, *marks: str) -> DataFrame:
    """(doc_id, text, marks...) with one row for each id, so that an id which many rows share
    counts once; of different texts that of the smaller hash. Rows without id are left out."""
    return sample.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"),
        *(F.max(mark).alias(mark) for mark in marks))


def bounded_labels(labels: DataFrame, column: str, wanted: int | None, folds: int,
                   remainder: int, bound: int) -> DataFrame:
    """doc_id and label of at most ``bound`` labelled rows outside the held-out fold.

    Chosen by the hash of the id, so not by order or content. Rows without id or label
    are left out; of several labels of a document the largest counts.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)
                     & ~held_out("doc_id", folds, remainder))
        .groupBy("doc_id").agg(F.max(column).alias("label"))
    )
    if wanted is not None:
        rows = rows.where(F.col("label") == wanted)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
