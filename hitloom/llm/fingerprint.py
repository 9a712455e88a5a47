"""Document fingerprints: bottom-k sketches of hashed shingles.

A fingerprint holds the k smallest distinct hashes of a text's shingles (runs of
``width`` code points; a shorter text is one shingle, an empty text has none). Two
fingerprints estimate the resemblance and containment of their shingle sets, one the
number of distinct shingles; the fingerprint of a whole is merged from those of its
parts. Below k shingles all figures are exact.

Null texts count as empty and two empty texts resemble each other fully. Equal texts
have equal fingerprints, wherever they stand. In ``compare_with_next`` rows of equal
``doc_id`` follow in order of their text and null ids come last; a single document is
its own next. Other columns are left out of the result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.tables import in_arrow, mix64, partitions_for, texts_of

K = 128
WIDTH = 8
HASH_BITS = 48
ROWS_PER_PART = 50_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, width: int = WIDTH) -> np.ndarray:
    """A 48-bit hash of every shingle, in order, as unsigned 64-bit integers."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    if not len(codes):
        return codes
    with np.errstate(over="ignore"):
        codes = codes + np.uint64(1)
        span, hashes, base = 1, codes, _BASE
        done, out = 0, None
        want = min(width, len(codes))
        # Spans double; those that add up to the width are appended to one another.
        while want:
            if want & 1:
                if out is None:
                    out = hashes
                else:
                    n = len(codes) - (done + span) + 1
                    out = out[:n] * base + hashes[done : done + n]
                done += span
            want >>= 1
            if want:
                hashes = hashes[:-span] * base + hashes[span:]
                span, base = span * 2, base * base
        if len(codes) < width:
            out = out + np.uint64(len(codes))
        return mix64(out) >> np.uint64(64 - HASH_BITS)


def bottom_k(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    share = 4 * k / max(1, len(hashes))
    while share < 0.5:
        low = np.unique(hashes[hashes < np.uint64(int(share * 2**HASH_BITS))])
        if len(low) >= k:
            return low[:k]
        share *= 4
    return np.unique(hashes)[:k]


def sketch(text: str, k: int = K, width: int = WIDTH) -> np.ndarray:
    return bottom_k(shingle_hashes(text, width), k)


def merge(one: np.ndarray, other: np.ndarray, k: int = K) -> np.ndarray:
    """The fingerprint of both shingle sets together."""
    return np.union1d(one, other)[:k]


def resemblance(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Shared shingles by all shingles of both."""
    both = merge(one, other, k)
    if not len(both):
        return 1.0
    shared = np.intersect1d(one, other, assume_unique=True)
    return float(np.isin(both, shared, assume_unique=True).sum() / len(both))


def distinct_count(one: np.ndarray, k: int = K) -> float:
    """The number of distinct shingles."""
    return float(len(one)) if len(one) < k else (k - 1) * 2.0**HASH_BITS / float(one[k - 1])


def containment(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """The share of the first set's shingles that the second holds."""
    if not len(one):
        return 1.0
    union = distinct_count(merge(one, other, k), k)
    return min(1.0, resemblance(one, other, k) * union / distinct_count(one, k))


def to_text(values: np.ndarray) -> str:
    """Base64 of the hashes, six big-endian bytes each, ascending."""
    wide = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(wide[:, 2:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    packed = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(packed), 8), np.uint8)
    wide[:, 2:] = packed
    return wide.view(">u8").ravel().astype(np.uint64)


def fingerprint_documents(documents: DataFrame, text: str = "text", key: str = "doc_id",
                          k: int = K, width: int = WIDTH) -> DataFrame:
    """key, n_chars and fingerprint of every whole text."""
    kept = documents.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, texts)), pa.int64()),
                 pa.array([to_text(sketch(t, k, width)) for t in texts], pa.string())],
                names=[key, "n_chars", "fingerprint"])

    return in_arrow(
        kept, run, f"`{key}` {dict(kept.dtypes)[key]}, n_chars bigint, fingerprint string")


def merge_fingerprints(fingerprints: DataFrame, group: str, k: int = K,
                       rounds: tuple[int, ...] = (64, 1)) -> DataFrame:
    """One merged fingerprint per value of ``group``.

    Every task first merges what it holds of a group, and a group then meets in 64
    places before it meets in one, so no task gathers a group's documents.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, np.ndarray] = {}
        for batch in batches:
            for name, mark in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                  strict=True):
                values = from_text(mark)
                held[name] = merge(held[name], values, k) if name in held else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()),
             pa.array([to_text(v) for v in held.values()], pa.string())],
            names=["group", "fingerprint"])

    schema = "group string, fingerprint string"
    merged = fingerprints.select(F.col(group).cast("string").alias("group"), "fingerprint")
    for places in rounds:
        merged = in_arrow(merged, fold, schema)
        salt = F.pmod(F.xxhash64("fingerprint"), F.lit(places))
        merged = merged.repartition("group", salt)
    return in_arrow(merged, fold, schema).withColumnRenamed("group", group)


def compare_with_next(documents: DataFrame, text: str = "text", key: str = "doc_id",
                      k: int = K, width: int = WIDTH) -> DataFrame:
    """Every text, its edited text and the next text, descending key, by fingerprint.

    The edited text has its last third replaced from the start of the next text; after
    the last comes the first. Texts are shuffled once, into key ranges whose first
    document is also sent to the range before.
    """
    spark = documents.sparkSession
    kept = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
            partitions_for(kept.count(), ROWS_PER_PART))
    cuts = kept.agg(
        F.percentile_approx("doc_id", [i / n for i in range(1, n)] + [1.0], 100_000)).first()[0]
    # Heads of the ranges, highest first: keys of documents that exist.
    heads = np.array(sorted(set(cuts or [0]), reverse=True), dtype=np.int64)
    parts = len(heads)
    ascending = heads[::-1].copy()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).fill_null(int(ascending[0])).to_numpy()
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            at = np.searchsorted(ascending, keys)  # the lowest head not below the key
            part = parts - 1 - at
            head = np.flatnonzero((ascending[at] == keys) & known)
            yield from pa.Table.from_arrays(
                [pa.array(np.concatenate([part, (part[head] - 1) % parts]).astype(np.int32)),
                 pa.concat_arrays([batch.column(0), batch.column(0).take(pa.array(head))]),
                 pa.concat_arrays([batch.column(1), batch.column(1).take(pa.array(head))]),
                 pa.array(np.repeat([False, True], [len(keys), len(head)]))],
                names=["part", "doc_id", "text", "ahead"]).to_batches()

    ordered = (
        in_arrow(kept, route, "part int, doc_id bigint, text string, ahead boolean")
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "ahead", F.desc_nulls_last("doc_id"), "text")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row whose next row has not come yet
        rows: list[tuple] = []
        for batch in batches:
            for part, doc, text, ahead in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                    texts_of(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                own = None
                if waiting is not None and waiting[0] == part:
                    own = sketch(text, k, width)
                    rows.append(_compared(*waiting[1:], text, own, k, width))
                waiting = None if ahead else (
                    part, doc, text, sketch(text, k, width) if own is None else own)
                if len(rows) == 2000:
                    yield _batch(rows)
                    rows = []
        if waiting is not None:  # only null keys: no range has a head to send ahead
            rows.append(_compared(*waiting[1:], waiting[2], waiting[3], k, width))
        yield _batch(rows)

    return in_arrow(ordered, compare, ", ".join(f"{n} {t}" for n, t, _ in _COMPARED))


_COMPARED = (
    ("doc_id", "bigint", pa.int64()), ("n_chars", "bigint", pa.int64()),
    ("edited_sha256", "string", pa.string()), ("fingerprint", "string", pa.string()),
    ("edited_fingerprint", "string", pa.string()),
    ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64()),
)


def edited_text(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compared(doc: int | None, text: str, own: np.ndarray, following: str,
              next_own: np.ndarray, k: int, width: int) -> tuple:
    edited = edited_text(text, following)
    edited_own = sketch(edited, k, width)
    return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(own),
            to_text(edited_own), resemblance(own, edited_own, k), resemblance(own, next_own, k))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _COMPARED]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, (_, _, t) in zip(columns, _COMPARED, strict=True)],
        names=[n for n, _, _ in _COMPARED])
