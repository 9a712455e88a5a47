"""Packing of documents into sequences by patterns fitted to the length histogram.

Documents longer than a sequence are cut into pieces; the first piece takes the rest,
so all others fill a sequence each. Pieces shorter than a sequence are packed by
patterns: multisets of one to three lengths that fill a sequence exactly. Repeat
counts come from non-negative least squares against the histogram of lengths, are
rounded down, and what is left over is packed best fit, longest first, also on the
histogram. The driver only ever sees the histogram, as long as a sequence at most.

Null texts count as empty and hold the end id alone. Equal lengths are told apart by
their rank in an order of (doc_id, piece); repeated rows get ranks of their own. An
empty table gives no pieces. Other columns are left out of the result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.tables import (
    bounded_slices, in_arrow, kept_by_worker, partitions_for, texts_of, written,
)
from hitloom.llm.word_cache import byte_level_chunks, byte_level_form, library_words

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SEQUENCE = 1024
RANKED_ROWS = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@kept_by_worker
def _encoder(path: str):
    return library_words(path, byte_level_chunks, byte_level_form)


def document_pieces(documents: DataFrame, text: str = "text", key: str = "doc_id",
                    path: str | None = None, end_id: int = END_ID,
                    most: int = SEQUENCE) -> DataFrame:
    """Every piece of every whole text's ids: key, piece, start, length and crc32."""
    path = path or public_tokenizers.path(VOCABULARY)
    end = np.uint32(end_id).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for some in bounded_slices(texts):
                rows: list[list] = [[], [], [], [], []]
                for k, ids in zip(keys[some], encode(texts[some]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    first = n % most or most
                    for piece, stop in enumerate(range(first, n + 1, most)):
                        start = max(0, stop - most) if piece else 0
                        values = (k, piece, start, stop - start,
                                  zlib.crc32(ids[4 * start : 4 * stop]))
                        for column, value in zip(rows, values, strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(rows, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kept = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return in_arrow(kept, cut, PIECES, keeps=_encoder)


def exact_patterns(most: int) -> np.ndarray:
    """All multisets of up to three lengths that sum to ``most``; 0 stands for no length."""
    low, mid = np.meshgrid(np.arange(most // 3 + 1), np.arange(most // 2 + 1), indexing="ij")
    high = most - low - mid
    keep = (low <= mid) & (mid <= high)
    return np.stack([low[keep], mid[keep], high[keep]], axis=1)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 1500) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|, A[l, p] the times
    that pattern p holds length l.

    Accelerated projected gradient; both products with A are gathers, so its hundreds of
    thousands of columns are never stored.
    """
    size, flat = len(histogram), patterns.ravel()
    target = histogram.astype(float)
    target[0] = 0.0

    def filled(x: np.ndarray) -> np.ndarray:
        got = np.bincount(flat, np.repeat(x, 3), size)
        got[0] = 0.0
        return got

    # The largest eigenvalue of A'A bounds the step; power iteration finds it.
    v = np.ones(len(patterns))
    for _ in range(20):
        v = filled(v / np.linalg.norm(v))[patterns].sum(axis=1)
    step = 0.95 / np.linalg.norm(v)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        gap = filled(y) - target
        new = np.maximum(0.0, y - step * gap[patterns].sum(axis=1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def pack_histogram(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), using every length up.

    ``histogram[l]`` is the number of pieces of length l, up to the sequence length.
    """
    most = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    plan: dict[tuple[int, ...], int] = {}
    patterns = exact_patterns(most)
    usable = ((left[patterns] > 0) | (patterns == 0)).all(axis=1)
    patterns = patterns[usable]
    if len(patterns):
        counts = fit_counts(patterns, left)
        for p in np.argsort(-counts, kind="stable"):
            times = int(np.round(counts[p]))
            lengths, held = np.unique(patterns[p][patterns[p] > 0], return_counts=True)
            times = min(times, int((left[lengths] // held).min()))
            if times > 0:
                left[lengths] -= held * times
                key = tuple(int(v) for v in patterns[p] if v)
                plan[key] = plan.get(key, 0) + times
    for lengths, times in best_fit(left):
        plan[lengths] = plan.get(lengths, 0) + times
    return sorted(plan.items())


def best_fit(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, many equal sequences at a time."""
    most = len(histogram) - 1
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        room = most - sum(lengths)
        if room not in open_by_room:
            bisect.insort(rooms, room)
            open_by_room[room] = []
        open_by_room[room].append((lengths, times))

    for length in range(most, 0, -1):
        n = int(histogram[length])
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = most // length
                if n >= each:
                    put((length,) * each, n // each)
                    n %= each
                if n:
                    put((length,) * n, 1)
                    n = 0
                break
            room = rooms[at]
            lengths, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room], rooms[at]
            if times > n:
                put(lengths, times - n)
                times = n
            put((*lengths, length), times)
            n -= times
    return [done for group in open_by_room.values() for done in group]


class Placement:
    """For the r-th piece of each length its sequence and offset, as sorted intervals."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]], most: int):
        rows: list[tuple[int, int, int, int, int]] = []
        used = [0] * (most + 1)
        first_sequence = 0
        for lengths, times in plan:
            offset = 0
            for length in sorted(set(lengths)):
                each = lengths.count(length)
                rows.append((length, used[length], first_sequence, each, offset))
                used[length] += each * times
                offset += each * length
            first_sequence += times
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.length, self.rank, self.sequence, self.each, self.offset = table.T.copy()
        self.first = np.searchsorted(self.length, np.arange(most + 2))
        self.n_sequences = first_sequence

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), dtype=np.int64)
        for value in np.unique(length):
            mine = length == value
            low, high = self.first[value], self.first[value + 1]
            at[mine] = low + np.searchsorted(self.rank[low:high], rank[mine], side="right") - 1
        turn = rank - self.rank[at]
        return (self.sequence[at] + turn // self.each[at],
                self.offset[at] + turn % self.each[at] * length)


def pack_pieces(pieces: DataFrame, most: int = SEQUENCE,
                ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """Every column of ``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` needs doc_id, piece and length, and should be a stored table, since it is
    read three times. Ranks within a length are counted in hashed buckets of about
    ``ranked_rows`` pieces at most, so a length that most pieces share is not ranked in
    one task.
    """
    by_length = {row.length: row.n for row in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(most + 1, dtype=np.int64)
    for length, n in by_length.items():
        histogram[length] = n
    place = Placement(pack_histogram(histogram), most)
    buckets = max(64, partitions_for(int(histogram.max()), ranked_rows))
    spread = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = (
        spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(
            Window.partitionBy("length").orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    )
    ranked = (
        spread.withColumn("rank", F.row_number().over(
            Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1)
        .join(before, ["length", "bucket"])
        .select(*pieces.columns, (F.col("before") + F.col("rank")).alias("rank"))
    )
    shared, names = pieces.sparkSession.sparkContext.broadcast(place), pieces.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return in_arrow(ranked, assign, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(documents: DataFrame, most: int = SEQUENCE, **options: object) -> DataFrame:
    """Cuts and packs every whole text; one row per piece."""
    return pack_pieces(written(document_pieces(documents, most=most, **options), "pieces"), most)
