"""Input tables and the written tables that operators hand on."""

from __future__ import annotations

import ctypes
import math
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitloom.session import fresh_folder

ArrowFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

#: Batches that executors make and a worker takes at a time; one row may be larger.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped_to: set[str] = set()

#: What functions of this package keep in a worker from task to task.
_kept: list = []


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python
    workers can import it wherever it was started from."""
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="hitloom-package-"), "hitloom.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "hitloom")):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, root))
    context.addPyFile(path)
    _shipped_to.add(context.applicationId)


def _halved(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about so many bytes, one row each at least."""
    if batch.nbytes <= most_bytes or batch.num_rows < 2:
        yield batch
        return
    middle = batch.num_rows // 2
    yield from _halved(batch.slice(0, middle), most_bytes)
    yield from _halved(batch.slice(middle), most_bytes)


def let_go_but(keeps: Callable | None) -> None:
    """Drops what ``kept_by_worker`` keeps for functions other than ``keeps``."""
    for cached in _kept:
        if cached is not keeps:
            cached.cache_clear()


def _give_memory_back() -> None:
    """Workers serve later stages too; what this one has freed should not stay theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def kept_by_worker(make: Callable) -> Callable:
    """``make`` with its last two results kept, until a task runs that does not keep them."""
    cached = lru_cache(maxsize=2)(make)
    _kept.append(cached)
    return cached


def _bound_batches(spark: SparkSession) -> None:
    """Let executors make batches of ``BATCH_BYTES``, unless the session's user has set others.

    Spark's own bound is 64 MB, so a task of texts would put its whole split into one.
    """
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def in_arrow(frame: DataFrame, run: ArrowFunction, schema: str | StructType,
             most_bytes: int = BATCH_BYTES, keeps: Callable | None = None) -> DataFrame:
    """``mapInArrow`` over batches of bounded size, by workers that have this package.

    The package is sent first, since a worker gets what was sent before its function. Of what
    ``kept_by_worker`` kept for earlier tasks only that of ``keeps`` stays.
    """
    ship_package(frame.sparkSession)
    _bound_batches(frame.sparkSession)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_but(keeps)
        try:
            yield from run(part for batch in batches for part in _halved(batch, most_bytes))
        finally:
            _give_memory_back()

    return frame.mapInArrow(bounded, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as Parquet in the shared folder, read again.

    Cuts the lineage without blocks that die with an executor.
    """
    folder = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def partitions_for(rows: int, rows_each: int) -> int:
    """Enough partitions for so many rows in each."""
    return max(1, math.ceil(rows / rows_each))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch column; null counts as empty."""
    return ["" if text is None else text for text in column.to_pylist()]


def rows_with_text(documents: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``row``, a struct of the columns to keep, and the text where it is none of them, so
    that no text goes to a worker twice."""
    row = F.struct(*keep).alias("row")
    return documents.select(row, *([] if text in keep else [F.col(text).alias("text")]))


def row_texts(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a batch of ``rows_with_text``; null counts as empty."""
    if batch.num_columns > 1:
        return texts_of(batch.column(1))
    return texts_of(batch.column(0).field(text))


def bounded_slices(texts: list[str], most_chars: int = 2_000_000) -> Iterable[slice]:
    """Slices of consecutive texts of about ``most_chars``, at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most_chars:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


class Membership:
    """A fixed-size bitmap over hashed 64-bit values.

    It may claim values it was not given, never the reverse, and its size does not
    grow with the data, so it can go to every task.
    """

    BITS = 1 << 24

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, values: DataFrame, column: str) -> Membership:
        """Of a bigint column; at most ``BITS / 64`` words reach the driver."""
        bit = F.pmod(F.col(column), F.lit(cls.BITS))
        words = (
            values.where(F.col(column).isNotNull())
            .select(F.shiftright(bit, 6).alias("word"), (bit % 64).cast("int").alias("bit"))
            .groupBy("word")
            .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        )
        table = words.toArrow()
        held = np.zeros(cls.BITS // 64, dtype=np.uint64)
        held[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
        return cls(held)

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Whether each signed or unsigned 64-bit value may be a member."""
        bit = values.astype(np.uint64, copy=False) & np.uint64(self.BITS - 1)
        return (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
