"""Token ids in files of independent zstandard frames with a seek table.

Layout of a file, all numbers little-endian:

* data frames: one zstandard frame each, holding the ids of whole documents in a row;
* a skippable frame (magic 0x184D2A50) with the document index: ids of the documents,
  the frame and the number of ids of each;
* the seek table, the skippable frame of the published zstandard seekable format: for
  every frame before it the compressed size, decompressed size and the low 32 bits of
  the XXH64 of the content, then the number of frames, a descriptor and a magic number.

A reader fetches the seek table and the index, then only the frames of the documents
asked for, and checks each against its checksum. Any zstandard tool can unpack a file.

Null texts count as empty; a null ``doc_id`` sorts first and is kept as null; repeated
rows are written each; an empty table writes no file. Files are named by their place in
the order and written under another name first, so a repeated task replaces its file
by an equal one.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.tables import (
    bounded_slices, in_arrow, kept_by_worker, partitions_for, texts_of, written,
)
from hitloom.llm.word_cache import (
    library_cache,
    lower_case_chunks,
    lower_case_form,
    vocabulary_size,
)
from hitloom.session import fresh_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
FRAME_IDS = 1 << 18

# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

MANIFEST = "part int, file string, n_docs bigint, n_tokens bigint, n_bytes bigint"


class TokenFileWriter:
    """Writes documents in the order given; ``frame_ids`` closes a frame once reached."""

    def __init__(self, out, wide: bool = False, frame_ids: int = FRAME_IDS):
        self.out, self.frame_ids = out, frame_ids
        self.kind = np.dtype("<u4" if wide else "<u2")
        self.pack = zstandard.ZstdCompressor(level=1, write_checksum=True).compress
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = self.n_bytes = 0
        self.seek: list[tuple[int, int, int]] = []
        self.keys: list[int | None] = []
        self.frames: list[int] = []
        self.lengths: list[int] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        """Raises OverflowError for an id that the file's width cannot hold."""
        if len(ids) and (ids.max() > np.iinfo(self.kind).max or ids.min() < 0):
            raise OverflowError(f"ids up to {ids.max()} do not fit {self.kind.itemsize} bytes")
        self.keys.append(key)
        self.frames.append(len(self.seek))
        self.lengths.append(len(ids))
        self.waiting.append(ids.astype(self.kind))
        self.n_waiting += len(ids)
        self.n_tokens += len(ids)
        if self.n_waiting >= self.frame_ids:
            self._close_frame()

    def _put(self, frame: bytes, content: bytes | None) -> None:
        self.out.write(frame)
        self.n_bytes += len(frame)
        checksum = xxhash.xxh64_intdigest(content or b"") & 0xFFFFFFFF
        self.seek.append((len(frame), len(content or b""), checksum))

    def _close_frame(self) -> None:
        content = b"".join(part.tobytes() for part in self.waiting)
        self._put(self.pack(content), content)
        self.waiting, self.n_waiting = [], 0

    def finish(self) -> None:
        if self.keys and self.frames[-1] == len(self.seek):
            self._close_frame()
        index = self.pack(b"".join([
            struct.pack("<BI", self.kind.itemsize, len(self.keys)),
            np.array([key is None for key in self.keys], np.uint8).tobytes(),
            np.array([key or 0 for key in self.keys], "<i8").tobytes(),
            np.array(self.frames, "<u4").tobytes(),
            np.array(self.lengths, "<u4").tobytes(),
        ]))
        self._put(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index, None)
        table = b"".join(struct.pack("<III", *entry) for entry in self.seek)
        table += struct.pack("<IBI", len(self.seek), HAS_CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.n_bytes += 8 + len(table)


class TokenFileReader:
    """Reads documents of one open, seekable file."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        count, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not descriptor & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table = self._at(size - 9 - 12 * count, 12 * count)
        self.seek = np.frombuffer(table, "<u4").reshape(count, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.seek[:, 0], dtype=np.int64)])
        index = self._at(int(self.starts[-2]) + 8, int(self.seek[-1, 0]) - 8)
        index = zstandard.ZstdDecompressor().decompress(index)
        width, n = struct.unpack_from("<BI", index)
        self.kind = np.dtype(f"<u{width}")
        null = np.frombuffer(index, np.uint8, n, 5).astype(bool)
        keys = np.frombuffer(index, "<i8", n, 5 + n)
        self.keys = [None if no else int(key) for no, key in zip(null, keys, strict=True)]
        self.frames = np.frombuffer(index, "<u4", n, 5 + 9 * n)
        self.lengths = np.frombuffer(index, "<u4", n, 5 + 13 * n).astype(np.int64)
        ends = np.cumsum(self.lengths)
        self.begins = ends - self.lengths  # in ids, over the whole file
        first = np.searchsorted(self.frames, np.arange(count))
        self.frame_begins = np.concatenate([self.begins, [0]])[np.minimum(first, n)]

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def frame(self, number: int) -> np.ndarray:
        packed = self._at(int(self.starts[number]), int(self.seek[number, 0]))
        content = zstandard.ZstdDecompressor().decompress(packed)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != int(self.seek[number, 2]):
            raise ValueError(f"frame {number} does not match its checksum")
        return np.frombuffer(content, self.kind)

    def places(self, places: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of documents by their place in the file, one frame at a time."""
        held, ids = -1, np.empty(0, self.kind)
        for place in sorted(places):
            frame = int(self.frames[place])
            if frame != held:
                held, ids = frame, self.frame(frame)
            at = int(self.begins[place] - self.frame_begins[frame])
            yield place, ids[at : at + int(self.lengths[place])]

    def documents(self, keys: Iterable[int | None]) -> Iterator[tuple[int | None, np.ndarray]]:
        """(key, ids) of the documents asked for; other frames are not unpacked."""
        wanted = set(keys)
        for place, ids in self.places(i for i, key in enumerate(self.keys) if key in wanted):
            yield self.keys[place], ids


@kept_by_worker
def _encoder(path: str):
    # The mark is cut off by the blanks, which pre-tokenization drops.
    return library_cache(path, " \x01 ", lower_case_chunks, lower_case_form)


def write_token_files(documents: DataFrame, folder: str, text: str = "text",
                      key: str = "doc_id", path: str | None = None, end_id: int = END_ID,
                      wide: bool | None = None) -> DataFrame:
    """Encodes every whole text, appends ``end_id`` and writes the ids in order of ``key``.

    Returns the manifest, one row per file in order. The texts are shuffled once, by
    ranges of the key. ``folder`` must be one that pyarrow can open on every executor;
    ``wide`` stores 32 bits an id, else 16; by default as the vocabulary and ``end_id`` need.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    if wide is None:
        wide = max(vocabulary_size(path) - 1, end_id) > np.iinfo(np.uint16).max
    ordered = (
        documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, writer = _encoder(path), TaskContext.get().partitionId(), None
        store, place = fs.FileSystem.from_uri(folder)
        name = f"tokens-{part:06d}.zst"
        trial = f"{place}/.{name}.{uuid.uuid4().hex}"
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            if keys and writer is None:
                store.create_dir(place)
                writer = TokenFileWriter(store.open_output_stream(trial, compression=None), wide)
            for some in bounded_slices(texts):
                for k, ids in zip(keys[some], encode(texts[some]), strict=True):
                    writer.add(k, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)))
        if writer is not None:
            writer.finish()
            writer.out.close()
            store.move(trial, f"{place}/{name}")
            row = [part], [name], [len(writer.keys)], [writer.n_tokens], [writer.n_bytes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), *[pa.int64()] * 3),
                                                strict=True)],
                names=["part", "file", "n_docs", "n_tokens", "n_bytes"])

    return written(in_arrow(ordered, write, MANIFEST, keeps=_encoder), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: key, start, n_tokens and the ids as stored (binary).

    ``start`` counts the ids of all documents before it; only the totals of the files
    are summed in one place.
    """
    based = manifest.select(
        "part", "file",
        F.coalesce(F.sum("n_tokens").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist(),
                                  strict=True):
                with store.open_input_file(f"{place}/{name}") as file:
                    reader = TokenFileReader(file)
                    for start in range(0, len(reader.keys), 1000):
                        some = range(start, min(start + 1000, len(reader.keys)))
                        ids = [part.astype("<u4").tobytes() for _, part in reader.places(some)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([reader.keys[i] for i in some], pa.int64()),
                            pa.array(base + reader.begins[some.start : some.stop]),
                            pa.array(reader.lengths[some.start : some.stop]),
                            pa.array(ids, pa.binary()),
                        ], names=["doc_id", "start", "n_tokens", "ids"])

    files = partitions_for(manifest.count(), 1)
    return in_arrow(
        based.repartition(files, "part"), read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_file_folder(documents: DataFrame) -> str:
    return fresh_folder(documents.sparkSession, "token-files")


