"""Byte-level BPE encoding and decoding.

Texts are cut by a pre-tokenization pattern. A pre-token that is in the vocabulary is
resolved by a minimal perfect hash; any other is merged with a heap over its linked
bytes, always the pair of lowest rank first and the leftmost among equals.

Null texts count as empty and have no ids. Repeated rows and ties are encoded each by
itself; other columns, of whatever name, are left out of the result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from hitloom.llm.tables import bounded_slices, in_arrow, kept_by_worker, mix64, texts_of
from hitloom.llm.word_cache import ChunkCache, byte_level_chunks

VOCABULARY = "byte_bpe_50k.tiktoken"


class PerfectHash:
    """A minimal perfect hash of byte strings (hash and displace).

    Keys fall into buckets of four on average; each bucket, largest first, takes the
    first displacement that sends its keys to free slots. A slot keeps the key's
    64-bit hash, so a stranger is told apart, and at last its bytes are compared.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        hashes = self.hash_many(keys)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys share a 64-bit hash")
        n_buckets = max(1, len(keys) // 4)
        self.displace = np.zeros(n_buckets, dtype=np.uint64)
        bucket = hashes % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        free = np.ones(len(keys), dtype=bool)
        self.index = np.zeros(len(keys), dtype=np.int64)
        for b in np.argsort(starts[:-1] - starts[1:], kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if not len(members):
                break
            tried = 0
            while True:
                # Many displacements at a time: the last buckets look for rare slots.
                steps = np.arange(tried, tried + 256, dtype=np.uint64)
                slots = self._slots(hashes[members][None, :], steps[:, None])
                good = free[slots].all(axis=1)
                if len(members) > 1:
                    sorted_slots = np.sort(slots, axis=1)
                    good &= (sorted_slots[:, 1:] != sorted_slots[:, :-1]).all(axis=1)
                if good.any():
                    at = int(good.argmax())
                    self.displace[b] = steps[at]
                    free[slots[at]] = False
                    self.index[slots[at]] = members
                    break
                tried += 256
        self.hashes = hashes[self.index]
        self.keys = [keys[i] for i in self.index]

    @staticmethod
    def hash_many(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slots(self, hashes: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = mix64(hashes + displacement * np.uint64(0x9E3779B97F4A7C15))
        return (mixed % np.uint64(self.size)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The position of each key in the list it was built from, or -1."""
        if not self.size or not keys:
            return [-1] * len(keys)
        hashes = self.hash_many(keys)
        slots = self._slots(hashes, self.displace[hashes % np.uint64(len(self.displace))])
        hit = self.hashes[slots] == hashes
        return [int(self.index[s]) if h and self.keys[s] == key else -1
                for key, s, h in zip(keys, slots.tolist(), hit.tolist(), strict=True)]


class ByteBPE:
    """Encoder and decoder for a file of base64 tokens and their ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        tokens = [base64.b64decode(token) for token, _ in pairs]
        ids = [int(rank) for _, rank in pairs]
        self.tokens: list[bytes | None] = [None] * (max(ids, default=-1) + 1)
        for token, rank in zip(tokens, ids, strict=True):
            self.tokens[rank] = token
        self.ranks = dict(zip(tokens, ids, strict=True))
        self.ids = ids
        self.whole = PerfectHash(tokens)
        self.pattern = regex.compile(pattern)
        # Chunks are known to be safe cuts for the published pattern only.
        chunks = byte_level_chunks if pattern == public_tokenizers.PATTERN else lambda text: None
        self.encode_texts = ChunkCache(chunks, self._encode_many, self._encode_many)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token that is not in the vocabulary."""
        rank_of, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 once merged away
        before = list(range(-1, n))
        heap = [(rank, i) for i in range(n - 1)
                if (rank := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rank, left = pop(heap)
            right = end[left]
            # The pair may have changed since it was put here.
            if not right or right == n or rank_of(piece[left : end[right]]) != rank:
                continue
            after = end[left] = end[right]
            end[right] = 0
            if after < n:
                before[after] = left
                if (rank := rank_of(piece[left : end[after]])) is not None:
                    push(heap, (rank, left))
            if left and (rank := rank_of(piece[before[left] : after])) is not None:
                push(heap, (rank, before[left]))
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def _encode_many(self, texts: list[str]) -> list[bytes]:
        cut = [[piece.encode() for piece in self.pattern.findall(text)] for text in texts]
        distinct = list({piece for pieces in cut for piece in pieces})
        ids = {
            piece: np.asarray([self.ids[at]] if at >= 0 else self.merge(piece), "<u4").tobytes()
            for piece, at in zip(distinct, self.whole.find(distinct), strict=True)
        }
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@kept_by_worker
def tokenizer(path: str, pattern: str) -> ByteBPE:
    """One per worker process, kept between tasks."""
    return ByteBPE(path, pattern)


def encode_documents(documents: DataFrame, text: str = "text", key: str = "doc_id",
                     path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The key and ``ids`` (array of int) of every whole text.

    ``path`` must be readable on every executor.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    pattern = pattern or public_tokenizers.PATTERN
    kept = documents.select(key, text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for part in bounded_slices(texts):
                encoded = bpe.encode_texts(texts[part])
                offsets = np.cumsum([0, *map(len, encoded)]) // 4
                ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start : part.stop],
                     pa.ListArray.from_arrays(offsets.astype(np.int32), ids)],
                    names=[key, "ids"])

    return in_arrow(kept, encode, f"`{key}` {dict(kept.dtypes)[key]}, ids array<int>",
                    keeps=tokenizer)


def decode_documents(encoded: DataFrame, key: str = "doc_id", ids: str = "ids",
                     path: str | None = None) -> DataFrame:
    """Every row's ids as given and ``decoded``, the bytes they stand for."""
    path = path or public_tokenizers.path(VOCABULARY)
    kept = encoded.select(key, ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(path, public_tokenizers.PATTERN).tokens
        for batch in batches:
            column = batch.column(1)
            values, at = column.values.to_numpy(), column.offsets.to_numpy()
            decoded = [b"".join(map(tokens.__getitem__, values[start:end].tolist()))
                       for start, end in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(decoded, pa.binary())],
                names=[key, ids, "decoded"])

    return in_arrow(
        kept, decode, f"`{key}` {dict(kept.dtypes)[key]}, `{ids}` array<int>, decoded binary",
        keeps=tokenizer)
