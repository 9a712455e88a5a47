"""Sets of hashed word shingles, computed for many texts at a time."""

from __future__ import annotations

import numpy as np

from hitloom.llm.tables import mix64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ROOT = 0xD1342543DE82EF95
_INVERSE = np.uint64(pow(_ROOT, -1, 1 << 64))
_FOLD = np.uint64(0xA0761D6478BD642F)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of every text's runs of ``width`` words.

    Words lie between ASCII white space, with A-Z lower-cased. A text of fewer words is
    one shingle, a text without words has none.
    """
    packed = [text.encode() for text in texts]
    # A blank after each text keeps words of different texts apart.
    data = _LOWER[np.frombuffer(b" ".join(packed) + b" ", np.uint8)]
    ends = np.cumsum([len(p) + 1 for p in packed])
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    starts, stops = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.concatenate([
            np.zeros(1, np.uint64),
            np.cumsum(_BYTE_VALUES[data] * _powers(np.uint64(_ROOT), len(data)), dtype=np.uint64),
        ])
        words = mix64((sums[stops] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts])
        first = np.searchsorted(starts, ends - np.array([len(p) + 1 for p in packed]))
        last = np.searchsorted(starts, ends)
        runs = words[: max(0, len(words) - width + 1)].copy()
        for i in range(1, width):
            runs = runs * _FOLD + words[i : i + len(runs)]
        runs = mix64(runs)
        out = []
        for begin, end in zip(first.tolist(), last.tolist(), strict=True):
            n = end - begin
            if n >= width:
                out.append(np.unique(runs[begin : end - width + 1]))
            elif n:
                whole = np.uint64(n)
                for word in words[begin:end]:
                    whole = whole * _FOLD + word
                out.append(mix64(np.array([whole], dtype=np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
    return out
