"""Encoding of texts chunk by chunk, with a bounded cache of chunks already encoded.

Prose repeats its words, so most chunks are found in the cache. Cuts are made only
where the tokenizer's own pre-tokenization always cuts, so that the ids of the chunks,
joined, are those of the whole text. Texts outside that rule are encoded whole.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np

#: White space other than single blanks and line ends between other characters, the
#: mark that cuts chunks, and the start of special tokens.
_UNUSUAL = re.compile(r"\s\s|\A\s|\s\Z|[^\S \n]|\x00|<\|")

#: ASCII punctuation but the apostrophe, which may start a pre-token with letters.
_MARKS = string.punctuation.replace("'", "")

#: Letters by every version of Unicode; those of later versions differ between libraries.
_LATIN = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

#: The letters that byte-level models write for bytes that are not printed.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {byte: 0x100 + n for n, byte in enumerate(sorted({*range(256)} - _PRINTED))}

EncodeMany = Callable[[list[str]], list[bytes]]


def _is_usual(text: str) -> bool:
    """Whether ``_UNUSUAL`` is nowhere in a text; most texts are told without a search."""
    flat = text.replace("\n", " ")
    # Of white space and marks that are not printed only the blank is printable.
    if flat.isprintable():
        return not (flat[0] == " " or flat[-1] == " " or "  " in flat or "<|" in flat)
    return not _UNUSUAL.search(text)


def byte_level_chunks(text: str) -> list[str] | None:
    """Words with the blank before them, and line ends; None for unusual texts.

    A blank between two other characters starts a pre-token of byte-level BPE, and a
    line end between two is one by itself.
    """
    if not text or not _is_usual(text):
        return None if text else []
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


def byte_level_form(word: str) -> str | None:
    """A word of Latin letters in the letters of a byte-level model; None for others."""
    letters = word.removeprefix(" ")
    if letters.isascii():
        if not letters.isalpha():
            return None
    elif _LATIN.fullmatch(letters):
        letters = letters.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return f"Ġ{letters}" if word[0] == " " else letters
    else:
        return None
    return letters if letters is word else f"Ġ{letters}"


def lower_case_form(word: str) -> str | None:
    """The same for a model without blanks."""
    return word if word.isascii() and word.isalpha() else None


def lower_case_chunks(text: str) -> list[str] | None:
    """Lower-case words between ASCII white space, for tokenizers that drop both."""
    if "<|" in text:
        return None
    text = text.encode().lower().decode()
    for space in "\n\t\x0b\x0c\r":
        text = text.replace(space, " ")
    return text.split(" ")


class ChunkCache:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``capacity`` bounds each of the two generations of cached chunks, and chunks of over
    ``longest`` characters are never kept, so both bound the bytes that a worker holds;
    they have no effect on the ids.
    """

    def __init__(self, chunks: Callable[[str], list[str] | None], encode: EncodeMany,
                 encode_whole: EncodeMany, capacity: int = 300_000, longest: int = 64):
        self.chunks, self.encode, self.encode_whole = chunks, encode, encode_whole
        self.capacity, self.longest = capacity, longest
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _fill(self, words: set[str]) -> dict[str, bytes]:
        """Puts all words into the young generation but the long ones, which it returns."""
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, {"": b""}
        if max(map(len, words), default=0) > self.longest:
            long = [w for w in words if len(w) > self.longest]
            self._fill(words.difference(long))
            return dict(zip(long, self.encode_whole(long), strict=True))
        fresh = self._recall(words)
        if not fresh:
            return {}
        # Marks after a letter are no part of its pre-token; words recur with other marks.
        ended = [(w, base, w[len(base):]) for w in fresh
                 if w[-1] in _MARKS and (base := w.rstrip(_MARKS)) and base[-1].isalpha()]
        plain = fresh.difference(w for w, _, _ in ended)
        parts = {part for _, base, marks in ended for part in (base, marks)}
        plain = list(plain | self._recall(parts))
        young = self.young
        young.update(zip(plain, self.encode(plain), strict=True))
        young.update((w, young[base] + young[marks]) for w, base, marks in ended)
        return {}

    def _recall(self, words: set[str]) -> set[str]:
        """The words not in the young generation, after those in the old one were moved."""
        missing = words.difference(self.young)
        known = {w: self.old[w] for w in missing if w in self.old}
        self.young.update(known)
        return missing.difference(known)

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks(text) for text in texts]
        long = self._fill(set().union(*filter(None, cut)))
        found = self.young.__getitem__
        if long:
            found = lambda word: long[word] if word in long else self.young[word]
        whole = [i for i, words in enumerate(cut) if words is None]
        encoded = dict(zip(whole, self.encode_whole([texts[i] for i in whole]), strict=True))
        return [encoded[i] if words is None else b"".join(map(found, words))
                for i, words in enumerate(cut)]


class _Words(dict):
    """Ids of chunks; ``find`` gives those of a chunk that is asked for the first time."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__({"": b""})
        self.find = find

    def __missing__(self, word: str) -> bytes:
        return self.find(word)


class WordCache:
    """What ``ChunkCache`` does, for an encoder that takes one chunk as fast as many.

    Each chunk is looked up once, in its place, and encoded there if it is new; no sets of
    chunks are gathered and compared beforehand, which cost more than the encoding itself.
    """

    def __init__(self, chunks: Callable[[str], list[str] | None], encode: Callable[[str], bytes],
                 encode_whole: EncodeMany, capacity: int = 300_000, longest: int = 64):
        self.chunks, self.encode, self.encode_whole = chunks, encode, encode_whole
        self.capacity, self.longest = capacity, longest
        self.young, self.old = _Words(self._find), _Words(self._find)
        # Long chunks of the text at hand.
        self.long: dict[str, bytes] = {}

    def _find(self, word: str) -> bytes:
        if len(word) > self.longest:
            if word not in self.long:
                self.long[word] = self.encode(word)
            return self.long[word]
        ids = self.old.get(word)
        if ids is None:
            # Marks after a letter are no part of its pre-token; words recur with other marks.
            base = word.rstrip(_MARKS) if word[-1] in _MARKS else ""
            if base and base[-1].isalpha():
                ids = self.young[base] + self.young[word[len(base):]]
            else:
                ids = self.encode(word)
        self.young[word] = ids
        return ids

    def _encoded(self, text: str) -> bytes:
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, _Words(self._find)
        words = self.chunks(text)
        if words is None:
            return self.encode_whole([text])[0]
        ids = b"".join(map(self.young.__getitem__, words))
        self.long.clear()
        return ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        return list(map(self._encoded, texts))


def vocabulary_size(path: str) -> int:
    """One more than the largest id of the tokenizers vocabulary file at ``path``."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0) + 1


def _bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _encoded_whole(tokenizer, texts: list[str]) -> list[bytes]:
    encoded = (tokenizer.encode_batch_fast([t], add_special_tokens=False)[0] for t in texts)
    return [_bytes(e.ids) for e in encoded]


def library_cache(path: str, separator: str, chunks: Callable[[str], list[str] | None],
                  form: Callable[[str], str | None] = lambda word: None) -> ChunkCache:
    """Ids of the tokenizers library for the vocabulary file at ``path``.

    New words that are one pre-token, for which ``form`` gives their letters in the model's
    alphabet, go to the library's model directly. Others are encoded many at a time, joined
    by ``separator``, which must be cut off by pre-tokenization and end in one id of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    (mark,) = tokenizer.encode(separator, add_special_tokens=False).ids
    whole = partial(_encoded_whole, tokenizer)

    def groups(words: list[str]) -> Iterator[list[str]]:
        for start in range(0, len(words), 1000):
            yield words[start : start + 1000]

    pieces = tokenizer.model.tokenize

    def many(words: list[str]) -> list[bytes]:
        forms = list(map(form, words))
        rest = iter(joined([w for w, f in zip(words, forms) if f is None]))
        return [next(rest) if f is None else array("I", [p.id for p in pieces(f)]).tobytes()
                for f in forms]

    def joined(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for group in groups(words):
            one = tokenizer.encode_batch_fast([separator.join(group)], add_special_tokens=False)
            ids = np.asarray(one[0].ids, dtype="<u4")
            ends = np.flatnonzero(ids == mark)
            if len(ends) == len(group) - 1 and not any(separator.strip(" ") in w for w in group):
                out += [part.tobytes() for part in _between(ids, ends)]
            else:
                out += whole(group)
        return out

    return ChunkCache(chunks, many, whole)


def library_words(path: str, chunks: Callable[[str], list[str] | None],
                  form: Callable[[str], str | None]) -> WordCache:
    """Ids of the tokenizers library for the vocabulary file at ``path``, word by word.

    Words that are one pre-token, for which ``form`` gives their letters in the model's
    alphabet, go to the library's model directly.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    whole, pieces = partial(_encoded_whole, tokenizer), tokenizer.model.tokenize

    def encode(word: str) -> bytes:
        letters = form(word)
        if letters is None:
            return whole([word])[0]
        return array("I", [p.id for p in pieces(letters)]).tobytes()

    return WordCache(chunks, encode, whole)


def _between(ids: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    start = 0
    for end in ends:
        yield ids[start:end]
        start = end + 1
    yield ids[start:]
