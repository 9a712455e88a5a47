"""Spelling variants by a variable-length gram index.

A gram dictionary is pruned by frequency: grams of ``SHORTEST`` letters are all kept, and
a gram grows by a letter only while it is frequent, up to ``LONGEST``. From every place of
a word the longest gram of the dictionary is taken. Which letters were looked at to take a
gram is known, so for an edit at a place of the word so are the grams that the edit can
affect; all others must stand in the other word too, left of the edit at the same place
and right of it at the same distance from the end. A word has at least one such gram for
every edit, since an edit affects ``LONGEST`` grams at most and words are long enough.

So for one edit the lists of all unaffected grams have to be merged in full. The merge is a
join: a word is listed under one key for each edit, made of the grams that the edit leaves
alone, and two words one edit apart share the key of that edit, as both decompose alike
away from it. Words that meet are verified by their edit distance inside the join, so only
near pairs leave it. Only frequent grams reach every task; there are at most
``PARTS * LONGEST`` times the mean word length of them, whatever the number of words.

Null and empty texts have no words, a null ``doc_id`` counts as an empty one, repeated
rows count again, and texts may be of any length. An empty table gives no words. Other
columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.tables import bounded_slices, in_arrow, texts_of, written

#: Letters of the shortest and longest grams; a gram is frequent above words / PARTS.
SHORTEST, LONGEST, PARTS = 2, 4, 2000
#: A word is another one's form when it is near and at least so many times as frequent.
TIMES = 10

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_counts(documents: DataFrame, min_chars: int, min_count: int,
                letters: str = "A-Za-zÀ-ÿ", drop_one_in: int | None = None) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased, of enough code points and
    occurrences in the texts of (doc_id, text).

    With ``drop_one_in`` a run loses one code point where that number divides the crc32 of
    ``<doc_id>:<run>``, which plants misspellings; lengths and counts are those after it.
    """

    def count(ids: list, texts: list[str]) -> Counter:
        found: Counter = Counter()
        # A run that is too short before a code point is dropped is too short after it.
        runs = re.compile(f"[{letters}]{{{max(1, min_chars)},}}")
        for key, text in zip(ids, texts):
            start = zlib.crc32(f"{'' if key is None else key}:".encode())
            for run in runs.findall(text.encode().translate(_LOWER).decode()):
                if drop_one_in:
                    h = zlib.crc32(run.encode(), start)
                    if h % drop_one_in == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < min_chars:
                            continue
                found[run] += 1
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), texts_of(batch["text"])
            for part in bounded_slices(texts):
                found = count(ids[part], texts[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array(found.values(), pa.int64())],
                    names=["word", "n"])

    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return (
        in_arrow(texts, run, "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    )


def frequent_grams(words: DataFrame) -> set[str]:
    """The grams that grow by a letter; their number is bounded (see above)."""
    lengths = words.agg(F.count("*").alias("n"), F.max(F.length("word"))).first()
    if not lengths.n:
        return set()
    grams = F.expr(
        f"flatten(transform(sequence({SHORTEST}, {LONGEST - 1}), q -> transform("
        f"sequence(1, greatest(length(word) - q + 1, 1)), p -> substring(word, p, q))))")
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").count()
    frequent = counted.where(F.col("count") > max(1.0, lengths.n / PARTS)).select("gram")
    return set(frequent.toArrow()["gram"].to_pylist())


def decompose(word: str, frequent: set[str]) -> tuple[list[str], list[int]]:
    """For each place the gram that starts there, and the last place looked at for it.

    The place after the last letter is looked at too when a gram could have grown there.
    """
    grams, looked = [], []
    for start in range(len(word) - SHORTEST + 1):
        end = start + SHORTEST
        while end - start < LONGEST and end < len(word) and word[start:end] in frequent:
            end += 1
        gram = word[start:end]
        grams.append(gram)
        looked.append(end if end - start < LONGEST and gram in frequent else end - 1)
    return grams, looked


def affected(looked: list[int], place: int) -> list[int]:
    """Starts of the grams that an edit at ``place``, or before it, can affect."""
    return [start for start, last in enumerate(looked) if start <= place <= last]


def edit_keys(word: str, frequent: set[str]) -> list[tuple[int, int]]:
    """(key, role) for every edit: role 0 for a replaced letter, 1 for one inserted into
    this word and 2 for one deleted from it; roles 1 and 2 share their keys.

    The grams right of an edit are told by the letters they spell.
    """
    size = len(word)
    grams, looked = decompose(word, frequent)
    named = [f"{start}{gram}" for start, gram in enumerate(grams)]
    keys = set()
    for place in range(size + 1):
        left = ",".join(named[start] for start in range(min(place, len(grams)))
                        if looked[start] < place)
        rest, after = word[place:], word[place + 1:]
        rest = rest if len(rest) >= SHORTEST else ""
        after = after if len(after) >= SHORTEST else ""
        keys.add((xxhash.xxh3_64_intdigest(f"i{size},{left},,{rest}"), 1))
        if place < size:
            keys.add((xxhash.xxh3_64_intdigest(f"i{size - 1},{left},,{after}"), 2))
            keys.add((xxhash.xxh3_64_intdigest(f"r{size},{left},,{after}"), 0))
    return [(key - (1 << 64) if key >> 63 else key, role) for key, role in keys]


def gram_index(words: DataFrame, frequent: set[str]) -> DataFrame:
    """(key, role, word, n): every word under the keys of its edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = batch["word"].to_pylist(), batch["n"].to_pylist()
            for part in bounded_slices(texts, 20_000):
                rows = [(key, role, word, n) for word, n in zip(texts[part], counts[part])
                        for key, role in edit_keys(word, frequent)]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int8()),
                     pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())],
                    names=["key", "role", "word", "n"])

    return in_arrow(words, run, "key bigint, role tinyint, word string, n bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every two words of (word, n) that are one edit apart, once.

    Words must have at least ``SHORTEST + LONGEST`` letters.
    """
    indexed = written(gram_index(words, frequent_grams(words)), "gram-index")
    one = indexed.where("role < 2").select(
        "key", "role", F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = indexed.where("role <> 1").select(
        "key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = ((F.col("role") == 1) | (F.col("a") < F.col("b"))) & (
        F.levenshtein("a", "b", 1) == 1)
    met = one.join(other, (one["key"] == other["key"]) & near)
    return met.select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form): forms followed to the last.

    Each round doubles the steps followed, and forms are ``TIMES`` as frequent at each
    step, so rounds are few whatever the data.
    """
    held = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        held = written(held.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "forms")
        if held.where("moved").isEmpty():
            return held.select("word", "root")
        held = held.select("word", "root")


def group_variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all (word, n).

    The form is the most frequent near word, the smallest in code-point order among
    equals, if it occurs at least ``TIMES`` as often; the root is the last of the forms
    that follow each other, the word itself if it has none.
    """
    pairs = written(near_pairs(words), "near-words")
    back = pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"),
                        F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    best = pairs.unionByName(back).groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    known = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "word-forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def variant_groups(documents: DataFrame, min_chars: int = 7, min_count: int = 2,
                   drop_one_in: int | None = None) -> DataFrame:
    """``group_variants`` of the words of (doc_id, text)."""
    if min_chars < SHORTEST + LONGEST:
        raise ValueError(f"words need {SHORTEST + LONGEST} letters at least")
    counted = word_counts(documents, min_chars, min_count, drop_one_in=drop_one_in)
    return group_variants(written(counted, "words"))
