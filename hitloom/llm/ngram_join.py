"""Set similarity join on word n-grams by vertical partitioning.

Two documents link when the Jaccard similarity of their n-gram sets reaches
``num / den``. Equal sets are joined first and stand for one another. The n-grams have
one global order: those seen often come last, and within both kinds they go by their
hash. A set of n that reaches the threshold with another shares an n-gram among its
first n - ceil(n * num / den) + 1, so candidates meet there, where n-grams are rare.
Candidates are verified vertically: the order is cut into fragments, each fragment
counts its part of the overlap by itself, and the counts are summed per pair. A pair
whose sets differ by too much in the first fragment alone needs no others.

Of the documents that meet under an n-gram, only pairs with a leader are verified at
first. Once these are joined to components, all other pairs that meet and lie in
different components are verified as well, so no component is missed, while a group of
copies costs as many pairs as it has members.

Two exact bounds keep most candidates from verification: the places of the n-gram two
documents meet under, and an odd sketch of each set, the parities of its n-grams in 1,024
cells. The cells in which two sketches differ are no more than the n-grams only one has.

The leader is the document that has the n-gram earliest in its order, so the one with
the fewest n-grams of its own before it: the middle of a group of edited copies.

"Often" comes from counts over all documents and is kept in a bitmap of fixed size. It
decides about the work alone: the result is the same for any order.

Null, empty and blank texts have no n-grams and link with nothing. Rows without
``doc_id`` are returned without a component and not compared. Repeated rows are copies. An
empty table gives an empty result. Other columns are left out. Sets are told apart by a
64-bit hash, n-grams too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.components import connected_components
from hitloom.llm.shingles import shingle_sets
from hitloom.llm.tables import Membership, bounded_slices, in_arrow, texts_of, written

#: An n-gram of so many documents, counted where a batch holds it more than once, is often.
OFTEN = 16
#: Where the hashes of rare n-grams are cut, of 2**64; frequent ones are the last fragment.
CUTS = (1 / 8, 1 / 2)
#: Words of 64 cells in an odd sketch.
WORDS = 16
SKETCH = [f"s{i}" for i in range(WORDS)]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _sets_of(texts: list[str], width: int) -> Iterator[np.ndarray]:
    # A character takes some 60 bytes while its text is hashed.
    for some in bounded_slices(texts, 500_000):
        yield from shingle_sets(texts[some], width)


def _odd_sketch(s: np.ndarray) -> np.ndarray:
    cells = np.bincount((s & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def document_sets(documents: DataFrame, width: int, text: str, key: str) -> DataFrame:
    """(doc_id, set_id, n) and the sketch of every document, and (gram, df) of n-grams that
    a batch repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets_of(texts_of(batch.column(1)), width))
            ids = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
            distinct = np.unique(ids, return_index=True)[1]
            grams, df = np.unique(
                np.concatenate([*(sets[i] for i in distinct), np.empty(0, np.uint64)]),
                return_counts=True)
            grams, df = grams[df > 1], df[df > 1]
            n, more = len(sets), len(grams)
            sketches = np.array([_odd_sketch(s) for s in sets], np.int64).reshape(n, WORDS)
            yield from pa.Table.from_arrays([
                pa.concat_arrays([batch.column(0), pa.nulls(more, pa.int64())]),
                pa.concat_arrays([_signed(ids), pa.nulls(more, pa.int64())]),
                pa.concat_arrays([pa.array(list(map(len, sets)), pa.int32()),
                                  pa.nulls(more, pa.int32())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), _signed(grams)]),
                pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(df.astype(np.int32))]),
                *(pa.concat_arrays([pa.array(sketches[:, i].copy()), pa.nulls(more, pa.int64())])
                  for i in range(WORDS)),
            ], names=["doc_id", "set_id", "n", "gram", "df", *SKETCH]).combine_chunks().to_batches()

    return in_arrow(
        _keyed(documents, text, key), run,
        "doc_id bigint, set_id bigint, n int, gram bigint, df int, "
        + ", ".join(f"{name} bigint" for name in SKETCH))


def _keyed(documents: DataFrame, text: str, key: str) -> DataFrame:
    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))


def prefix_postings(documents: DataFrame, shared: Broadcast, width: int, num: int, den: int,
                    text: str, key: str) -> DataFrame:
    """(gram, set_id, place) for the first n-grams of every set in the global order.

    ``shared`` holds the n-grams that are often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of one task's rows
        for batch in batches:
            grams, ids = [], []
            for s in _sets_of(texts_of(batch.column(1)), width):
                own = xxhash.xxh3_64_intdigest(s.tobytes())
                if not len(s) or own in seen:
                    continue
                seen.add(own)
                common = shared.value.holds(s)
                first = len(s) + (-len(s) * num // den) + 1
                grams.append(np.concatenate([s[~common], s[common]])[:first])
                ids.append(own)
            each = list(map(len, grams))
            yield pa.RecordBatch.from_arrays([
                _signed(np.concatenate([*grams, np.empty(0, np.uint64)])),
                _signed(np.repeat(np.array(ids, np.uint64), each)),
                pa.array(np.concatenate([*map(np.arange, each), np.empty(0)]).astype(np.int32)),
            ], names=["gram", "set_id", "place"])

    return in_arrow(
        _keyed(documents, text, key).where(F.col("doc_id").isNotNull()), run,
        "gram bigint, set_id bigint, place int")


def fragments(documents: DataFrame, shared: Broadcast, numbers: list[int], width: int, text: str,
              key: str) -> DataFrame:
    """(set_id, fragment, grams) of the documents that ``wanted`` may hold, with sets that
    ``sets`` may hold. A set comes once a task. ``shared`` holds both and the n-grams that
    are often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, sets, often = shared.value
        cuts = np.array([int(cut * 2**64) for cut in CUTS], np.uint64)
        seen: set[int] = set()  # of one task's rows
        for batch in batches:
            keep = np.flatnonzero(wanted.holds(batch.column(0).to_numpy().view(np.uint64)))
            some = batch.take(pa.array(keep))
            parts, ids = [], []
            for s in _sets_of(texts_of(some.column(1)), width):
                own = xxhash.xxh3_64_intdigest(s.tobytes())
                if own in seen or not sets.holds(np.array([own], np.uint64))[0]:
                    continue
                seen.add(own)
                ids.append(own)
                common = often.holds(s)
                rare = s[~common]
                cut = [*np.split(rare, np.searchsorted(rare, cuts)), s[common]]
                parts += [cut[number] for number in numbers]
            offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate([*parts, np.empty(0, np.uint64)])
            keys = np.repeat(np.array(ids, np.uint64), len(numbers))
            yield pa.RecordBatch.from_arrays(
                [_signed(keys), pa.array(np.tile(np.array(numbers, np.int32), len(ids))),
                 pa.ListArray.from_arrays(pa.array(offsets), _signed(flat))],
                names=["set_id", "fragment", "grams"])

    return in_arrow(
        _keyed(documents, text, key).where(F.col("doc_id").isNotNull()), run,
        "set_id bigint, fragment int, grams array<bigint>")


def _comparable(num: int, den: int) -> Column:
    return F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num


def _needed(num: int, den: int) -> Column:
    """The least overlap of a linked pair of these sizes."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * num / (num + den) - 1e-9)


def _may_link(num: int, den: int) -> Column:
    """Whether the sketches (x_ and y_) leave room for the overlap of a linked pair."""
    apart = sum((F.bit_count(F.col(f"x_{w}").bitwiseXOR(F.col(f"y_{w}"))) for w in SKETCH),
                F.lit(0))
    return apart <= F.col("n_a") + F.col("n_b") - 2 * _needed(num, den)


def _sketches(heads: DataFrame, key: str, mark: str) -> DataFrame:
    return heads.select(F.col("set_id").alias(key), *(F.col(w).alias(f"{mark}_{w}") for w in SKETCH))


def _partial(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs with, per fragment, the overlap and how many n-grams only one has."""
    one = parts.select(F.col("set_id").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    other = parts.select(F.col("set_id").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    return (
        pairs.join(one, "a").join(other, ["b", "fragment"])
        .select(*pairs.columns, F.size(F.array_intersect("grams_a", "grams_b")).alias("part"),
                (F.size("grams_a") + F.size("grams_b")).alias("sizes"))
    )


class _Verifier:
    """Verifies candidate pairs (a, b, n_a, n_b) of sets by the texts of their documents."""

    def __init__(self, documents: DataFrame, heads: DataFrame, often: Membership, width: int, num: int, den: int,
                 text: str, key: str):
        self.documents, self.often, self.width = documents, often, width
        self.heads = heads.select("set_id", "head")
        self.num, self.den, self.text, self.key = num, den, text, key

    def _parts(self, pairs: DataFrame, numbers: list[int]) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        found = self.heads.join(ids, "set_id")
        shared = self.documents.sparkSession.sparkContext.broadcast(
            (Membership.of(found, "head"), Membership.of(ids, "set_id"), self.often))
        parts = written(
            fragments(self.documents, shared, numbers, self.width, self.text, self.key),
            "fragments")
        shared.destroy()  # else it stays in the driver's memory until that collects its garbage
        repeated = parts.groupBy("set_id", "fragment").count().where("count > 1")
        repeated = repeated.select("set_id").distinct()
        if repeated.isEmpty():
            return parts
        once = parts.join(repeated, "set_id", "left_semi").dropDuplicates(["set_id", "fragment"])
        return parts.join(repeated, "set_id", "left_anti").unionByName(once)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The linked pairs (a, b), as the documents that head their sets, stored."""
        pairs = pairs.withColumn("needed", _needed(self.num, self.den))
        apart = F.col("sizes") - 2 * F.col("part")
        first = written(
            _partial(pairs, self._parts(pairs, [0]))
            .where(apart <= F.col("n_a") + F.col("n_b") - 2 * F.col("needed"))
            .select("a", "b", "needed", F.col("part").alias("overlap")), "near-pairs")
        pair = ["a", "b", "needed", "overlap"]
        more = (
            _partial(first, self._parts(first, [*range(1, len(CUTS) + 2)]))
            .groupBy(*pair).agg(F.sum("part").alias("parts"))
        )
        linked = more.where(F.col("overlap") + F.col("parts") >= F.col("needed"))
        for side in ("a", "b"):
            named = self.heads.select(F.col("set_id").alias(side), F.col("head").alias(f"h_{side}"))
            linked = linked.join(named, side)
        return written(linked.where("h_a <> h_b").select(F.least("h_a", "h_b").alias("a"),
                                                          F.greatest("h_a", "h_b").alias("b")),
                       "links")


def _ordered(one: tuple[str, str], other: tuple[str, str]) -> list[Column]:
    """a, b, n_a and n_b of two (set, size) columns, the smaller set first."""
    (x, n_x), (y, n_y) = one, other
    first = F.col(x) < F.col(y)
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b"),
            F.when(first, F.col(n_x)).otherwise(F.col(n_y)).alias("n_a"),
            F.when(first, F.col(n_y)).otherwise(F.col(n_x)).alias("n_b")]


def ngram_components(documents: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                     text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every document."""
    known = written(document_sets(documents, width, text, key), "document-sets")
    sets = known.where("n IS NOT NULL").select("doc_id", "set_id", "n", *SKETCH)
    often = Membership.of(
        known.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("df").alias("df"))
        .where(F.col("df") >= OFTEN), "gram")
    heads = written(
        sets.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("set_id").agg(F.min("doc_id").alias("head"), F.max("n").alias("n"),
                               *(F.max(w).alias(w) for w in SKETCH)), "set-heads")
    shared = documents.sparkSession.sparkContext.broadcast(often)
    postings = prefix_postings(documents, shared, width, num, den, text, key)
    # One number to order a group by: the place of the n-gram, then bits of the set's hash.
    postings = postings.withColumn("turn", F.expr(
        "shiftleft(CAST(place AS BIGINT), 40) | (set_id & ((1L << 40) - 1))"))
    leaders = (
        postings.groupBy("gram").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
        .where("first <> last").select("gram", "first")
    )
    met = written(
        postings.join(leaders, "gram").join(heads.select("set_id", "head", "n"), "set_id")
        .select("gram", "set_id", "head", "n", "place", (F.col("turn") == F.col("first")).alias("leads")),
        "met-postings")
    shared.destroy()
    lead = met.where("leads").select("gram", F.col("set_id").alias("lead"), F.col("n").alias("n_lead"))
    led = (
        met.join(lead, "gram").where("set_id <> lead")
        .select(*_ordered(("set_id", "n"), ("lead", "n_lead")))
        .where(_comparable(num, den)).distinct()
    )
    pairs = written(
        led.join(_sketches(heads, "a", "x"), "a").join(_sketches(heads, "b", "y"), "b")
        .where(_may_link(num, den)).select("a", "b", "n_a", "n_b"), "leader-pairs")
    verify = _Verifier(documents, heads, often, width, num, den, text, key)
    links = verify.links(pairs)
    joined = written(connected_components(links), "components")
    rest = written(_pairs_apart(met, heads, joined, num, den).join(pairs, ["a", "b"], "left_anti"),
                   "pairs-apart")
    if not rest.isEmpty():
        more = verify.links(rest)
        if not more.isEmpty():
            held = joined.select(F.col("id").alias("a"), F.col("component").alias("b"))
            joined = written(connected_components(more.unionByName(held)), "components")
    placed = (
        heads.join(joined.withColumnRenamed("id", "head"), "head", "left")
        .select("set_id", F.coalesce("component", "head").alias("component"))
    )
    return sets.join(placed, "set_id", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        .alias("component_id"))


def _pairs_apart(met: DataFrame, heads: DataFrame, joined: DataFrame, num: int,
                 den: int) -> DataFrame:
    """Pairs that meet under an n-gram in different components and may link.

    N-grams of the same sets, as those of a passage that documents share, are one list, in
    which a set has its earliest place under any of them. Under the first n-gram that two sets share, no more can follow in either than stand
    from there to its end; a pair that fails this elsewhere also meets earlier.
    """
    placed = (
        met.select("gram", "set_id", "n", "place", "head")
        .join(joined.withColumnRenamed("id", "head"), "head", "left")
        .withColumn("component", F.coalesce("component", "head"))
    )
    # A list is told by its length and two exclusive-ors of its sets' hashes.
    split = (
        placed.groupBy("gram").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.count("*").alias("length"), F.bit_xor(F.xxhash64("set_id")).alias("one"),
            F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("two"))
        .where("low <> high").select("gram", F.struct("length", "one", "two").alias("list"))
    )
    left = written(
        placed.join(split, "gram").groupBy("list", "set_id").agg(
            F.min("place").alias("place"), F.min("n").alias("n"),
            F.min("component").alias("component"))
        .join(heads.select("set_id", *SKETCH), "set_id"), "postings-apart")

    def side(name: str, mark: str) -> DataFrame:
        return left.select(
            "list", F.col("set_id").alias(name), F.col("n").alias(f"n_{name}"),
            F.col("place").alias(f"place_{name}"), F.col("component").alias(f"c_{name}"),
            *(F.col(w).alias(f"{mark}_{w}") for w in SKETCH))

    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return (
        side("a", "x").join(side("b", "y"), "list")
        .where("a < b AND c_a <> c_b").where(_comparable(num, den))
        .where(room >= _needed(num, den)).where(_may_link(num, den))
        .select("a", "b", "n_a", "n_b").distinct()
    )
