"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster whose members lie within an angle r of its
centre, a candidate at angle a from the centre has an inner product of at most
|member| * |candidate| * cos(max(0, a - r)) with any member. Candidates are sorted by that
bound, without the member's length, once for each cluster; every member walks the shared list
and stops as soon as the bound shows that nothing further on can enter its result.

Candidates stand in blocks of bounded size, each holding candidates near one centre, and the
anchors in tiles of whole clusters; a tile meets a block in one task, as a list of its own,
and the best of all blocks are merged. Blocks whose bound shows that no anchor of a tile
needs them are not sent to it: what an anchor needs at least is known from a bounded sample
of candidates. Clusters that are larger than a tile, and cells larger than a block, are
split by hash, so no task grows with the data, and every pair of tile and block that may
matter is walked. Positives come first; the windows that they set are walked in a second
pass. The centres are fitted on a bounded sample; they steer the order alone, never the
result.

Rows with a null label, a null vector, null or non-finite components, or a null ``vec_id``
take no part. Repeated rows (equal ``vec_id``, label and vector) count once; rows of one
``vec_id`` that differ are different rows. Vectors of different lengths do not meet. Zero
and empty vectors score 0 with all. Inner products are exact; beyond 64 bits they count as
the largest or smallest 64-bit number. An empty table, or no anchors, gives no rows. Other
columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.tables import in_arrow, ship_package, written

#: Rows that the centres and the thresholds are taken from, about so many at most.
SAMPLE = 16_384
#: Centres at most, and sampled anchors for each.
CENTRES, PER_CENTRE = 64, 32
#: Anchors of a tile and candidates of a block.
TILE, BLOCK = 8_192, 16_384
#: Candidates walked at a time, and members that walk together.
STEP, MEMBERS = 512, 512
_TOP, _EXACT = (1 << 63) - 1, 2.0**53


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; the direction of a zero vector is zero."""
    most = np.abs(vectors).max(axis=1, initial=0.0)
    scale = np.where(most > 0, most, 1.0)
    scaled = vectors / scale[:, None]
    norms = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(norms > 0, norms, 1.0)[:, None], norms * scale


def products(one: np.ndarray, other: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products of whole-numbered vectors, as 64-bit integers."""
    if longest < _EXACT:
        return (one @ other.T).astype(np.int64)
    whole = np.array([[sum(int(x) * int(y) for x, y in zip(a, b)) for b in other.tolist()]
                      for a in one.tolist()], dtype=object)
    return np.clip(whole, -_TOP, _TOP).astype(np.int64).reshape(len(one), len(other))


def fit_centres(vectors: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; at least one centre."""
    rows, _ = unit(vectors)
    k = max(1, min(CENTRES, len(rows) // PER_CENTRE))
    if not len(rows):
        return np.zeros((1, vectors.shape[1]))
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres, lengths = unit(sums)
        empty = lengths == 0
        centres[empty] = rows[np.flatnonzero(empty) % len(rows)]
    return centres


def angles(directions: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ centres.T, -1.0, 1.0))


def _best(owner: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of every owner: by higher score, then by smaller key."""
    order = np.lexsort((key, -score, owner))
    ranked = owner[order]
    first = np.searchsorted(ranked, ranked, side="left")
    return order[np.arange(len(order)) - first < k]


class Held:
    """The best k candidates of every owner so far, and the least score that may enter."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.owner = self.score = self.key = np.empty(0, np.int64)

    def offer(self, owner: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, key = (np.concatenate(pair) for pair in (
            (self.owner, owner), (self.score, score), (self.key, key)))
        best = _best(owner, score, key, self.k)
        self.owner, self.score, self.key = owner[best], score[best], key[best]
        n = len(self.least)
        worst = np.full(n, _TOP)
        np.minimum.at(worst, self.owner, self.score)
        full = np.bincount(self.owner, minlength=n) == self.k
        self.least[full] = np.maximum(self.least[full], worst[full])


class Side:
    """Rows of one side of a meeting, all of one length."""

    def __init__(self, table: pa.Table):
        self.key, self.label, self.row = (
            table[name].to_numpy() for name in ("vec_id", "label", "row"))
        vectors = table["vec"].combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = pa.concat_arrays(vectors.chunks)
        self.vec = vectors.flatten().to_numpy(zero_copy_only=False).reshape(
            len(self.key), table["dims"][0].as_py() if len(self.key) else 0)
        self.direction, self.length = unit(self.vec)


def shared_list(members: Side, of: np.ndarray, items: Side,
                centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates of one cluster in falling order of their bound, and the bounds."""
    radius = angles(members.direction[of], centre[None, :]).max()
    away = angles(items.direction, centre[None, :])[:, 0]
    # Angles are good to 1e-7; the margins cover that and the rounding of the cosine.
    bound = items.length * np.minimum(1.0, np.cos(np.maximum(0.0, away - radius - 1e-7)) + 1e-9)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(members: Side, of: np.ndarray, items: Side, order: np.ndarray, bound: np.ndarray,
         held: Held, high: np.ndarray, same: bool) -> None:
    """Members ``of`` a cluster walk its list until nothing further on can enter.

    Member m serves the owners m * slots to m * slots + slots - 1 of ``held``, one for each
    column of ``high``, the highest score that may enter.
    """
    slots = high.shape[1]
    least = held.least.reshape(len(members.key), slots)  # a view that follows what is held
    longest = float(members.length[of].max() * items.length.max()) * 1.01
    slack = 1e-9 * longest
    for start in range(0, len(order), STEP):
        reach = members.length[of] * bound[start] + slack
        of = of[(least[of] <= np.minimum(reach, 9.0e18)[:, None]).any(axis=1)]
        if not len(of):
            return
        part = order[start:start + STEP]
        score = products(members.vec[of], items.vec[part], longest)
        fits = (members.label[of][:, None] == items.label[part]) == same
        fits &= members.row[of][:, None] != items.row[part]
        for slot in range(slots):
            x, y = np.nonzero(fits & (score >= least[of, slot][:, None])
                              & (score <= high[of, slot][:, None]))
            held.offer(of[x] * slots + slot, score[x, y], items.key[part[y]])


def meet(members: Side, cluster: np.ndarray, items: Side, centres: np.ndarray, held: Held,
         high: np.ndarray, same: bool) -> Held:
    """All members walk the shared lists of their clusters over these candidates."""
    if len(items.key):
        for number in np.unique(cluster):
            of = np.flatnonzero(cluster == number)
            order, bound = shared_list(members, of, items, centres[number])
            for start in range(0, len(of), MEMBERS):
                walk(members, of[start:start + MEMBERS], items, order, bound, held, high, same)
    return held


def usable_rows(embeddings: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vec, dims, row) of usable rows, once each; components are whole."""
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: scale * x).alias("vec"))
    sound = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    # floor() gives a bigint, which large components do not fit; adding 0 takes -0 to 0.
    whole = F.transform("vec", lambda x: F.rint(x) + F.when(F.rint(x) > x, -1.0).otherwise(0.0))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound)
            .withColumn("vec", whole).distinct()
            .withColumn("dims", F.size("vec")).withColumn("row", F.xxhash64("vec_id", "label", "vec")))


def _sample(rows: DataFrame) -> dict[int, pa.Table]:
    """About ``SAMPLE`` rows at most, drawn by the hash of distinct rows, by length."""
    n = rows.count()
    drawn = rows if n <= SAMPLE else rows.where(
        F.pmod(F.xxhash64(F.lit("sample"), "row"), F.lit(1 << 30)) < int(SAMPLE / n * (1 << 30)))
    table = drawn.select("vec_id", "label", "vec", "dims", "row").toArrow()
    sizes = table["dims"].to_numpy()
    return {int(d): table.filter(pa.array(sizes == d)) for d in np.unique(sizes)}


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    table = pa.Table.from_batches([batch])
    sizes = table["dims"].to_numpy()
    for dims in np.unique(sizes):
        yield int(dims), table.filter(pa.array(sizes == dims))


def placed(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """The rows with their nearest centre, the angle to it, and their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, table in _by_length(batch):
                side = Side(table)
                all_centres = centres.get(dims, np.zeros((1, dims)))
                nearest = (side.direction @ all_centres.T).argmax(axis=1)
                away = angles(side.direction, all_centres)[np.arange(len(nearest)), nearest]
                yield from (table.append_column("centre", pa.array(nearest.astype(np.int32)))
                            .append_column("away", pa.array(away))
                            .append_column("length", pa.array(side.length)).to_batches())

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return in_arrow(rows, run, f"{kinds}, centre int, away double, length double")


def _high(positives: np.ndarray, percent: int) -> np.ndarray:
    whole, part = positives // 100, positives % 100
    return whole * percent + part * percent // 100


def _low(positives: np.ndarray, percent: int) -> np.ndarray:
    whole, part = positives // 100, positives % 100
    return whole * percent - (-part * percent) // 100


def with_windows(anchors: DataFrame, slots: int, low: int, high: int) -> DataFrame:
    """``least`` and ``high`` for the positives in ``best``; a slot without one takes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = batch["best"]
            offsets = best.offsets.to_numpy()
            scores = best.values.field("score").to_numpy()
            least = np.full((len(best), slots), _TOP)
            most = np.full((len(best), slots), -_TOP)
            for n, (start, end) in enumerate(zip(offsets, offsets[1:])):
                least[n, :end - start] = _low(scores[start:end], low)
                most[n, :end - start] = _high(scores[start:end], high)
            bounds = pa.array(np.arange(0, least.size + 1, slots, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(goal.ravel()))
                     for goal in (least, most)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *lists], names=[*batch.schema.names, "least", "high"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in anchors.dtypes)
    return in_arrow(anchors, run, f"{kinds}, least array<bigint>, high array<bigint>")


def _goals(table: pa.Table, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the highest score of every slot, a row for each member."""
    return tuple(table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                 .reshape(len(table), slots) for name in ("least", "high"))


def with_thresholds(anchors: DataFrame, sample: dict[int, pa.Table], k: int, slots: int,
                    same: bool) -> DataFrame:
    """``least`` of each slot raised to its kth best score among the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, table in _by_length(batch):
                least, high = _goals(table, slots)
                held = Held(k, least.ravel())
                if dims in sample:
                    meet(Side(table), np.zeros(len(table), np.int64), Side(sample[dims]),
                         np.zeros((1, dims)), held, high, same)
                offsets = pa.array(np.arange(0, len(table) * slots + 1, slots, dtype=np.int32))
                raised = pa.ListArray.from_arrays(offsets, pa.array(held.least))
                yield from table.set_column(
                    table.schema.get_field_index("least"), "least", raised).to_batches()

    return in_arrow(anchors, run, anchors.schema)


def _tiled(anchors: DataFrame) -> DataFrame:
    """Anchors with their tile: clusters in a row, the larger ones split by hash."""
    before = Window.partitionBy("dims").orderBy("centre").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = anchors.groupBy("dims", "centre").agg(F.count("*").alias("n"))  # a row per centre
    tiles = sizes.select(
        "dims", "centre", F.ceil(F.col("n") / TILE).alias("chunks"),
        F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / TILE).alias("first"))
    return (anchors.join(tiles, ["dims", "centre"])
            .withColumn("tile", F.struct("first", F.pmod("row", "chunks").alias("chunk")))
            .drop("chunks", "first"))


def _blocked(items: DataFrame) -> DataFrame:
    """Candidates with their block: those near one centre, split by hash if many."""
    sizes = items.groupBy("dims", "centre").agg(F.ceil(F.count("*") / BLOCK).alias("chunks"))
    return (items.join(sizes, ["dims", "centre"])
            .withColumn("block", F.struct("centre", F.pmod("row", "chunks").alias("chunk")))
            .drop("chunks"))


def _meetings(tiled: DataFrame, blocked: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """(dims, tile, block) for every tile and block that may hold something for it."""
    spark = tiled.sparkSession
    apart = [(dims, i, j, float(a)) for dims, all_centres in centres.items()
             for i, line in enumerate(angles(all_centres, all_centres)) for j, a in enumerate(line)
             if i != j]
    apart_table = spark.createDataFrame(apart, "dims int, one int, other int, apart double")
    clusters = tiled.groupBy("dims", "tile", "centre").agg(
        F.max("away").alias("radius"), F.max("length").alias("longest"),
        F.min(F.array_min("least")).alias("least"))
    cells = blocked.groupBy("dims", "block").agg(
        F.max("away").alias("width"), F.max("length").alias("long"))
    cells = cells.withColumn("other", F.col("block.centre"))
    pairs = clusters.withColumnRenamed("centre", "one").join(cells, "dims").join(
        apart_table, ["dims", "one", "other"], "left")
    gap = F.coalesce("apart", F.lit(0.0)) - F.col("radius") - F.col("width") - 1e-6
    cosine = F.least(F.cos(F.greatest(gap, F.lit(0.0))) + 1e-9, F.lit(1.0))
    reach = F.col("longest") * F.col("long") * (F.greatest(cosine, F.lit(0.0)) + 1e-9)
    return pairs.where(reach >= F.col("least")).select("dims", "tile", "block").distinct()


def _best_of_all(anchors: DataFrame, items: DataFrame, centres: dict[int, np.ndarray], k: int,
                 slots: int, same: bool) -> DataFrame:
    """(anchor_id, row, slot, key, score, rank): the k best for every slot of every anchor."""
    tiled, blocked = _tiled(anchors), _blocked(items)
    pairs = written(_meetings(tiled, blocked, centres), "meetings")
    common = ["dims", "tile", "block", "vec_id", "label", "vec", "row"]
    goals = "array<bigint>"
    members = tiled.join(pairs, ["dims", "tile"]).select(
        *common, F.col("centre").alias("cluster"), "least", "high")
    others = blocked.join(pairs, ["dims", "block"]).select(
        *common, F.lit(-1).alias("cluster"), F.lit(None).cast(goals).alias("least"),
        F.lit(None).cast(goals).alias("high"))

    def run(table: pa.Table) -> pa.Table:
        mine = table["cluster"].to_numpy() >= 0
        one, other = table.filter(pa.array(mine)), table.filter(pa.array(~mine))
        dims = table["dims"][0].as_py()
        members, (least, high) = Side(one), _goals(one, slots)
        held = meet(members, one["cluster"].to_numpy(), Side(other),
                    centres.get(dims, np.zeros((1, dims))), Held(k, least.ravel()), high, same)
        at = held.owner // slots
        return pa.table({"anchor_id": members.key[at], "row": members.row[at],
                         "slot": held.owner % slots, "key": held.key, "score": held.score})

    found = members.unionByName(others).groupBy("dims", "tile", "block").applyInArrow(
        run, "anchor_id bigint, row bigint, slot bigint, key bigint, score bigint")
    order = Window.partitionBy("anchor_id", "row", "slot").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, positives: int = 5,
                   negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``embeddings`` has vec_id, label and embedding; each component x becomes
    floor(scale * x). ``is_anchor`` is a condition on vec_id. The ``positives`` best other
    rows of the anchor's label are its positives. For each of them the best ``negatives``
    rows of other labels are returned whose score lies within ``low`` to ``high`` percent
    of the positive's score; ties go to the smaller vec_id.
    """
    ship_package(embeddings.sparkSession)
    rows = written(usable_rows(embeddings, scale), "vectors")
    centres = {dims: fit_centres(Side(table).vec)
               for dims, table in _sample(rows.where(is_anchor)).items()}
    sample = _sample(rows)
    items = written(placed(rows, centres), "placed-vectors")
    own = items.where(is_anchor).withColumns({
        "least": F.array(F.lit(-_TOP)), "high": F.array(F.lit(_TOP))})
    anchors = written(with_thresholds(own, sample, positives, 1, True), "anchors")
    best = written(_best_of_all(anchors, items, centres, positives, 1, True), "positives")
    ranked = best.groupBy("anchor_id", "row").agg(F.array_sort(F.collect_list(
        F.struct("rank", "key", "score"))).alias("best"))  # at most ``positives`` of them
    seeking = items.where(is_anchor).join(
        ranked.select("row", F.col("anchor_id").alias("vec_id"), "best"), ["row", "vec_id"])
    windows = with_thresholds(
        with_windows(seeking, positives, low, high), sample, negatives, positives, False)
    walkers = written(windows, "anchors")
    found = _best_of_all(walkers.drop("best"), items, centres, negatives, positives, False)
    kept = walkers.select("row", F.col("vec_id").alias("anchor_id"), "best")
    positive = F.col("best")[F.col("slot").cast("int")]
    return found.join(kept, ["row", "anchor_id"]).select(
        "anchor_id", positive["key"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("key").alias("negative_id"), positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))
