"""Near-duplicate embeddings by a subspace pigeonhole join.

Two vectors of the same label link when their cosine, in double precision, is at least
``threshold``, so when their unit vectors lie within a squared distance of
2 - 2 * threshold. All vectors are turned by one random rotation and cut into blocks of
a few dimensions. The squared distance is the sum over the blocks, so a linked pair is
within a block's proportional share of the budget in some block. Each block is
range-joined by itself: slabs as wide as the block's radius along its first dimensions,
each joined with itself and its neighbours. Every pair found is verified exactly, by
the first block that finds it, so the union over the blocks counts each link once.

Equal vectors of a label are joined first and weigh as many as they are. A task emits a
link count and a root for each vector, never its pairs. A slab of many vectors is cut
into chunks, and the pairs of chunks are shared out.

Vectors that are null, zero or hold null or non-finite components, and rows with a null
label or a null ``vec_id``, link with nothing; a null ``vec_id`` has a null component
and is not kept. Vectors of different lengths do not link. Repeated rows are copies.
Other columns are left out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.components import connected_components
from hitloom.llm.tables import in_arrow, ship_package, written

BLOCK = 8
GRID = 1
CHUNK = 2000


def rotation(dims: int) -> np.ndarray:
    """The same random orthogonal matrix in every task."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int, block: int) -> list[slice]:
    return [slice(i, min(i + block, dims)) for i in range(0, dims, block)]


def _half_neighbours(grid: int) -> list[tuple[int, ...]]:
    """The cell itself and one of each pair of opposite neighbours."""
    return [step for step in product((-1, 0, 1), repeat=grid) if step >= (0,) * grid]


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = vectors.astype(np.float64)
    norms = np.sqrt((wide * wide).sum(axis=1))
    return wide, norms


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def cells(vectors: DataFrame, threshold: float, block: int, grid: int) -> DataFrame:
    """(label, dims, block, cell, home, head, weight, vec): a row per block and cell."""
    budget = 2 - 2 * threshold
    steps = _half_neighbours(grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["dims"].to_numpy()
            for dims in np.unique(sizes):
                rows = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                wide, norms = _unit(_matrix(rows["vec"], dims))
                turned = (wide / norms[:, None]) @ rotation(dims)
                for number, part in enumerate(blocks_of(dims, block)):
                    lead = turned[:, part][:, :grid]
                    radius = np.sqrt(budget * (part.stop - part.start) / dims) * (1 + 1e-9) + 1e-9
                    own = np.floor(lead / radius).astype(np.int64)
                    for step in steps:
                        at = own + np.array(step[: own.shape[1]])
                        n = len(at)
                        yield pa.RecordBatch.from_arrays([
                            rows["label"], rows["dims"], pa.array(np.full(n, number, np.int32)),
                            pa.array([",".join(map(str, c)) for c in at.tolist()], pa.string()),
                            pa.array(np.full(n, not any(step))), rows["head"], rows["weight"],
                            rows["vec"],
                        ], names=["label", "dims", "block", "cell", "home", "head", "weight",
                                  "vec"])

    return in_arrow(
        vectors, run, "label int, dims int, block int, cell string, home boolean, head bigint, "
             "weight bigint, vec array<float>")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest it is joined to by the edges."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[a], roots[b])
        new = roots.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, roots[a], low)
        np.minimum.at(new, roots[b], low)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def _linked(one: np.ndarray, other: np.ndarray, number: int, parts: list[slice],
            turned: np.ndarray, wide: np.ndarray, norms: np.ndarray, allowed: np.ndarray,
            threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs between two chunks that this block finds first."""
    budget, dims = 2 - 2 * threshold, turned.shape[1]

    def within(place: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        part = parts[place]
        gap = turned[x][:, part] - turned[y][:, part]
        return (gap * gap).sum(axis=1) <= budget * (part.stop - part.start) / dims + 1e-9

    part = parts[number]
    p, q = turned[one][:, part], turned[other][:, part]
    near = ((p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2 * p @ q.T
            <= budget * (part.stop - part.start) / dims + 1e-8)
    x, y = np.nonzero(near & allowed)
    x, y = one[x], other[y]
    found: tuple[list, list] = [], []
    for start in range(0, len(x), 200_000):
        xs, ys = x[start : start + 200_000], y[start : start + 200_000]
        keep = within(number, xs, ys)
        xs, ys = xs[keep], ys[keep]
        cosine = (wide[xs] * wide[ys]).sum(axis=1) / (norms[xs] * norms[ys])
        xs, ys = xs[cosine >= threshold], ys[cosine >= threshold]
        for earlier in range(number):
            keep = ~within(earlier, xs, ys)
            xs, ys = xs[keep], ys[keep]
        found[0].append(xs)
        found[1].append(ys)
    empty = np.empty(0, np.int64)
    return np.concatenate([*found[0], empty]), np.concatenate([*found[1], empty])


def join_cells(spread: DataFrame, threshold: float, block: int, chunk: int) -> DataFrame:
    """(head, links, root) for every vector and chunk pair in which it has links."""
    ship_package(spread.sparkSession)
    keys = ["label", "dims", "block", "cell"]
    sizes = spread.groupBy(*keys).agg(F.count("*").alias("n"))
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("head"), F.col("chunks")).cast("int")
    shared = (
        spread.join(sizes.where("n > 1").select(*keys, chunks.alias("chunks")), keys)
        .withColumn("chunk", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "with")).withColumn("high", F.greatest("chunk", "with"))
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dims, number = table["dims"][0].as_py(), table["block"][0].as_py()
        wide, norms = _unit(_matrix(table["vec"].combine_chunks(), dims))
        turned = (wide / norms[:, None]) @ rotation(dims)
        home, side = table["home"].to_numpy(), table["chunk"].to_numpy()
        head, weight = table["head"].to_numpy(), table["weight"].to_numpy()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        one, other = np.flatnonzero(side == low), np.flatnonzero(side == high)
        allowed = home[one][:, None] | home[other][None, :]
        if low == high:
            allowed &= head[one][:, None] < head[other][None, :]
        x, y = _linked(one, other, number, blocks_of(dims, block), turned, wide, norms,
                       allowed, threshold)
        n = len(head)
        links = (np.bincount(x, weight[y], n) + np.bincount(y, weight[x], n)).astype(np.int64)
        order = np.argsort(head, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        root = head[order][_roots(n, place[x], place[y])[place]]
        some = np.flatnonzero(links)
        return pa.table({"head": head[some], "links": links[some], "root": root[some]})

    return (shared.drop("with", "n", "chunks").groupBy(*keys, "low", "high")
            .applyInArrow(run, "head bigint, links bigint, root bigint"))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, key: str = "vec_id",
                    vector: str = "embedding", label: str = "label", block: int = BLOCK,
                    grid: int = GRID, chunk: int = CHUNK) -> DataFrame:
    """key, n_links, component_id and kept of every vector."""
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).alias("vec"),
                             F.col(label).cast("int").alias("label"))
    sound = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    nonzero = F.exists("vec", lambda x: x != 0)
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound & nonzero, F.lit(False))
    heads = written(
        rows.where(usable).groupBy("label", "vec")
        .agg(F.min("vec_id").cast("bigint").alias("head"), F.count("*").alias("weight"))
        .withColumn("dims", F.size("vec")), "vectors")
    spread = cells(heads, threshold, block, grid)
    found = written(join_cells(spread, threshold, block, chunk), "vector-links")
    joined = connected_components(found.select(F.col("head").alias("a"), F.col("root").alias("b")))
    placed = (
        heads.join(found.groupBy("head").agg(F.sum("links").alias("links")), "head", "left")
        .join(joined.withColumnRenamed("id", "head"), "head", "left")
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
                F.coalesce("component", "head").alias("component"))
    )
    return rows.select("vec_id", "label", F.when(usable, F.col("vec")).alias("vec")).join(
        placed, ["label", "vec"], "left").select(
            F.col("vec_id").alias(key),
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "vec_id").cast("bigint").alias("component_id"),
            F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False))
            .alias("kept"))
