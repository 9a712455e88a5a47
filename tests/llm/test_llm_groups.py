"""Near duplicates, components and shards against SQL and brute force; the pipeline."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from llm_fixtures import SF, TEXTS, documents, no_documents, odd_documents  # noqa: F401
from oracle_compare import connect, difference
from pyspark import SparkContext
from pyspark.core.broadcast import Broadcast

import corpus_pipeline
from hitloom.llm import embedding_dedup, ngram_join, sharding
from hitloom.llm.components import connected_components
from hitloom.llm.registry import ORACLE_SQL, QUERIES
from hitloom.llm.shingles import shingle_sets


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) is None


def brute_components(keys, linked):
    low = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 230)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)] + [(5, 5)]
    got = {r.id: r.component for r in
           connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == brute_components(nodes, [e for e in edges if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Word n-grams


def brute_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(
        {c: c + 32 for c in range(65, 91)}))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


@pytest.mark.parametrize("width", [1, 4, 5])
def test_shingle_sets_are_as_large_as_the_sets(width):
    sets = shingle_sets([t or "" for t in TEXTS], width)
    assert [len(s) for s in sets] == [len(brute_set(t, width)) for t in TEXTS]
    assert (shingle_sets(["A b C d e"], width)[0] == shingle_sets(["x", " a\tB c\nD e "], width)[1]).all()


def check_ngrams(frame, width, num, den):
    docs = [(r.doc_id, r.text) for r in frame.collect() if r.doc_id is not None]
    sets = {}
    for doc, text in docs:
        sets.setdefault(doc, brute_set(text, width))
    linked = [(a, b) for a, b in itertools.combinations(sets, 2)
              if sets[a] and sets[b]
              and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    component = brute_components(sets, linked)
    rows = ngram_join.ngram_components(frame, width, num, den).collect()
    assert len(rows) == frame.count()
    for r in rows:
        assert r.component_id == (None if r.doc_id is None else component[r.doc_id])
        if r.doc_id is not None:
            assert r.n_shingles == len(sets[r.doc_id])


def test_ngram_join_of_odd_documents(odd_documents, no_documents):  # noqa: F811
    check_ngrams(odd_documents, 4, 85, 100)
    assert ngram_join.ngram_components(no_documents).count() == 0


def test_ngram_join_of_edited_copies_chains_and_shared_passages(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 5000)}"
    passage = [word() for _ in range(60)]
    rows, base = [], [word() for _ in range(80)]
    for _ in range(25):  # copies of one text, edited a little more each time
        base = list(base)
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = word()
        rows.append(" ".join(base))
    for _ in range(60):  # a passage that many documents share is no link
        rows.append(" ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)]))
    for _ in range(20):  # mostly passage: some reach the threshold
        rows.append(" ".join(passage + [word() for _ in range(rng.randint(0, 12))]))
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(5)
    for width, num in ((4, 85), (5, 80), (1, 50)):
        check_ngrams(frame, width, num, 100)


def test_repeated_long_rows_just_below_the_threshold_do_not_link(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    rng.shuffle(words)
    below = [(4, " ".join(words[:2000])), (9, " ".join(words[240:2240]))]  # 1760 / 2240
    above = [(5, " ".join(words[:2000]).upper()), (3, " ".join(words[100:2100]))]
    frame = spark.createDataFrame(below * 3, "doc_id bigint, text string").repartition(4)
    check_ngrams(frame, 1, 80, 100)
    assert {r.component_id for r in ngram_join.ngram_components(frame, 1, 80, 100).collect()} == {4, 9}
    check_ngrams(spark.createDataFrame(above * 3, "doc_id bigint, text string").repartition(4), 1, 80, 100)


# Embeddings


def brute_links(vectors, threshold):
    linked = []
    for (a, la, x), (b, lb, y) in itertools.combinations(vectors, 2):
        if la == lb and len(x) == len(y):
            x64, y64 = np.array(x, float), np.array(y, float)
            if x64 @ y64 / np.sqrt((x64 @ x64) * (y64 @ y64)) >= threshold:
                linked.append((a, b))
    return linked


@pytest.mark.parametrize("grid,chunk", [(1, 2000), (2, 7), (1, 5)])
def test_embeddings_against_brute_force(spark, grid, chunk):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 20))
    rows = []
    for i in range(150):
        v = centres[rng.integers(6)] + rng.standard_normal(20) * rng.choice([0.02, 0.2, 1.0])
        rows.append((i, int(rng.integers(2)), [float(x) for x in v.astype(np.float32)]))
    rows += [(200 + i, *rows[3][1:]) for i in range(4)]
    sound = list(rows)
    rows += [(300, None, rows[0][2]), (301, 0, None), (302, 0, [0.0] * 20), (303, 0, [float("nan")] * 20),
             (304, 1, [None] + rows[1][2][1:]), (305, 1, [float("inf")] + rows[1][2][1:]),
             (306, 0, []), (307, 0, [1.0, 2.0]), (308, 0, [2.0, 4.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id bigint, label int, embedding array<float>, head string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame, grid=grid, chunk=chunk).collect()}
    linked = brute_links(sound, 0.93) + [(307, 308)]
    component = brute_components([r[0] for r in rows], linked)
    for key in component:
        assert got[key].n_links == sum(key in pair for pair in linked)
        assert got[key].component_id == component[key]
        assert got[key].kept == (component[key] == key)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


# Shards


def test_shards_fit_and_split_no_further_than_needed(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 400)) for i in range(500)]
    rows += [(7, "y" * 300)] * 40 + [(9001, "z" * 5000), (None, "n"), (None, None)]
    frame = spark.createDataFrame([(*r, "a") for r in rows], "doc_id bigint, text string, hash string")
    limit = 2000
    got = sharding.assign_shards(frame, limit=limit).collect()
    assert len(got) == len(rows)
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append(r)
    for shard, members in held.items():
        total = sum(r.n_bytes for r in members)
        assert total <= limit or len(members) == 1
        assert all(r.shard_bytes == total and r.depth == len(shard) for r in members)
        assert all(r.oversized == (total > limit) for r in members)
        # No shard is a prefix of another, and each parent was too large.
        assert not any(other != shard and other.startswith(shard) for other in held)
        if shard:
            inside = [r for other, ms in held.items() if other.startswith(shard[:-1]) for r in ms]
            assert sum(r.n_bytes for r in inside) > limit
    assert sharding.assign_shards(frame.limit(0)).count() == 0


def test_shards_need_no_python(documents):  # noqa: F811
    plan = sharding.assign_shards(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_shards_hold_every_document(spark, documents, tmp_path):  # noqa: F811
    folder = str(tmp_path / "shards")
    sharding.write_shards(documents, folder, limit=100_000)
    back = spark.read.parquet(folder)
    assert back.count() == documents.count()
    assert back.groupBy("shard").sum("n_chars").count() > 3


# Memory of the driver


def test_ngram_join_leaves_no_broadcast_on_the_driver(spark, documents, monkeypatch):  # noqa: F811
    """They stayed in its memory until that collected its garbage."""
    made, gone, make, destroy = [], [], SparkContext.broadcast, Broadcast.destroy
    monkeypatch.setattr(SparkContext, "broadcast",
                        lambda self, value: made.append(make(self, value)) or made[-1])
    monkeypatch.setattr(Broadcast, "destroy",
                        lambda self, *a, **k: gone.append(self) or destroy(self, *a, **k))
    frame = ngram_join.ngram_components(documents, 5, 80, 100)
    assert len(made) >= 3 and made == gone
    assert frame.count() == documents.count()


# Pipeline


def test_pipeline_keeps_clean_documents_and_packs_them(spark, documents):  # noqa: F811
    stages = dict(corpus_pipeline.STAGES)
    middle = SF.replace("0.001", "0.01")
    marks = spark.read.parquet(f"{middle}/labels.parquet").collect()
    kept = stages["quality"](spark, spark.read.parquet(f"{middle}/documents.parquet"), middle)
    assert kept.columns == documents.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    wrong = [r.doc_id for r in marks if (r.doc_id in ids) != (r.quality == 1)]
    assert len(wrong) <= 0.03 * len(marks)
    unique = stages["near_duplicates"](spark, documents, SF)
    groups = {r.doc_id: r.component_id for r in
              ngram_join.ngram_components(documents, 5, 80, 100).collect()}
    assert {r.doc_id for r in unique.select("doc_id").collect()} == set(groups.values())
    result = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset"} <= set(result.columns)
    assert {r.doc_id for r in result.collect()} <= set(groups)


def test_stages_take_odd_and_no_documents(spark, odd_documents, no_documents):  # noqa: F811
    for frame in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, frame, SF)
            rows = result.collect()
            if name != "packing":
                assert result.columns == frame.columns
            if name == "near_duplicates" and frame is odd_documents:
                # The copy of another text and the repeated row go, nothing else does.
                ids = [r.doc_id for r in odd_documents.collect()]
                ids.remove(6), ids.remove(7)
                assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in rows)
            if name == "packing":
                by_sequence = {}
                for r in rows:
                    by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
                for places in by_sequence.values():
                    ends = [0, *(o + n for o, n in sorted(places))]
                    assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 1024
                assert len({(r.doc_id, r.piece) for r in rows}) <= len(rows)
            if frame is no_documents:
                assert rows == []


def test_near_duplicates_of_one_id_with_different_texts(spark):
    """No text is lost because of another text of the same id, and runs agree."""
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    a, b, c = (" ".join(f"{mark}{i}" for i in range(30)) for mark in "abc")
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "z"), (5, b, "y"), (5, c, "w"), (6, c, "v"),
            (None, a, "n"), (None, a, "n"), (7, None, "k"), (7, None, "k"), (7, "", "k")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _document string")
    for _ in range(2):
        got = sorted(map(tuple, stage(spark, frame.repartition(3), SF).collect()), key=repr)
        assert got == sorted([(3, a, "x"), (5, b, "y"), (5, c, "w"), (None, a, "n"), (None, a, "n"),
                              (7, None, "k"), (7, "", "k")], key=repr)
