"""Toxicity, quality and personal data: held-out figures, brute force and odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import SF, documents, labels, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from hitloom.llm import pii, quality, toxicity
from hitloom.llm.registry import QUERIES

SF_MIDDLE = "/root/testdata/sf0.1"


def held_out_rows(spark, name, column, folds, remainder):
    marks = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF_MIDDLE}/labels.parquet").collect()}
    rows = QUERIES[name](spark, SF_MIDDLE).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == remainder)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    known = [(marks[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in marks]
    return np.array(known)


def test_toxicity_on_held_out_documents(spark):
    known = held_out_rows(spark, "op4_nnpu_toxicity", "toxic", 4, 2)
    assert (known[:, 0] == known[:, 1]).mean() > 0.94
    assert known[known[:, 0] == 1, 1].mean() > 0.8


def test_quality_on_held_out_documents(spark):
    known = held_out_rows(spark, "op5_discriminant_quality", "quality", 5, 0)
    assert (known[:, 0] == known[:, 1]).mean() > 0.97


def test_negative_clean_risk_turns_the_step():
    """Without the turn, unlabelled text that is half toxic would all be called clean."""
    rng = np.random.default_rng(0)
    toxic = [["bad", f"w{i}"] for i in rng.integers(0, 40, 200)]
    clean = [[f"w{i}"] for i in rng.integers(0, 40, 200)]
    model = toxicity.train_model(lambda: toxic, lambda: toxic[:100] + clean[:100], 0.5)
    assert model.score("bad w1") > 0.5 > model.score("w1 w2")


def test_models_without_labels(spark, documents, labels, odd_documents, no_documents):  # noqa: F811
    none = labels.limit(0)
    scored = toxicity.score_documents(odd_documents, toxicity.fit(odd_documents, none))
    assert {round(r.score, 6) for r in scored.collect()} == {0.0}
    scored = quality.score_documents(odd_documents, quality.fit(odd_documents, none))
    assert {r.score for r in scored.collect()} == {0.5}
    assert toxicity.score_documents(no_documents, toxicity.fit(no_documents, none)).count() == 0
    assert quality.score_documents(no_documents, quality.fit(no_documents, none)).count() == 0


def test_models_score_odd_documents(documents, labels, odd_documents):  # noqa: F811
    for module in (toxicity, quality):
        model = module.fit(documents, labels)
        rows = module.score_rows(odd_documents, model, keep=odd_documents.columns)
        assert rows.count() == odd_documents.count()
        assert rows.where("score >= 0 AND score <= 1").count() == odd_documents.count()
        assert rows.select("row.*").columns == odd_documents.columns


def test_statistics_of_odd_texts_are_finite_and_independent_of_the_batch():
    texts = ["", "a", "", "ÄÖ !!", "x " * 1000, ""]
    together = quality.statistics(texts)
    assert np.isfinite(together).all()
    for text, row in zip(texts, together, strict=True):
        assert np.allclose(quality.statistics([text])[0], row)


# Personal data: the plain forms of the base patterns and their checks.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            value = int(c) * (1 + i % 2)
            total += value - 9 * (value > 9)
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PATTERNS.items()
            for m in re.finditer(pattern, text) if passes(kind, m[0])]


HARD = [
    None, "", "a@b.c_d@e.f-g..h@i", "a@b@c.d", "x@y.z.", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.0.0.1",
    "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "41111111111111111111",
    "4111  1111 1111 1111", "+1 (555) 123-4567", "++1 23 456 789 0+12345678", "+1234567 8",
    "🙂 é me@x.org +49 30 1234567, 10.0.0.1!", "1 " * 300, "+" + "1" * 400, "9" * 2000 + ".1.1.1",
    "a" * 5000 + "@b.co", "no pii here", "anna.b7 (at) mail3 (dot) example (dot) com", "call 988-555-2485 now",
    "date 2024-05-17 10:22 and 12345678", "name (at) host (dot) com",
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(HARD)], "doc_id bigint, text string, __text string"
    ).select("doc_id", "text")


def test_base_spans_of_hard_texts(hard):
    rows = pii.base_spans(hard).select("doc_id", pii.span_text("__base").alias("spans")).collect()
    for r in rows:
        assert r.spans == ",".join(brute_spans(HARD[r.doc_id] or "")), HARD[r.doc_id][:80]


def test_op7_query(spark, documents):  # noqa: F811
    got = {r.doc_id: r for r in QUERIES["op7_boosted_pii"](spark, SF).collect()}
    for r in documents.collect():
        base = brute_spans(r.text or "")
        mine = got[r.doc_id]
        assert mine.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(mine.spans.split(",")) | {""}
        for kind in PATTERNS:
            assert mine[f"n_{kind}"] == sum(s.startswith(kind) for s in base)


def test_plan_has_no_python(spark, documents):  # noqa: F811
    model = pii.SpanModel("c.f[1] / 20", {"phone": 0.5})
    plan = pii.redact(documents, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_model_adds_what_resembles_base_spans_only(spark, hard):
    model = pii.fit(spark.read.parquet(f"{SF_MIDDLE}/documents.parquet"))
    rows = {r.doc_id: r for r in pii.find_spans(hard, model).select(
        "doc_id", pii.span_text("__base").alias("base"), pii.span_text("__spans").alias("spans")
    ).collect()}
    for r in rows.values():
        assert set(r.base.split(",")) <= set(r.spans.split(",")) | {""}
    assert rows[HARD.index("anna.b7 (at) mail3 (dot) example (dot) com")].spans.startswith("email:0:")
    assert rows[HARD.index("date 2024-05-17 10:22 and 12345678")].spans == ""


def test_generators_propose_parts_of_long_runs_and_chained_addresses(spark):
    texts = {
        "4465758382889437 4465758382889437": {(0, 16), (17, 33)},
        "4111-1111-1111-1111 4111111111111112": {(0, 19), (20, 36)},
        "+1 (269) 555-3296 4524132264652876": {(0, 17), (18, 34)},
        "4111111111111111 2nd": {(0, 16)},
        "a (at) b (at) host (dot) com": {(7, 28)},
    }
    rows = pii.base_spans(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for r in rows:
        spans = {(s.start, s.end) for s in r["__wide"]}
        assert texts[r.text] <= spans, r.text
        assert all(r.text[s.start : s.end] == s.text for s in r["__wide"])


def test_model_adds_numbers_side_by_side_and_other_notations(spark):
    model = pii.fit(spark.read.parquet(f"{SF_MIDDLE}/documents.parquet"))
    texts = {
        "4465758382889437 4465758382889437": "card:0:16,card:17:33",
        "4111 1111 1111 1111 4111 1111 1111 1111": "card:0:19,card:20:39",
        "4111-1111-1111-1111 4111111111111112": "card:0:19",
        "+1 (269) 555-3296 4524132264652876 and": "card:18:34,phone:0:17",
        "+1 (269) 555-3296 (269) 555-3291": "phone:0:17,phone:18:32",
        "call 988-555-2485 now": "phone:5:17",
        "name (at) host (dot) com": "email:0:24",
        "on 2024-05-17 10 and 100 200 300 400": "",
    }
    rows = pii.find_spans(spark.createDataFrame([(t,) for t in texts], "text string"), model).select(
        "text", pii.span_text("__spans").alias("spans")).collect()
    assert {r.text: r.spans for r in rows} == texts


def test_redaction(spark, hard, odd_documents, no_documents):  # noqa: F811
    texts = {r.doc_id: r.text for r in pii.redact(hard, pii.SpanModel()).collect()}
    assert texts[0] is None and texts[1] == ""
    assert texts[HARD.index("+1 (555) 123-4567")] == "[PHONE]"
    assert texts[15] == "🙂 é [EMAIL] [PHONE], [IP]!"
    redacted = pii.redact(odd_documents, pii.SpanModel())
    assert redacted.columns == odd_documents.columns
    assert redacted.count() == odd_documents.count()
    assert pii.fit(no_documents).score is None
    assert pii.redact(no_documents, pii.SpanModel()).count() == 0


def test_an_id_with_a_third_of_all_rows_counts_once_in_training(spark, documents, labels,  # noqa: F811
                                                                monkeypatch):
    """What reaches the driver is bounded by ids, not by rows; rows without id are not drawn."""
    sizes, collect = [], DataFrame.toArrow

    def counted(frame):
        table = collect(frame)
        sizes.append(table.num_rows)
        return table

    monkeypatch.setattr(DataFrame, "toArrow", counted)
    n = documents.count()
    for known in [r.doc_id for r in labels.orderBy("doc_id").limit(4).collect()]:
        hot = spark.range(n).select(
            F.lit(known).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
        none = spark.range(n).select(
            F.lit(None).cast("bigint").alias("doc_id"), F.lit("x y").alias("text"))
        rows = documents.select("doc_id", "text").unionByName(hot).unionByName(none)
        sizes.clear()
        toxicity.fit(rows, labels)
        quality.fit(rows, labels)
        assert len(sizes) == 2 and max(sizes) <= n


def test_no_words_reach_the_driver_to_train_toxicity(spark, documents, labels,  # noqa: F811
                                                     monkeypatch):
    """The words of all examples did, and their features were counted there."""
    tables, stored = [], {}
    collect, store = DataFrame.toArrow, toxicity.written
    monkeypatch.setattr(DataFrame, "toArrow", lambda frame: tables.append(collect(frame)) or tables[-1])
    monkeypatch.setattr(toxicity, "written", lambda frame, label: stored.setdefault(
        label, store(frame, label)))
    model = toxicity.fit(documents, labels)
    assert [table.schema.names for table in tables] == [["doc_id", "features", "toxic", "drawn"]]
    # The same model as over the words of the same documents at hand.
    rows = stored["toxicity-words"].orderBy("doc_id").collect()
    known = labels.where("toxic IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 4 <> 2")
    prior = known.agg({"toxic": "avg"}).first()[0]
    at_hand = toxicity.train_model(
        lambda: (row.words.split() for row in rows if row.toxic),
        lambda: (row.words.split() for row in rows if row.drawn), prior)
    assert model.weights and model == at_hand


def test_all_documents_train_the_trees(spark, monkeypatch):
    documents = spark.range(20_400).selectExpr(
        "id AS doc_id", "concat('write to a', id, '@example.org') AS text")
    stored, store = {}, pii.written
    monkeypatch.setattr(
        pii, "written", lambda frame, label: stored.setdefault(label, store(frame, label)))
    pii.fit(documents)
    assert stored["pii-spans"].count() == 20_400
    assert stored["pii-candidates"].where("label = 1").agg({"n": "sum"}).first()[0] >= 20_400
