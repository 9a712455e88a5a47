"""A training corpus from raw documents: quality, toxicity, near duplicates, PII, packing.

Each stage takes all documents its predecessor kept, written as Parquet and read again.
Nulls, empty texts, repeated rows and empty tables are handled as the operators state; of
rows with the same ``doc_id`` and text one stays; further columns of the documents are kept
up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.llm import ngram_join, packing, pii, quality, toxicity
from hitloom.llm.tables import read_table, written

#: Word n-grams and Jaccard similarity, in hundredths, of near duplicates.
WIDTH, SIMILARITY = 5, 80


def _free_name(name: str, taken: list[str]) -> str:
    """A column name that none of those taken equals."""
    while name.lower() in {other.lower() for other in taken}:
        name = f"_{name}"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose quality score reaches the threshold stay."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score_rows(docs, model, keep=docs.columns)
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents whose toxicity score reaches the threshold go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_rows(docs, model, keep=docs.columns)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of every group of near duplicates the smallest ``doc_id`` stays.

    A document is an id with its text: rows of one id with different texts are compared
    like any others, and of texts of the smallest id the one of the smaller hash stays. Of
    rows with the same id and text the smallest by all columns stays. Documents without
    ``doc_id`` are not compared and stay.
    """
    names = docs.columns
    key, place = _free_name("document", names), _free_name("place", names)
    keyed = docs.withColumn(key, F.when(
        F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    groups = written(
        ngram_join.ngram_components(keyed, width=WIDTH, num=SIMILARITY, den=100, key=key)
        .select(F.col("doc_id").alias(key), "component_id").where(F.col(key).isNotNull())
        .join(keyed.select(key, "doc_id").distinct(), key), "near-duplicates")
    first = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", key)).alias("first"))
    gone = groups.select(key).distinct().join(first.select(f"first.{key}"), key, "left_anti")
    kept = keyed.join(gone, key, "left_anti")
    repeated = groups.groupBy(key).count().where("count > 1").select(key)
    if repeated.isEmpty():
        return kept.select(*names)
    ranked = Window.partitionBy(key).orderBy(F.to_json(F.struct(*names)))
    once = (kept.join(repeated, key, "left_semi")
            .withColumn(place, F.row_number().over(ranked)).where(F.col(place) == 1))
    return kept.join(repeated, key, "left_anti").unionByName(once.drop(place)).select(*names)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: personal data is replaced by its kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return redacted
    length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return redacted.withColumn("n_chars", length.cast(dict(docs.dtypes)["n_chars"]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the pieces of all documents with their place in a sequence."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_pii),
    ("packing", pack),
]

#: Two stages are trained models and one is a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
