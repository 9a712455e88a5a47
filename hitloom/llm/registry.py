"""One query per operator, each over its whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hitloom.llm import (
    bpe,
    embedding_dedup,
    fingerprint,
    hard_negatives,
    main_text,
    ngram_join,
    packing,
    pii,
    quality,
    sharding,
    spelling,
    token_files,
    toxicity,
)
from hitloom.llm.labelled import held_out
from hitloom.llm.oracle import ORACLE_SQL
from hitloom.llm.tables import read_table

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(read_table(spark, sf_dir, "documents"))
    return bpe.decode_documents(encoded).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_bottom_k_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(read_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    folder = token_files.token_file_folder(documents)
    manifest = token_files.write_token_files(documents, folder)
    return token_files.read_token_files(manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _predicted(scored: DataFrame, folds: int, remainder: int, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out("doc_id", folds, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op4_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, read_table(spark, sf_dir, "labels"))
    return _predicted(toxicity.score_documents(documents, model),
                      toxicity.FOLDS, toxicity.REMAINDER, toxicity.THRESHOLD)


def op5_discriminant_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = quality.fit(documents, read_table(spark, sf_dir, "labels"))
    return _predicted(quality.score_documents(documents, model),
                      quality.FOLDS, quality.REMAINDER, quality.THRESHOLD)


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    found = pii.find_spans(documents.select("doc_id", "text"), pii.fit(documents))
    counts = [F.size(F.expr(f"filter(__base, s -> s.kind = '{kind}')")).cast("bigint")
              .alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_text("__base"), 256).alias("base_sha256"),
                        pii.span_text("__spans").alias("spans"))


def op8_pigeonhole_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(
        read_table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(read_table(spark, sf_dir, "documents"), drop_one_in=31)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(read_table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = read_table(spark, sf_dir, "embeddings")
    # Some labels are moved on by one, as if they had been given wrongly.
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10)
    labelled = embeddings.withColumn("label", moved.otherwise(F.col("label")))
    return hard_negatives.hard_negatives(labelled, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_bottom_k_fingerprint": op2_bottom_k_fingerprint,
    "op3_token_files": op3_token_files,
    "op4_nnpu_toxicity": op4_nnpu_toxicity,
    "op5_discriminant_quality": op5_discriminant_quality,
    "op6_pattern_packing": op6_pattern_packing,
    "op7_boosted_pii": op7_boosted_pii,
    "op8_pigeonhole_dedup": op8_pigeonhole_dedup,
    "op9_extendible_shards": op9_extendible_shards,
    "op10_ngram_join": op10_ngram_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_main_text": op12_main_text,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
