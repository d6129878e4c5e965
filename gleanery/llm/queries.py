"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import alignment, bottomk, decontaminate, divergence, embeddings, filter_audit, hilbert, licenses, mixing, quality, substrings, toxicity, warc
from gleanery.llm.oracle import ORACLE
from gleanery.sources.tables import read_table

__all__ = ["ORACLE", "QUERIES"]


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in training order under a curriculum whose mean weights are 5, 2, 1, repeating."""
    docs = read_table(spark, sf, "documents")
    planned = mixing.plan(docs, mixing.cycle_schedule(docs))
    return mixing.training_order(planned).select("doc_id", "size", "source_size", "target", "taken")


def op2_substrings(spark: SparkSession, sf: str) -> DataFrame:
    thinned = substrings.dedup_substrings(read_table(spark, sf, "documents"))
    return thinned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_divergence(spark: SparkSession, sf: str) -> DataFrame:
    judged = divergence.judge(read_table(spark, sf, "documents"))
    return judged.drop("char_distance", "word_distance")


def op4_quality_trees(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    scored = quality.classify(docs, read_table(spark, sf, "labels"))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, read_table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return bottomk.near_duplicates(read_table(spark, sf, "documents")).drop("class_id")


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as WARC archives, normalised into members and read back by the index."""
    return warc.archive_pages(read_table(spark, sf, "pages"), with_payload=False).drop("url", "payload")


def op8_hilbert(spark: SparkSession, sf: str) -> DataFrame:
    sharded = hilbert.shard_documents(read_table(spark, sf, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    rated = toxicity.rate_documents(docs, read_table(spark, sf, "labels"))
    return rated.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        *[name for name, _ in toxicity.CATEGORIES],
        F.col("toxic").alias("score"),
        (F.col("toxic") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf, "documents"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(read_table(spark, sf, "documents"))


def op13_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_substrings,
        op3_divergence,
        op4_quality_trees,
        op5_decontaminate,
        op6_near_dedup,
        op7_warc,
        op8_hilbert,
        op9_toxicity,
        op10_licenses,
        op11_filter_audit,
        op12_alignment,
        op13_embeddings,
    )
}
