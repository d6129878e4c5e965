"""Cleans, thins out, mixes and shards ``documents`` with the operators of ``gleanery.llm``.

Every stage takes all documents that the one before kept, and its result is written as Parquet to
the shared folder and read again. The last stage adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import bottomk, decontaminate, hilbert, mixing, quality
from gleanery.llm.stage import written
from gleanery.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the trees reject."""
    scored = quality.score(docs, quality.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))
    return scored.where(scored["score"] >= quality.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles)."""
    return bottomk.drop_near_duplicates(docs, words=5, similarity=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that have a window of a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that each source has its share, in training order."""
    return mixing.mix(docs, mixing.cycle_schedule(docs))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their shard and slot along the Hilbert curve."""
    return hilbert.place(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", sharding),
]

#: The first stage's trees cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
