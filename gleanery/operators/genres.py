"""Titles and genres of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import split_items


def genre_by_title(docs: DataFrame) -> DataFrame:
    """(title, genre): one genre per title, that of the largest ``doc_id``."""
    return docs.groupBy("title").agg(F.max_by("genre", "doc_id").alias("genre"))


def with_titles(hits: DataFrame, titles: DataFrame) -> DataFrame:
    """Hits with ``title`` looked up by ``doc_id``; ``unknown`` when there is none."""
    found = hits.join(titles.select("doc_id", "title"), "doc_id", "left")
    return found.withColumn("title", F.coalesce("title", F.lit("unknown")))


def with_genres(hits: DataFrame, genres: DataFrame) -> DataFrame:
    """Hits with ``genre`` looked up by title; ``Unknown`` when there is none."""
    found = hits.join(genres, "title", "left")
    return found.withColumn("genre", F.coalesce("genre", F.lit("Unknown")))


def first_genres(docs: DataFrame, n: int = 5) -> DataFrame:
    """Adds ``genres``, the first ``n`` trimmed items of the comma list ``genre``."""
    return docs.withColumn("genres", F.slice(split_items(F.col("genre")), 1, n))
