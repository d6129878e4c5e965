"""Stop-word lists: one word per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import STOP_WORDS


def read_stop_words(spark: SparkSession, path: str | None = None) -> list[str] | DataFrame:
    """Distinct lines of a file as a table (word), or the built-in list without a path."""
    if path is None:
        return list(STOP_WORDS)
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()
