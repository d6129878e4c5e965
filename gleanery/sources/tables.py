"""Plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanery.session import spread


def read_table(
    spark: SparkSession, folder: str, name: str, spread_by: str | None = None
) -> DataFrame:
    """A Parquet table; ``spread_by`` names the key to spread a small one over the cores,
    worth it before costly row work such as tokenising."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(table, spread_by) if spread_by else table
