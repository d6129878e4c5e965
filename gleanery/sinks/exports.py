"""Sampled cluster export: headed CSV, one folder per k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def export_samples(assigned: DataFrame, folder: str, columns: Sequence[str]) -> None:
    """Write assigned points (k, ...) as headed CSV below ``folder/k=<k>``."""
    rows = assigned.select("k", *columns, "cluster", "distance")
    rows.write.partitionBy("k").option("header", True).csv(folder)


def sample_means(samples: DataFrame) -> DataFrame:
    """(k, mean_distance) over exported samples."""
    return samples.groupBy("k").agg(F.avg("distance").alias("mean_distance"))


def sample_outliers(samples: DataFrame, columns: Sequence[str], n: int = 25) -> DataFrame:
    """The ``n`` farthest sampled points for every k."""
    order = Window.partitionBy("k").orderBy(F.desc("distance"), *columns)
    return samples.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def cluster_rows(samples: DataFrame, cluster: int) -> DataFrame:
    return samples.filter(F.col("cluster") == cluster)
