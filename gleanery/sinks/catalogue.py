"""All models of a sweep in one set of tables, partitioned by variant, num_terms and k.

One read sees every model and a filter on the partition columns reads the files of those it keeps only. A model
replaces its own partitions (dynamic overwrite) and no others. Its row in ``runs`` is written last, and only
models that have one are listed or loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.lsa import LsaModel
from gleanery.sinks.model_store import TABLES, checked_model, model_tables

KEYS = ["variant", "num_terms", "k"]
RUNS = "rank int, energy double, share double, seconds double, token_seconds double"


def _write(rows: DataFrame, root: str, table: str, key: tuple[str, int, int]) -> None:
    # The model's own term and concept counts make room for the keys of the catalogue.
    plain = rows.withColumnsRenamed({c: f"model_{c}" for c in KEYS if c in rows.columns})
    keyed = plain.withColumns({c: F.lit(v) for c, v in zip(KEYS, key)})
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(f"{root}/{table}")


def add_model(model: LsaModel, root: str, variant: str, num_terms: int, k: int, run: tuple) -> None:
    """Store a model and its run (rank, energy, share, seconds, token_seconds) under the asked sizes."""
    key = (variant, num_terms, k)
    for table, rows in model_tables(model).items():
        _write(rows, root, table, key)
    add_run(model.doc_factors.sparkSession, root, key, run)


def add_run(spark: SparkSession, root: str, key: tuple[str, int, int], run: tuple) -> None:
    _write(spark.createDataFrame([run], RUNS), root, "runs", key)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """(variant, num_terms, k, rank, energy, share, seconds, token_seconds) of all models."""
    rows = spark.read.parquet(f"{root}/runs")
    return rows.select(*KEYS, *[c for c in rows.columns if c not in KEYS])


def read_models(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of all models with their keys; filters on these prune files."""
    return spark.read.parquet(f"{root}/{table}")


def load_from(spark: SparkSession, root: str, variant: str, num_terms: int, k: int) -> LsaModel:
    """One model of the catalogue."""
    chosen = (F.col("variant") == variant) & (F.col("num_terms") == num_terms) & (F.col("k") == k)
    if runs(spark, root).where(chosen).isEmpty():
        raise FileNotFoundError(f"the catalogue at {root} has no model {variant}, {num_terms} terms, k {k}")
    frames = {}
    for table in TABLES:
        rows = read_models(spark, root, table).where(chosen).drop(*KEYS)
        frames[table] = rows.withColumnsRenamed({f"model_{c}": c for c in KEYS})
    return checked_model(frames, f"model {variant}, {num_terms} terms, k {k} of the catalogue at {root}")
