"""Sensor runs: headerless CSV files named ``Run_<n>.csv``, and exported samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sensor columns.
SENSORS = ["sensor1", "sensor2", "sensor3"]
SAMPLE_SCHEMA = "sensor1 double, sensor2 double, sensor3 double, cluster int, distance double"


RUN_PATTERN = r"Run_(\d+)\.csv"


def run_id(path: Column, pattern: str = RUN_PATTERN) -> Column:
    """Number in a file name; NULL when the name does not match."""
    return F.regexp_extract(path, pattern, 1).try_cast("int")


#: What can be wrong with a line. Only ``EXTRA`` leaves a usable reading, that of its first fields.
SHORT, EXTRA, NOT_A_NUMBER, MISSING = "too short", "extra fields", "not a number", "missing value"


def read_runs(spark: SparkSession, glob: str, pattern: str = RUN_PATTERN) -> DataFrame:
    """Readings (runId, sensor1..3); malformed or missing numbers are NULL."""
    return read_checked_runs(spark, glob, pattern).select("runId", *SENSORS)


def read_checked_runs(spark: SparkSession, glob: str, pattern: str = RUN_PATTERN) -> DataFrame:
    """Readings (runId, sensor1..3) with their ``file`` and what is wrong with the line (``problem``, NULL if nothing is)."""
    schema = T.StructType([*[T.StructField(s, T.DoubleType()) for s in SENSORS], T.StructField("line", T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line")
    rows = reader.csv(glob).select(*SENSORS, "line", F.col("_metadata.file_path").alias("file"))
    fields = F.size(F.split("line", ","))
    empty = reduce(lambda a, b: a | b, [F.col(s).isNull() for s in SENSORS])
    # The parser keeps a line only where it could not read it as it is.
    problem = (
        F.when(fields < len(SENSORS), SHORT)
        .when(fields > len(SENSORS), EXTRA)
        .when(F.col("line").isNotNull(), NOT_A_NUMBER)
        .when(empty, MISSING)
    )
    return rows.select(run_id(F.col("file"), pattern).alias("runId"), *SENSORS, "file", problem.alias("problem"))


def reading_problems(readings: DataFrame) -> DataFrame:
    """(file, runId, problem, lines, usable): lines by what is wrong with them, and how many of them still give a reading."""
    whole = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in SENSORS])
    return readings.where("problem IS NOT NULL").groupBy("file", "runId", "problem").agg(
        F.count("*").alias("lines"), F.count(F.when(whole, 1)).alias("usable")
    )


def complete_readings(readings: DataFrame, cols: list[str]) -> DataFrame:
    """Readings that have a value in every column."""
    return readings.dropna(subset=cols)


def read_cluster_samples(spark: SparkSession, folder: str) -> DataFrame:
    """All exported samples below ``folder`` with their ``k``; empty files add no rows."""
    rows = spark.read.schema(f"{SAMPLE_SCHEMA}, k int").option("header", True)
    return rows.csv(folder)
