"""Movie plots: quoted, multi-line CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the movie file.
MOVIE_SCHEMA = T.StructType(
    [
        T.StructField("Release Year", T.IntegerType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Origin/Ethnicity", T.StringType()),
        T.StructField("Director", T.StringType()),
        T.StructField("Cast", T.StringType()),
        T.StructField("Genre", T.StringType()),
        T.StructField("Wiki Page", T.StringType()),
        T.StructField("Plot", T.StringType()),
    ]
)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    """Documents (doc_id, title, genre, text); rows without a plot are dropped.

    The id is the place of the row (file split and row), so equal rows are documents of their own. It
    holds for one read of the same files; jobs stage what they derive from it.
    """
    rows = spark.read.options(header=True, quote='"', escape='"', multiLine=True)
    movies = rows.schema(MOVIE_SCHEMA).csv(path)
    return movies.filter(F.col("Plot").isNotNull()).select(
        F.monotonically_increasing_id().alias("doc_id"),
        F.col("Title").alias("title"),
        F.coalesce("Genre", F.lit("Unknown")).alias("genre"),
        F.col("Plot").alias("text"),
    )
