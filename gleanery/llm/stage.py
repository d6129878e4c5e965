"""Results kept in the shared folder, so that a lost executor costs a read and nothing is computed twice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gleanery.session import checkpoint_dir


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the one the cluster shares, grouped by application."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "stage") -> DataFrame:
    """``df`` written once as Parquet and read again. Unlike an eager ``checkpoint``, which runs its
    plan once to count and once to save, this runs it once."""
    path = shared_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Delete what this application has staged; results read from it are gone, too."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
