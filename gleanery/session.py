"""Session set-up, shared folder, scopes of what a job holds, and size checks for small sides."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a fresh local one only for local masters."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name in the shared folder, below one for each application."""
    return f"{_scratch_root(spark)}/{kind}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/gleanery-{spark.sparkContext.applicationId}"


#: Open scopes, the innermost last: what is to be released at the end of each.
_SCOPES: ContextVar[tuple[list, ...]] = ContextVar("gleanery_scopes", default=())


@contextmanager
def job_scope():
    """Owns what is persisted, broadcast and staged inside it through this module, and frees it at the end, after a failure, too.

    Frames that are to be read afterwards have to be ``kept``. Without a scope nothing is freed
    before the session ends or ``drop_scratch``: lazy results may still need it.
    """
    held: list[Callable[[], None]] = []
    token = _SCOPES.set((*_SCOPES.get(), held))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for release in reversed(held):
            release()


def owned(release: Callable[[], None]) -> None:
    """Have the innermost scope call ``release`` at its end."""
    if _SCOPES.get():
        _SCOPES.get()[-1].append(release)


def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    df.persist(level)
    owned(df.unpersist)
    return df


def shared(spark: SparkSession, value):
    """A broadcast of a value of bounded size."""
    sent = spark.sparkContext.broadcast(value)
    owned(sent.destroy)
    return sent


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder so that a lost executor costs a re-read only.

    An eager ``checkpoint`` would run the plan twice, once to count and once to save.
    """
    path = scratch_folder(df.sparkSession, "stage")
    owned(lambda: delete_folder(df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """``df`` staged so that it outlives the innermost scope; the next one around it owns it."""
    token = _SCOPES.set(_SCOPES.get()[:-1])
    try:
        return staged(df)
    finally:
        _SCOPES.reset(token)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def shared_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """(Arrow file system, path) by which a task opens a file of the shared folder."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged. Tables read from it are gone, too."""
    delete_folder(spark, _scratch_root(spark))


def fits(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> bool:
    """True when ``df`` is proven to stay within both bounds.

    Reads at most ``max_rows + 1`` rows.
    """
    width = F.length(F.to_json(F.struct(*df.columns)))
    seen = (
        df.limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b"))
        .first()
    )
    return seen["n"] <= max_rows and seen["b"] <= max_bytes


def local_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A small driver-side table; Arrow columns become a local relation without a job."""
    return spark.createDataFrame(pa.table(columns))


SPREAD = "spark.gleanery.spread"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash a table over the cores if the session sets ``spark.gleanery.spread`` to ``true``.

    For tables of a single file, which one task would read whatever the number of cores; a table of
    many files has its tasks already and should not be shuffled.
    """
    if df.sparkSession.conf.get(SPREAD, "false") != "true":
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
