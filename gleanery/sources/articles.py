"""Article files: many ``<doc id url title> ... </doc>`` records per text file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions.sampling import sample_by_key
from gleanery.functions.text import header_attribute

#: What ends a record: a line that begins so.
CLOSING, OPENING = "\n</doc>", "\n<doc "
#: Names of files that Spark unpacks, so that their size does not tell how they end.
PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"


def read_files(
    spark: SparkSession, glob: str, fraction: float = 1.0, seed: int = 1
) -> DataFrame:
    """Whole files as (path, text); a fraction below 1 keeps a sample of the files."""
    files = spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
    return sample_by_key(files, ["path"], fraction, seed)


def file_names(
    spark: SparkSession, glob: str, fraction: float = 1.0, seed: int = 1
) -> DataFrame:
    """(path) of the files that ``read_files`` and ``read_records`` take; their content is not read."""
    files = spark.read.format("binaryFile").load(glob)
    return sample_by_key(files.select(F.col("_metadata.file_path").alias("path")), ["path"], fraction, seed)


def read_records(
    spark: SparkSession, glob: str, fraction: float = 1.0, seed: int = 1
) -> DataFrame:
    """(path, position, record) of the closed records of files of any size; a fraction below 1 keeps a sample of the files.

    The text source splits files between records, so many tasks share a large file and none holds
    more than a record and a batch. Rows are numbered within their split as they flow by; a first pass over the
    files counts the records of each split, and splits that do not begin their file add what is before them. Only
    those are broadcast: at most one per ``spark.sql.files.maxPartitionBytes`` of text.

    An unclosed last record is left out; in a packed file it counts as closed.
    """
    rows = spark.read.option("lineSep", CLOSING).text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("record"),
    )
    rows = sample_by_key(rows, ["path"], fraction, seed)
    counts, open_ends = _splits(rows)
    placed = rows.select("path", "start", "record").mapInArrow(_number, "path string, start long, at long, record string")
    moved = placed.join(F.broadcast(counts), ["path", "start"], "left")
    position = F.col("at") + F.coalesce("offset", F.lit(0))
    records = moved.select("path", position.alias("position"), "record")
    return records.join(open_ends, ["path", "position"], "left_anti")


def _splits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, start, offset): records before each split that does not begin its file; and (path, position) of last
    records that open an article and are not closed."""
    opens = F.concat(F.lit("\n"), F.col("record")).contains(OPENING)
    each = rows.select(
        "path", "size", "start", (F.octet_length("record") + len(CLOSING)).alias("bytes"), opens.alias("opens"),
        F.monotonically_increasing_id().alias("place"),
    )
    splits = each.groupBy("path", "size", "start").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.max_by("opens", "place").alias("opens")
    )
    # A few splits per file.
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "start", F.sum("n").over(before).alias("offset")).where("offset > 0")
    files = splits.groupBy("path", "size").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max_by("opens", "start").alias("opens")
    )
    # Every record was counted with a closing line; one too many makes the sum larger than the file.
    unclosed = files.where("bytes > size AND opens").where(~F.col("path").rlike(PACKED))
    return offsets, unclosed.select("path", (F.col("n") - 1).alias("position"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, done = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, start = batch.column("path"), batch.column("start")
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        new[0] = last != (path[0].as_py(), start[0].as_py())
        place = np.arange(batch.num_rows)
        first = np.maximum.accumulate(np.where(new, place, -1))
        at = np.where(first < 0, place + done, place - first)
        last, done = (path[-1].as_py(), start[-1].as_py()), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([path, start, pa.array(at), batch.column("record")], ["path", "start", "at", "record"])


def split_records(files: DataFrame) -> DataFrame:
    """The same (path, position, record) of whole files (path, text)."""
    closed = F.split("text", CLOSING)
    return files.select(
        "path", F.posexplode(F.slice(closed, 1, F.size(closed) - 1)).alias("position", "record")
    )


def parse_records(records: DataFrame) -> DataFrame:
    """Articles (path, position, wiki_id, url, title, content) of closed records.

    A record starts at its last line ``<doc ...>``; records without a title or without a content line are dropped. The
    content keeps its line ends.
    """
    # Only a file begins a line without a line end before it.
    piece = F.when(F.col("position") == 0, F.concat(F.lit("\n"), F.col("record"))).otherwise(F.col("record"))
    opened = records.select("path", "position", piece.alias("piece")).filter(F.col("piece").contains(OPENING))
    record = opened.select("path", "position", F.element_at(F.split("piece", OPENING), -1).alias("record"))
    parts = record.filter(F.locate("\n", F.col("record")) > 0).select(
        "path",
        "position",
        F.substring_index("record", "\n", 1).alias("header"),
        F.concat(F.expr("substring(record, locate('\n', record) + 1)"), F.lit("\n")).alias(
            "content"
        ),
    )
    return parts.select(
        "path",
        "position",
        header_attribute(F.col("header"), "id").alias("wiki_id"),
        header_attribute(F.col("header"), "url").alias("url"),
        header_attribute(F.col("header"), "title").alias("title"),
        "content",
    ).filter(F.col("title") != "")


def extract_articles(files: DataFrame) -> DataFrame:
    """Articles of whole files (path, text), see ``parse_records``."""
    return parse_records(split_records(files))


def read_articles(
    spark: SparkSession, glob: str, fraction: float = 1.0, seed: int = 1
) -> DataFrame:
    """Documents (doc_id, title, text) of article files."""
    return as_documents(parse_records(read_records(spark, glob, fraction, seed)))


def as_documents(articles: DataFrame) -> DataFrame:
    """(doc_id, title, text); the id is a hash of file path and position."""
    return articles.select(
        F.xxhash64("path", F.col("position").cast("long")).alias("doc_id"), "title", F.col("content").alias("text")
    )
