"""Running totals over a whole table without one task seeing more than its share.

Rows are dealt by range of the sort key, staged so that a retried task finds the same rows, counted
per partition, and numbered from the offsets of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.names import column
from gleanery.llm.stage import written


def ranked(rows: DataFrame, order: list[Column | str], value: str | None = None) -> DataFrame:
    """``rows`` plus ``rank`` (0-based place in ``order``) and, for ``value``, the sum of it over
    all rows before (``before``). ``order`` should be total for the result to be repeatable.

    The window over the offsets sees one row per partition. Give slim rows: they are staged once.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.spark_partition_id()
    dealt = written(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": part, "_place": F.monotonically_increasing_id()})
    )
    amount = F.col(value) if value else F.lit(0)
    sizes = dealt.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_v"), F.min("_place").alias("_first")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_value_before"),
    )
    # One row per partition of the exchange above: bounded by the setting.
    placed = dealt.join(F.broadcast(offsets), "_part").withColumn(
        "rank", F.col("_rows_before") + F.col("_place") - F.col("_first")
    )
    if value:
        inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn(
            "before", F.col("_value_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))
        )
    return placed.drop("_part", "_place", "_first", "_rows_before", "_value_before")


def row_key(rows: DataFrame, name: str = "_key") -> Column:
    """A 128-bit digest of the whole row as ``name``: equal for repeated rows only.

    Each cell is written with its length before it, so no string can pass for a null or for two cells.
    """
    texts = [column(c).cast("string") for c in rows.columns]
    cells = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*cells).cast("binary")).alias(name)


def unique_rows(rows: DataFrame, name: str = "_key") -> DataFrame:
    """Each different row once, with its key as ``name``; the digest decides, so texts are not compared.

    ``name`` should be free: a column of that name is replaced.
    """
    return rows.select("*", row_key(rows, name)).dropDuplicates([name])
