"""Sharding along a Hilbert curve over document metadata.

Each dimension is quantised to ``2**bits`` cells in its own order, as measured on the table: names (language, source) by their rank
among the different names, sizes by their quantile. The cells become one curve index, documents are
ordered by it and the order is cut into runs of equal row counts. Neighbours on the curve are close
in every dimension, so each shard spans a narrow range of each and a reader can skip shards by the
minimum and maximum of any of them (``ranges``).

Defined results: null text has size 8, crc32 0 and length 0; a null or absent dimension falls into cell 0; rows
equal in all of the order's columns are interchangeable; an empty table gives an empty result;
shards beyond the number of rows stay empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.names import free_names
from gleanery.llm.prefix import ranked, row_key, unique_rows
from gleanery.llm.stage import written

BITS = 10
#: Bins of a size for each doubling.
BINS = 32
SHARDS = 24


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index of the cell on the Hilbert curve as a long, vectorised over Arrow batches."""
    if not 0 < len(cells) * bits < 64:
        raise ValueError("dimensions x bits must be below 64")

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        return pd.Series(curve(np.stack([c.to_numpy(np.int64) for c in columns]), bits))

    return index(*[c.cast("long") for c in cells])


def curve(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of cells (one row of ``cells`` per dimension).

    From the highest bit plane down, the sub-cube's orientation is undone (its low bits are
    inverted or exchanged with the first axis), which leaves a Gray code; the code's bits are then
    read across the axes, plane by plane.
    """
    x = cells.copy()
    for plane in range(bits - 1, 0, -1):
        low = (1 << plane) - 1
        for axis in range(len(x)):
            upper = (x[axis] >> plane) & 1 == 1
            exchange = np.where(upper, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(upper, low, exchange)
            if axis:
                x[axis] ^= exchange
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> plane) & 1 == 1, (1 << plane) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for plane in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            out = (out << 1) | ((x[axis] >> plane) & 1)
    return out


def size_bin(value: Column) -> Column:
    """A fine logarithmic bin of a size, at most ``64 * BINS`` of them."""
    return F.floor(F.log2(F.coalesce(value, F.lit(0)).cast("double") + 1) * BINS).cast("int")


def quantile_cell(bins: DataFrame, bits: int = BITS) -> Column:
    """Cell of the column ``bin`` of ``bins``: the share of rows in smaller bins, so that cells have about as many rows each.

    The counts of the bins come to the driver: a bounded number, whatever the table.
    """
    counts = sorted((r["bin"], r["n"]) for r in bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect())
    total, before, cells = sum(n for _, n in counts), 0, {}
    for value, n in counts:
        cells[value] = (before << bits) // total
        before += n
    every = [cells.get(v, 0) for v in range(max(cells, default=0) + 1)]
    return F.element_at(F.array(*[F.lit(c) for c in every]), F.col("bin") + 1)


def name_cells(names: DataFrame, bits: int = BITS) -> DataFrame:
    """(name, cell) of the different values of ``name``: cells ascend with the names and are dealt evenly among them, so that
    few names lie far apart and their rows stay together. Null has no row (and cell 0)."""
    known = ranked(names.where("name IS NOT NULL").distinct(), ["name"])
    total = known.count()
    return known.select("name", F.floor((F.col("rank") + 1) * (1 << bits) / (total + 1)).alias("cell"))


def slim(docs: DataFrame, *extra: Column) -> DataFrame:
    """doc_id, size, text_crc32, ``extra`` and the curve index of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    have = {c.lower() for c in docs.columns}
    size = F.octet_length(text).cast("long")
    names = [F.col(c).cast("string") if c in have else F.lit(None).cast("string") for c in ("lang", "source")]
    rows = written(
        docs.select(
            "doc_id", (size + 8).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.struct(*extra).alias("more") if extra else F.lit(None).alias("more"),
            names[0].alias("lang"), names[1].alias("source"), size_bin(size).alias("bin"),
        )
    )
    for c in ("lang", "source"):
        cells = name_cells(rows.select(F.col(c).alias("name"))).select(F.col("name").alias(f"{c}_name"), F.col("cell").alias(f"{c}_cell"))
        rows = rows.join(cells, F.col(c) == F.col(f"{c}_name"), "left")
    index = hilbert_index([F.coalesce("lang_cell", F.lit(0)), F.coalesce("source_cell", F.lit(0)), quantile_cell(rows)])
    more = ["more.*"] if extra else []
    return rows.select("doc_id", "size", "text_crc32", *more, index.alias("curve"))


ORDER = ["curve", "text_crc32", "doc_id"]


def assign(rows: DataFrame, shards: int = SHARDS, order: list[str] | None = None) -> DataFrame:
    """``rows`` plus shard and slot: runs of the order whose counts differ by one at most."""
    placed = ranked(rows, order or ORDER)
    total = placed.count()
    each, longer = divmod(total, shards)
    # The first `longer` shards have each + 1 rows.
    cut = longer * (each + 1)
    rank = F.col("rank")
    early = F.floor(rank / (each + 1))
    late = F.floor((rank - cut) / max(each, 1))
    shard = F.when(rank < cut, early).otherwise(late + longer)
    slot = F.when(rank < cut, rank - early * (each + 1)).otherwise(rank - cut - late * each)
    return placed.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")}).drop("rank")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard, slot."""
    return assign(slim(docs), shards)


def place(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` plus shard and slot; columns of these names are replaced, all others stay, whatever their names."""
    plain = docs.drop("shard", "slot")
    (key,) = free_names(plain, "place_key")
    placed = assign(slim(plain, row_key(plain, key)), shards, [*ORDER, key]).select(key, "shard", "slot")
    return unique_rows(plain, key).join(placed, key).drop(key)


def ranges(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Least and greatest value of ``columns`` per shard, for skipping shards."""
    return sharded.groupBy("shard").agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard, files in slot order; many tasks share a large shard."""
    writer = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
