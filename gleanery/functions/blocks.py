"""Arrow block kernels: sparse rows times a small matrix, and top rows per direction.

Both run inside ``mapInArrow``; Spark partitions the rows, each task works on one
record batch at a time, and only the small matrix is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.session import shared, shared_path

#: Bytes of a matrix that are sent to the tasks at once; a larger one goes in blocks of columns.
BLOCK_BYTES = 64 << 20
_MAX_WORK_CELLS = 1 << 22
#: Scores that agree in this many leading digits tie: sums differ in the last ones by their order.
SCORE_DIGITS = 12


def share_matrix(df: DataFrame, matrix: np.ndarray):
    return shared(df.sparkSession, np.ascontiguousarray(matrix))


def column_blocks(matrix: np.ndarray, block_bytes: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(first column, columns) of blocks of bounded size."""
    size = block_bytes or BLOCK_BYTES
    step = max(1, size // max(1, 8 * matrix.shape[0]))
    for first in range(0, max(1, matrix.shape[1]), step):
        yield first, matrix[:, first : first + step]


def leading_digits(scores: np.ndarray, digits: int = SCORE_DIGITS) -> np.ndarray:
    """Scores rounded to their leading digits, whatever their size (but for the ends of the doubles)."""
    held = (np.abs(scores) > 1e-290) & (np.abs(scores) < 1e290)
    plain = np.where(held, scores, 1.0)
    unit = 10.0 ** (digits - 1 - np.floor(np.log10(np.abs(plain))))
    return np.where(held, np.round(plain * unit) / unit, scores) + 0.0


def leading_digits_of(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """The same for a column."""
    size = F.abs(score)
    unit = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(size)))
    return F.when((size > 1e-290) & (size < 1e290), F.rint(score * unit) / unit).otherwise(score)


def sparse_product(ids: pa.Array, weights: pa.Array, matrix: np.ndarray) -> np.ndarray:
    """Rows given as (term ids, weights) lists times ``matrix``."""
    lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    columns = ids.flatten().to_numpy(zero_copy_only=False)
    values = weights.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), matrix.shape[1]))
    step = max(1, _MAX_WORK_CELLS // max(1, matrix.shape[1]))
    first = 0
    while first < len(ids):
        base = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, base + step, side="right")))
        filled = np.flatnonzero(lengths[first:last])
        if len(filled):
            part = slice(base, ends[last - 1])
            cells = matrix[columns[part]] * values[part, None]
            starts = (ends - lengths)[first:last][filled] - base
            out[first + filled] = np.add.reduceat(cells, starts, axis=0)
        first = last
    return out


def dense_rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def project_rows(df: DataFrame, matrix: np.ndarray, keep: list[str], out: str) -> DataFrame:
    """Replace sparse ``ids``/``weights`` by the dense product with ``matrix``.

    Rows flow through one ``mapInArrow`` per block of columns within a stage.
    """
    vector = T.ArrayType(T.DoubleType())
    carried = [*keep, "ids", "weights"]
    rows = df.select(*carried, F.array().cast(vector).alias(out))
    schema = T.StructType([*(rows.schema[c] for c in carried), T.StructField(out, vector)])
    for _, block in column_blocks(matrix):
        rows = rows.mapInArrow(_extend(share_matrix(df, block), out), schema)
    return rows.select(*keep, out)


def _extend(sent, out: str):
    """Append the product with a block of columns to the rows of ``out``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            n = batch.num_rows
            product = sparse_product(batch.column("ids"), batch.column("weights"), m)
            before = batch.column(out).flatten().to_numpy(zero_copy_only=False)
            both = np.hstack([before.reshape(n, -1) if n else product, product])
            offsets = np.arange(n + 1, dtype=np.int32) * both.shape[1]
            rows = pa.ListArray.from_arrays(pa.array(offsets), pa.array(both.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], rows], batch.schema.names)

    return run


def best_rows(table: pa.Table, n: int, group: str, order: list[tuple[str, str]]) -> pa.Table:
    """At most ``n`` rows per integer ``group`` in the given order."""
    table = table.take(pc.sort_indices(table, sort_keys=[(group, "ascending"), *order]))
    keys = table.column(group).to_numpy()
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    place = np.arange(len(keys)) - np.repeat(new, np.diff(np.r_[new, len(keys)]))
    return table.filter(pa.array(place < n))


def _batch_best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of the best ``n`` rows per column; earlier rows win ties."""
    rows, directions = [], []
    for j in range(scores.shape[1]):
        column = scores[:, j]
        if len(column) > n:
            cut = np.partition(column, len(column) - n)[len(column) - n]
            found = np.flatnonzero(column >= cut)
            found = found[np.argsort(-column[found], kind="stable")[:n]]
        else:
            found = np.arange(len(column))
        rows.append(found)
        directions.append(np.full(len(found), j, dtype=np.int32))
    return np.concatenate(rows), np.concatenate(directions)


def top_rows(
    df: DataFrame,
    matrix: np.ndarray,
    n: int,
    id_col: str,
    keep: list[str],
    vector: str | None = None,
) -> DataFrame:
    """Exact top ``n`` rows per column of ``rows x matrix`` as (direction, rank, score, ...).

    Rows are the dense ``vector`` column, or sparse ``ids``/``weights`` when it is None.
    Every task sends on at most ``n`` rows per direction, so the shuffle that merges
    them does not grow with the rows. Scores tie if their ``SCORE_DIGITS`` leading digits agree,
    so equal rows tie wherever they are stored; the larger id wins a tie. A matrix above
    ``BLOCK_BYTES`` is used in blocks of columns, each with a read of the rows.
    """
    found = None
    for first, block in column_blocks(matrix):
        sent = share_matrix(df, block)
        best = _top_rows(df, lambda sent=sent: (sent.value, None), 0, n, id_col, keep, vector)
        best = best.withColumn("direction", (F.col("direction") + first).cast("int"))
        found = best if found is None else found.unionByName(best)
    return found


def top_columns(
    df: DataFrame, width: int, n: int, id_col: str, keep: list[str], vector: str
) -> DataFrame:
    """The same for the columns of the ``vector`` rows themselves, without a product."""
    return _top_rows(df, lambda: (None, None), width, n, id_col, keep, vector)


def top_rows_of_file(
    df: DataFrame, file: str, label: T.StructField, n: int, id_col: str, keep: list[str], vector: str
) -> DataFrame:
    """The same with directions from a Parquet file (``label``, vector) of the shared folder, which every task
    reads; ``label`` names the direction in the result. A file without rows gives none."""

    def load():
        system, path = shared_path(file)
        table = pq.read_table(path, filesystem=system, partitioning=None).combine_chunks()
        rows = table.column("vector").combine_chunks()
        return dense_rows(rows, len(rows[0]) if len(rows) else 0).T, table.column(label.name).combine_chunks()

    return _top_rows(df, load, 0, n, id_col, keep, vector, label)


def _top_rows(
    df: DataFrame,
    load: Callable[[], tuple[np.ndarray | None, pa.Array | None]],
    width: int,
    n: int,
    id_col: str,
    keep: list[str],
    vector: str | None,
    label: T.StructField | None = None,
) -> DataFrame:
    """``load`` gives the directions, as columns of a matrix, and their labels; without a matrix the ``width`` columns of the
    rows are the scores, without labels directions are numbered."""
    inputs = [vector] if vector else ["ids", "weights"]
    name = label.name if label else "direction"
    schema = T.StructType(
        [
            T.StructField(name, label.dataType if label else T.IntegerType()),
            T.StructField("score", T.DoubleType()),
            *[df.schema[c] for c in keep],
        ]
    )
    order = [("score", "descending"), (id_col, "descending")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, labels = load()
        limit = 8 * n * (width if m is None else m.shape[1]) + 1024
        best: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0 or (labels is not None and not len(labels)):
                continue
            batch = batch.take(pc.sort_indices(batch.column(id_col), sort_keys=[("", "descending")]))
            if m is None:
                scores = dense_rows(batch.column(vector), width)
            elif vector:
                scores = dense_rows(batch.column(vector), m.shape[0]) @ m
            else:
                scores = sparse_product(batch.column("ids"), batch.column("weights"), m)
            scores = leading_digits(scores)
            rows, directions = _batch_best(scores, n)
            picked = batch.select(keep).take(pa.array(rows))
            found = pa.Table.from_arrays(
                [pa.array(directions), pa.array(scores[rows, directions]), *picked.columns],
                ["direction", "score", *keep],
            )
            best = found if best is None else pa.concat_tables([best, found])
            if best.num_rows > limit:
                best = best_rows(best, n, "direction", order)
        if best is not None:
            table = best_rows(best, n, "direction", order).combine_chunks()
            if labels is not None:
                named = labels.take(table.column("direction").combine_chunks())
                table = table.set_column(0, name, named)
            yield from table.to_batches()

    found = df.select(*dict.fromkeys([id_col, *keep, *inputs])).mapInArrow(run, schema)
    place = Window.partitionBy(name).orderBy(F.desc("score"), F.desc(id_col))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= n)
