"""Token lists as codes of small dictionaries, so that a table about tokens meets each token once per shard of documents.

A shard is a run of documents of about ``SHARD_TOKENS`` tokens with the list of its different tokens. What is to be done to tokens
is done to these lists by plain joins (a frequent token has one row per shard, so no key is hot), and the documents
take the outcome back by their shard. Order and repetition of the tokens stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.session import staged

SHARD_TOKENS = 1 << 20
#: Shards that a partition's numbers have room for.
SHARD_BITS = 30


@dataclass
class CodedTokens:
    """``docs`` (_shard, ..., _codes: places in the shard's list) and ``words`` (_of: the shard, _at, token)."""

    docs: DataFrame
    words: DataFrame


def code_tokens(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> CodedTokens:
    """Documents with a ``tokens`` list in coded form, staged: whatever made the tokens runs once."""
    carried = [c for c in docs.columns if c != "tokens"]
    fields = [docs.schema[c] for c in carried]
    schema = T.StructType([
        T.StructField("_shard", T.LongType()), *[T.StructField(f.name, f.dataType) for f in fields],
        T.StructField("_codes", T.ArrayType(T.IntegerType())), T.StructField("_words", T.ArrayType(T.StringType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << SHARD_BITS, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column("tokens").flatten())
            if size >= shard_tokens:
                yield from _coded(held, carried, number)
                number, held, size = number + 1, [], 0
        if held:
            yield from _coded(held, carried, number)

    rows = staged(docs.select(*carried, "tokens").mapInArrow(run, schema))
    words = rows.where("_words IS NOT NULL").select(F.col("_shard").alias("_of"), F.posexplode("_words").alias("_at", "token"))
    return CodedTokens(rows.where("_codes IS NOT NULL").drop("_words"), words)


def _coded(batches: list[pa.RecordBatch], carried: list[str], number: int) -> Iterator[pa.RecordBatch]:
    """The documents of a shard and, as the last row, its list."""
    table = pa.Table.from_batches(batches).combine_chunks()
    lists = table.column("tokens").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    filled = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.r_[0, np.cumsum(filled)], pa.int32())
    codes = pa.ListArray.from_arrays(ends, coded.indices)
    names = ["_shard", *carried, "_codes", "_words"]
    n = len(table)
    words = coded.dictionary
    for columns in (
        [pa.array([number] * n, pa.int64()), *[table.column(c).combine_chunks() for c in carried], codes, pa.nulls(n, pa.list_(words.type))],
        [
            pa.array([number], pa.int64()), *[pa.nulls(1, table.schema.field(c).type) for c in carried],
            pa.nulls(1, codes.type), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
        ],
    ):
        yield pa.RecordBatch.from_arrays(columns, names)


def decode_tokens(coded: CodedTokens, words: DataFrame) -> DataFrame:
    """The documents with ``tokens`` as ``words`` (_of: the shard, _at, token) has them; a place that it lacks is left out."""
    carried = [c for c in coded.docs.columns if c not in ("_shard", "_codes")]
    schema = T.StructType([*(coded.docs.schema[c] for c in carried), T.StructField("tokens", T.ArrayType(T.StringType()))])

    def join(docs: pa.Table, words: pa.Table) -> pa.Table:
        codes = docs.column("_codes").combine_chunks()
        flat = codes.flatten().to_numpy(zero_copy_only=False)
        at = words.column("_at").to_numpy()
        place = np.full(max(flat.max(initial=-1), at.max(initial=-1)) + 1, -1, np.int64)
        place[at] = np.arange(len(at))
        found = place[flat]
        kept = np.r_[0, np.cumsum(found >= 0)]
        ends = kept[np.r_[0, np.cumsum(codes.value_lengths().to_numpy(zero_copy_only=False))]]
        tokens = words.column("token").combine_chunks().take(pa.array(found[found >= 0]))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens)
        return pa.table([*[docs.column(c) for c in carried], lists], [*carried, "tokens"])

    return coded.docs.groupBy("_shard").cogroup(words.groupBy("_of")).applyInArrow(join, schema)
