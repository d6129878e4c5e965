"""Benchmark decontamination: hash set of test n-grams, scan of training windows, exact check.

The benchmark is cut into blocks of at most ``block_bytes`` text bytes (its size is read first).
Each block becomes sorted window hashes plus its normalised words and is broadcast; documents flow
through one ``mapInArrow`` per block, ``STAGED_BLOCKS`` of them in a stage; then what was found is staged
and their broadcasts are released. So nothing is shuffled, and driver and executors hold the tables of
``STAGED_BLOCKS`` blocks at most, however large the benchmark is.

Words are runs of 0-9, a-z (after lower-casing A-Z) and non-ASCII characters. A window is
``width`` consecutive words of an item; an item with fewer words, but not none, is one window.

Defined results: null or empty text has no words and no hits; null or empty items have no windows;
a null item id marks words but is not listed; repeated items count once, repeated documents each
give a row; an empty benchmark hits nothing; input columns named like a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.scan import NOT_ALNUM, Words, pieces, text_buffers, text_column
from gleanery.llm.stage import written

WIDTH = 10
#: Benchmark text per broadcast; the arrays made of it take about 15 times as much.
BLOCK_BYTES = 4 << 20
#: Blocks, each in a Python worker of its own, that one stage scans for.
STAGED_BLOCKS = 4

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def window_table(ids: list, texts: pa.Array, width: int) -> dict:
    """The windows of some items, as plain values that can be broadcast: ``by_width`` has sorted
    hashes and start words per width, ``words`` the item words for the exact check."""
    words = Words(texts, NOT_ALNUM, lower=True)
    hashes = words.hashes()
    starts = {width: words.whole(width)}
    for item in np.flatnonzero((words.counts > 0) & (words.counts < width)):
        size = int(words.counts[item])
        starts[size] = np.append(starts.get(size, np.zeros(0, np.int64)), words.first[item])
    by_width = {}
    for size, at in starts.items():
        if len(at):
            keys = words.windows(hashes, size)[at]
            order = np.argsort(keys, kind="stable")
            by_width[size] = (keys[order], at[order])
    text = [words.data[s:e].tobytes() for s, e in zip(words.start, words.end)]
    return {"ids": ids, "doc": words.doc, "words": text, "by_width": by_width}


def window_hits(table: dict, words: Words) -> Iterator[tuple[int, int, frozenset]]:
    """(start word, width, item ids) of every window of ``words`` that the items have."""
    hashes = words.hashes()
    known: dict[tuple, frozenset | None] = {}
    for size, (keys, at) in table["by_width"].items():
        starts = words.whole(size)
        found = words.windows(hashes, size)[starts]
        low = np.searchsorted(keys, found)
        match = keys[np.minimum(low, len(keys) - 1)] == found
        for start, first in zip(starts[match].tolist(), low[match].tolist()):
            span = range(start, start + size)
            text = tuple(words.data[words.start[i] : words.end[i]].tobytes() for i in span)
            if text not in known:
                last = int(np.searchsorted(keys, keys[first], "right"))
                same = [i for i in at[first:last].tolist() if tuple(table["words"][i : i + size]) == text]
                known[text] = frozenset(table["ids"][table["doc"][i]] for i in same) if same else None
            if known[text] is not None:
                yield start, size, known[text]


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[int, Iterator[pa.Table]]:
    """Number of blocks, and these one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Half-full blocks on average, so that an uneven share still fits.
    count = max(1, math.ceil(2 * total / block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return count, (items.where(block == k).toArrow() for k in range(count))


def _cut(column: pa.Array, words: Words, hit: np.ndarray) -> pa.Array:
    """The texts without the bytes from the first to the last word of each hit run."""
    data, bounds = text_buffers(column)
    edge = np.zeros(len(data) + 1, np.int32)
    hit_words = np.flatnonzero(hit)
    np.add.at(edge, words.start[hit_words], 1)
    joined = np.zeros(len(hit_words), bool)
    joined[:-1] = (np.diff(hit_words) == 1) & (np.diff(words.doc[hit_words]) == 0)
    stop = words.end[hit_words].copy()
    stop[joined] = words.start[hit_words[1:]][joined[:-1]]
    np.add.at(edge, stop, -1)
    keep = np.cumsum(edge[:-1]) == 0
    sums = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)
    out = pa.LargeStringArray.from_buffers(
        len(column), pa.py_buffer(sums[bounds].tobytes()), pa.py_buffer(data[keep].tobytes())
    ).cast(pa.string())
    return pc.if_else(column.is_valid(), out, pa.scalar(None, pa.string()))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
    cut: bool = False,
) -> DataFrame:
    """``docs`` (with ``text``) plus n_words, n_hit, items (ids as strings, sorted) and spans
    ([start, end) word ranges that hit). With ``cut`` the text has those ranges removed."""
    plain = docs.drop(*FOUND.fieldNames())
    schema = T.StructType(plain.schema.fields + FOUND.fields)
    context = docs.sparkSession.sparkContext
    out, sent = plain, []
    count, blocks = _blocks(benchmark, block_bytes)
    for k, block in enumerate(blocks):
        if len(sent) == STAGED_BLOCKS:
            out = written(out, "scanned")
            while sent:
                sent.pop().destroy()
        sent.append(context.broadcast(window_table(block["item_id"].to_pylist(), block["text"].combine_chunks(), width)))
        out = out.mapInArrow(_scanner(sent[-1], k == 0, cut and k == count - 1), schema)
    return out


def _scanner(block, first: bool, cut: bool):
    def scanner(batches):
        for piece in pieces(batches):
            column = text_column(piece)
            words = Words(column, NOT_ALNUM, lower=True)
            hit = np.zeros(len(words), bool)
            items: list[set] = [set() for _ in range(words.n_docs)]
            old = piece.num_columns
            if not first:
                old -= len(FOUND.fields)
                for d, ids in enumerate(piece.column(old + 2).to_pylist()):
                    items[d].update(ids)
                for d, spans in enumerate(piece.column(old + 3).to_pylist()):
                    for s, e in spans:
                        hit[words.first[d] + s : words.first[d] + e] = True
            for start, size, ids in window_hits(block.value, words):
                hit[start : start + size] = True
                items[words.doc[start]].update(x for x in ids if x is not None)
            columns = piece.columns[:old]
            if cut and hit.any():
                columns[piece.schema.get_field_index("text")] = _cut(column, words, hit)
            spans = []
            for d in range(words.n_docs):
                mask = hit[words.first[d] : words.first[d + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]))) if mask.any() else []
                spans.append([[int(s), int(e)] for s, e in zip(edges[::2], edges[1::2])])
            found = [
                pa.array(words.counts, pa.int64()),
                pa.array(words.per_doc(hit), pa.int64()),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.list_(pa.int32()))),
            ]
            names = piece.schema.names[:old] + FOUND.fieldNames()
            yield pa.RecordBatch.from_arrays(columns + found, names)

    return scanner


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or with the benchmark passages cut out
    (``remove="spans"``; what is left of the text keeps its characters)."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is {remove!r}")
    if remove == "spans":
        return scan(docs, benchmark, cut=True).select(*docs.columns)
    return scan(docs, benchmark).where("n_hit = 0").select(*docs.columns)
