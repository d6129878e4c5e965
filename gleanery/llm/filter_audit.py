"""How five document filters interact, from a sparse document-term matrix.

Documents are packed into shards of about ``SHARD_BYTES`` of text. A shard holds its cells (document, word, count) over a
dictionary of its own words; the words of all shards are numbered once for the whole corpus (``numbered``), and
with these columns every shard is a block of rows of one document-term matrix in CSR form (``matrix``). Its row sums are the
words of a document and its nonzero counts the distinct ones, which decide filters A and B; the other flags are
attached to the rows, equal documents are folded, and what remains is one count per part and set
of failed filters, from which every order of the filters follows.

What moves: the different words of each shard once, never a row per word of the texts; then their numbers and the cells, as
compressed blobs. A frequent word has one row per shard, a text with many copies one row per task and label.

Filters: A under 100 words, B ``100 * distinct < 80 * words``, C ``100 * [A-Z] > 10 * code points``, D any of
``#$%&*|``, E identical to the text of a smaller doc_id.

Defined results: null text is an empty text (and equal to one); a null part is the empty string; a row without doc_id is
no copy and nobody's original; rows that share doc_id and text are no copies of each other; a label row of 1 among several counts;
an empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.alignment import pack, unpack
from gleanery.llm.scan import SPACE, Words, pieces, text_column
from gleanery.llm.stage import written
from gleanery.llm.textstats import first_marks

#: Text bytes of a shard: its words are held by one task while it is packed.
SHARD_BYTES = 16 << 20
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 100, 80, 10
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_MARKS = np.isin(np.arange(256), list(b"#$%&*|"))

#: Words that a task numbers before it sends them on.
NUMBERED = 1 << 20
#: Shards of one partition, and words of one, that a number has room for.
SHARD_BITS, WORD_BITS = 24, 38

SHARD = "shard long, doc_id array<long>, part array<string>, digest array<binary>, failed array<int>, width long, cells binary, words array<string>"


def _words(w: Words) -> pa.Array:
    """The words of a batch in order, as an Arrow column."""
    ends = np.r_[0, np.cumsum(w.end - w.start)]
    inside = w.data[~SPACE[w.data]]
    return pa.LargeStringArray.from_buffers(len(w), pa.py_buffer(ends.tobytes()), pa.py_buffer(inside.tobytes()))


class _Shard:
    """Documents that are packed together."""

    def __init__(self):
        self.size, self.rows, self.words, self.docs = 0, [], [], []

    def add(self, piece: pa.RecordBatch) -> None:
        column = text_column(piece)
        w = Words(column, SPACE)
        upper, marks = w.bytes_per_doc(_UPPER[w.data]), w.bytes_per_doc(_MARKS[w.data])
        points = w.bytes_per_doc(first_marks(w))
        failed = 4 * (100 * upper > MAX_UPPER * points) + 8 * (marks > 0)
        data, bounds = w.data.tobytes(), w.doc_bytes
        digests = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]
        base = sum(len(r[0]) for r in self.rows)
        self.rows.append((piece.column("doc_id"), piece.column("part"), digests, failed))
        self.words.append(_words(w))
        self.docs.append(w.doc + base)
        self.size += len(data)

    def batch(self, number: int) -> pa.RecordBatch:
        ids, parts, digests, failed = zip(*self.rows)
        coded = pa.chunked_array(self.words, pa.large_string()).combine_chunks().dictionary_encode()
        width = max(1, len(coded.dictionary))
        cells = np.concatenate(self.docs) * np.int64(width) + coded.indices.to_numpy()
        cells, counts = np.unique(cells, return_counts=True)
        whole = [
            pa.concat_arrays(ids), pa.concat_arrays([p.cast(pa.string()) for p in parts]),
            pa.array([d for ds in digests for d in ds], pa.binary()), pa.array(np.concatenate(failed).astype(np.int32)),
            coded.dictionary.cast(pa.string()),
        ]
        ids, parts, digests, failed, words = (pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in whole)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), ids, parts, digests, failed, pa.array([width]), pa.array([pack(cells, counts)]), words],
            ["shard", "doc_id", "part", "digest", "failed", "width", "cells", "words"],
        )


def packed(docs: DataFrame, part: Column, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its documents with the flags of C (4) and D (8), its cells (document * width + word of the shard,
    with their counts, as ``pack`` writes them) and its words."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )

    def pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = _Shard(), TaskContext.get().partitionId() << SHARD_BITS
        for piece in pieces(batches):
            shard.add(piece)
            if shard.size >= shard_bytes:
                yield shard.batch(number)
                shard, number = _Shard(), number + 1
        if shard.rows:
            yield shard.batch(number)

    return given.mapInArrow(pack_shards, SHARD)


def numbered(shards: DataFrame) -> DataFrame:
    """The global dictionary by shard: rows (shard, at, column) with ``at`` words of the shard and their columns in the whole matrix, as arrays of
    bytes. Equal words of all shards meet in order and take one number."""
    words = shards.select("shard", F.posexplode("words").alias("at", "word"))
    ordered = words.repartition("word").sortWithinPartitions("word")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, column = None, (TaskContext.get().partitionId() << WORD_BITS) - 1
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column("word")
            new = np.ones(len(word), bool)
            new[1:] = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
            new[0] = word[0].as_py() != last
            columns = column + np.cumsum(new)
            last, column = word[len(word) - 1].as_py(), int(columns[-1])
            held.append((batch.column("shard").to_numpy(), batch.column("at").to_numpy(), columns))
            size += len(word)
            if size >= NUMBERED:
                yield by_shard(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield by_shard(*map(np.concatenate, zip(*held)))

    return ordered.mapInArrow(number, "shard long, at binary, column binary")


def by_shard(shard: np.ndarray, at: np.ndarray, column: np.ndarray) -> pa.RecordBatch:
    """One row per shard of the words of a task."""
    order = np.argsort(shard, kind="stable")
    shard, at, column = shard[order], at[order].astype("<i4"), column[order].astype("<i8")
    names, first = np.unique(shard, return_index=True)
    bounds = np.r_[first, len(shard)]
    parts = [[x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])] for x in (at, column)]
    return pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(p, pa.binary()) for p in parts]], ["shard", "at", "column"])


def csr(shard: pa.Table, words: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, columns of the whole matrix, counts) of the rows of one shard."""
    width = shard.column("width")[0].as_py()
    known = np.full(width, -1, np.int64)
    for at, column in zip(words.column("at").to_pylist(), words.column("column").to_pylist()):
        known[np.frombuffer(at, "<i4")] = np.frombuffer(column, "<i8")
    cells, counts = unpack(shard.column("cells")[0].as_py())
    rows = len(shard.column("doc_id")[0])
    return np.searchsorted(cells, np.arange(rows + 1) * width), known[cells % width], counts


def matrix(shards: DataFrame, words: DataFrame) -> DataFrame:
    """shard, doc_id, starts, columns and counts: the document-term matrix, a block of rows in each row."""

    def block(shard: pa.Table, known: pa.Table) -> pa.Table:
        arrays = [pa.array([x], pa.list_(pa.int64())) for x in csr(shard, known)]
        return pa.table([shard.column("shard"), shard.column("doc_id"), *arrays], ["shard", "doc_id", "starts", "columns", "counts"])

    both = shards.drop("words").groupBy("shard").cogroup(words.groupBy("shard"))
    return both.applyInArrow(block, "shard long, doc_id array<long>, starts array<long>, columns array<long>, counts array<long>")


FLAGS = "doc_id long, part string, digest binary, n_words long, n_distinct long, failed int"


def document_flags(shards: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, part, digest, n_words, n_distinct and failed (bits A 1, B 2, C 4, D 8) of each row of the matrix."""

    def judge(shard: pa.Table, known: pa.Table) -> pa.Table:
        starts, columns, counts = csr(shard, known)
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        sums = np.r_[0, np.cumsum(counts)]
        total, distinct = np.diff(sums[starts]), np.bincount(row[columns >= 0], minlength=len(starts) - 1)
        of = {n: shard.column(n).combine_chunks().flatten() for n in ("doc_id", "part", "digest", "failed")}
        failed = of["failed"].to_numpy() + (total < MIN_WORDS) + 2 * (100 * distinct < MIN_DISTINCT * total)
        return pa.table(
            [of["doc_id"], of["part"], of["digest"], pa.array(total), pa.array(distinct), pa.array(failed.astype(np.int32))],
            ["doc_id", "part", "digest", "n_words", "n_distinct", "failed"],
        )

    both = shards.drop("words").groupBy("shard").cogroup(words.groupBy("shard"))
    return both.applyInArrow(judge, FLAGS)


def with_copies(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (with bit E 16), n, good and toxic: documents by part and failed filters.

    Copies are counted before they meet: per text, part and label only their number, the smallest doc_id and how
    many rows have it go on, so no group of copies reaches a task as rows.
    """
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    counted = flags.groupBy("doc_id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    labelled = counted.join(said, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    alike = labelled.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unnamed"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    originals = F.col("n_unnamed") + F.when(F.col("first") == least, F.col("n_first")).otherwise(0)
    split = alike.withColumn("originals", originals).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("failed"), F.col("originals").alias("n")),
            F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - F.col("originals")).alias("n")),
        )).alias("x"),
    )
    n = F.col("x.n")
    return split.groupBy("part", F.col("x.failed").alias("failed")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")
    ).where("n > 0")


def steps(filters: str = FILTERS) -> Column:
    """Every step of every order: filter_order, step, the bit of its filter and those of the filters before."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << filters.index(name)
            out.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before")))
            before |= bit
    return F.array(*out)


def interactions(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the audit's counts of every part, from documents by part and failed filters."""
    wide = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))  # at most 32
    rows = wide.select("part", "sets", F.explode(steps()).alias("s")).select("part", "sets", "s.*")

    def total(value: str, where) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda t, x: t + F.when(where(x["failed"]), x[value]).otherwise(0))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda f: f.bitwiseAND(bit) != 0
    gone = lambda f: f.bitwiseAND(before) != 0
    here = lambda f: fails(f) & ~gone(f)
    counted = rows.select(
        "part", "filter_order", "step", "bit",
        total("n", lambda f: ~fails(f) & ~gone(f)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda f: fails(f) & gone(f)).alias("redundant"),
        total("n", lambda f: f == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per part, order of the five filters and step; see the module."""
    shards = written(packed(docs, F.col(f"`{part}`"), shard_bytes), "csr")
    return interactions(written(with_copies(document_flags(shards, numbered(shards)), labels), "audit"))
