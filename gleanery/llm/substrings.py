"""Substring dedup: Rabin-Karp hashes of every window of ``width`` words, counted in Spark.

A word goes if a window covers it whose word sequence also starts earlier (smaller doc_id, or same
document and earlier start). Documents are dealt once to pieces of about ``PIECE`` text bytes by a hash;
that one exchange serves the three passes over the texts:

1. count: each piece sends its distinct window hashes, cut to 32 bits, to the bucket of the hash. A bucket
   answers each piece with the hashes that another piece has, too. Within a piece the hashes are
   distinct, so a passage that a third of all documents share is one value per piece, not one per document.
2. place: windows whose short hash repeats (in the piece or elsewhere) are few. A piece sends the
   first doc_id of each, under two independent hashes (64 bits each; the first without the bits the
   bucket tells); a bucket answers the pieces that have a hash but not its earliest document.
3. cut: all places but the earliest are marked, overlapping windows merge into maximal intervals.

Windows equal in both hashes count as equal. The buckets' work is sorted arrays in numpy, so the
rows that move are blocks, not windows. Pieces and buckets sort all that they hold once; nothing is looked
up for one message at a time, which would cost a bucket its size for each piece of the corpus.

Defined results: null or empty text has no words, loses none and keeps the empty text; a null doc_id comes after
all others; which of several rows with one doc_id is earlier is fixed, but not by a stated rule; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.scan import BASES, SPACE, Words, pieces

WIDTH = 20
#: Text bytes of a piece, and hash bytes of a bucket.
PIECE = 8 << 20
BUCKET = 8 << 20
#: Bytes of a window hash in the first pass, besides the bucket. A bucket holds some 2 million hashes at any size
#: of the corpus, so one window in 2000 is sent to the second pass in vain.
SHORT = 4

_LAST = np.iinfo(np.int64).max
_U = np.uint64
_MASK = _U((1 << 8 * SHORT) - 1)

MESSAGE = "piece int, bucket int, data binary"
RESULT = "doc_id long, n_words long, n_removed long, spans array<array<int>>, kept_text string"


def _short(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def _long(data: pa.Buffer) -> np.ndarray:
    return np.frombuffer(data, "<u4")


class _Piece:
    """The documents of one piece in order, with both hashes of all their windows."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])  # nulls last
        self.number = table["piece"][0].as_py() if table.num_rows else -1
        self.parts, keys, docs = [], [], []
        for part in pieces(table.select(["doc_id", "text"]).combine_chunks().to_batches()):
            words = Words(part.column(1), SPACE)
            starts = words.whole(width)
            hashes = words.hashes()
            keys.append([words.windows(hashes, width, base)[starts] for base in BASES])
            docs.append(part.column(0).fill_null(_LAST).to_numpy()[words.doc[starts]])
            self.parts.append((part.column(0), words, starts))
        self.a, self.b = (np.concatenate([k[i] for k in keys]) if keys else np.zeros(0, _U) for i in (0, 1))
        #: doc_id of each window
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        #: What the bucket sees of the first hash of each window.
        self.tag = _tag(self.a & _MASK, _bucket(self.a, buckets))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(40)) % _U(buckets)).astype(np.int64)


def _packed(piece: np.ndarray | list, bucket: np.ndarray | list, data: list[bytes]) -> pa.Table:
    columns = [pa.array(piece, pa.int32()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())]
    return pa.table(columns, names=["piece", "bucket", "data"])


def _by_bucket(piece: int, bucket: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """One message for each bucket with its part of the columns, one after the other; ``bucket`` ascends."""
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
    data = [b"".join(c[s:e].tobytes() for c in columns) for s, e in zip(cuts, cuts[1:])]
    return _packed([piece] * len(data), bucket[cuts[:-1]], data)


def _buffers(messages: pa.Table) -> list[pa.Buffer]:
    return [x.as_buffer() for x in messages["data"].combine_chunks()]


def _runs(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``at`` ordered by the second hash so that equal windows stand together, and where each
    run of equal windows begins."""
    at = at[np.argsort(b[at])]
    first, second = a[at], b[at]
    same = second[1:] == second[:-1]
    if (same & (first[1:] != first[:-1])).any():  # equal in the second hash only
        at = at[np.lexsort((first, second))]
        first, second = a[at], b[at]
        same = second[1:] == second[:-1]
    same &= first[1:] == first[:-1]
    return at, np.flatnonzero(np.concatenate([[True], ~same])[: len(at)])


def _counter(width: int, buckets: int):
    def count(table: pa.Table) -> pa.Table:
        piece = _Piece(table, width, buckets)
        tags = np.sort(piece.tag)
        # Sorting finds distinct values in a tenth of the time of the hash table behind np.unique.
        tags = tags[np.concatenate([[True], tags[1:] != tags[:-1]])[: len(tags)]]
        return _by_bucket(piece.number, tags >> _U(8 * SHORT), (tags & _MASK).astype("<u4"))

    return count


def _answer(table: pa.Table) -> pa.Table:
    """To each piece of a bucket, those of its hashes that another piece sent, too."""
    sent = [_long(x) for x in _buffers(table)]  # each distinct
    every = np.concatenate(sent)
    placed = np.sort((every.astype(np.uint64) << _U(32)) | np.arange(len(every), dtype=np.uint64))
    same = placed[1:] >> _U(32) == placed[:-1] >> _U(32)
    several = np.zeros(len(every), bool)
    several[placed[1:][same] & _U(0xFFFFFFFF)] = True
    several[placed[:-1][same] & _U(0xFFFFFFFF)] = True
    ends = np.cumsum([len(v) for v in sent])
    found = zip(table["piece"].to_pylist(), sent, np.split(several, ends[:-1]))
    answers = [(p, _short(v[mask])) for p, v, mask in found if mask.any()]
    bucket = table["bucket"][0].as_py()
    return _packed([p for p, _ in answers], [bucket] * len(answers), [d for _, d in answers])


def _tag(short: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Short hash and bucket as one value."""
    return short.astype(np.uint64) | (bucket.astype(np.uint64) << _U(8 * SHORT))


def _placer(width: int, buckets: int):
    def place(docs: pa.Table, answers: pa.Table) -> pa.Table:
        piece = _Piece(docs, width, buckets)
        order = np.argsort(piece.tag)
        ranked = piece.tag[order]
        same = ranked[1:] == ranked[:-1]
        several = np.zeros(len(order), bool)
        several[1:] = same
        several[:-1] |= same
        elsewhere = [
            _tag(_long(d), np.full(len(d) // SHORT, b))
            for b, d in zip(answers["bucket"].to_pylist(), _buffers(answers))
        ]
        if elsewhere:
            places, _ = _matches(ranked, np.sort(np.concatenate(elsewhere)))
            several[places] = True
        at, starts = _runs(piece.a, piece.b, order[several])
        # Windows are in order of doc_id, so the first of equal ones is the earliest.
        first = np.sort(np.minimum.reduceat(at, starts)) if len(at) else at
        # Ascending documents in a message compress well.
        first = first[np.argsort(piece.tag[first] >> _U(8 * SHORT), kind="stable")]
        tag = piece.tag[first]
        return _by_bucket(
            piece.number, tag >> _U(8 * SHORT), (tag & _MASK).astype("<u4"), piece.b[first], piece.doc[first]
        )

    return place


def _matches(ranked: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``ranked`` that hold a value of ``wanted`` and the place of that value; both ascend."""
    low = np.searchsorted(ranked, wanted, "left")
    counts = np.searchsorted(ranked, wanted, "right") - low
    which = np.repeat(np.arange(len(wanted)), counts)
    return np.arange(len(which)) + (low - np.cumsum(counts) + counts)[which], which


def _losers(table: pa.Table) -> pa.Table:
    """To each piece of a bucket, the hashes of which another piece has an earlier document (of equal
    doc_ids, the lower piece)."""
    table = table.sort_by("piece")
    a, b, doc, sizes = [], [], [], []
    for data in _buffers(table):
        n = len(data) // (SHORT + 16)
        a.append(_long(data.slice(0, SHORT * n)))
        b.append(np.frombuffer(data, np.uint64, n, SHORT * n))
        doc.append(np.frombuffer(data, np.int64, n, (SHORT + 8) * n))
        sizes.append(n)
    a, b, doc = np.concatenate(a), np.concatenate(b), np.concatenate(doc)
    at, starts = _runs(a, b, np.arange(len(a)))
    least = np.minimum.reduceat(doc[at], starts)
    least = np.repeat(least, np.diff(np.append(starts, len(at))))
    # Places ascend by piece.
    winner = np.minimum.reduceat(np.where(doc[at] == least, at, len(at)), starts)
    lost = np.ones(len(a), bool)
    lost[winner] = False
    answers, end = [], 0
    for p, n in zip(table["piece"].to_pylist(), sizes):
        start, end = end, end + n
        mask = lost[start:end]
        if mask.any():
            answers.append((p, _short(a[start:end][mask]) + b[start:end][mask].tobytes()))
    bucket = table["bucket"][0].as_py()
    return _packed([p for p, _ in answers], [bucket] * len(answers), [d for _, d in answers])


def _cutter(width: int, buckets: int):
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        piece = _Piece(docs, width, buckets)
        at, starts = _runs(piece.a, piece.b, np.arange(len(piece.a)))
        # All but the first of the equal windows in the piece.
        earlier = np.ones(len(at), bool)
        if len(at):
            earlier[np.minimum.reduceat(at, starts)] = False
        tags, seconds = [], []
        for bucket, data in zip(answers["bucket"].to_pylist(), _buffers(answers)):
            n = len(data) // (SHORT + 8)
            tags.append(_tag(_long(data.slice(0, SHORT * n)), np.full(n, bucket)))
            seconds.append(np.frombuffer(data, np.uint64, n, SHORT * n))
        if tags:
            tags, seconds = np.concatenate(tags), np.concatenate(seconds)
            order = np.argsort(seconds)
            places, which = _matches(piece.b[at], seconds[order])
            places = at[places]
            earlier[places[piece.tag[places] == tags[order][which]]] = True
        tables, done = [], 0
        for doc_ids, words, starts in piece.parts:
            mask = earlier[done : done + len(starts)]
            done += len(starts)
            tables.append(_result(doc_ids, words, words.covered(starts[mask], width)))
        return pa.concat_tables(tables) if tables else _SCHEMA.empty_table()

    return cut


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int32()))),
        ("kept_text", pa.string()),
    ]
)


def _result(doc_ids: pa.Array, words: Words, gone: np.ndarray) -> pa.Table:
    edge = np.diff(np.concatenate([[False], gone]).astype(np.int8))
    begins = gone & ((edge == 1) | _opens(words))
    spans: list[list] = [[] for _ in range(words.n_docs)]
    if gone.any():
        closes = np.append(begins[1:] | ~gone[1:], True) & gone
        for s, e in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(closes).tolist()):
            d = words.doc[s]
            spans[d].append([s - int(words.first[d]), e + 1 - int(words.first[d])])
    return pa.Table.from_arrays(
        [
            doc_ids,
            pa.array(words.counts, pa.int64()),
            pa.array(words.per_doc(gone), pa.int64()),
            pa.array(spans, pa.list_(pa.list_(pa.int32()))),
            pc.cast(words.join(~gone), pa.string()),
        ],
        schema=_SCHEMA,
    )


def _opens(words: Words) -> np.ndarray:
    out = np.zeros(len(words) + 1, bool)
    out[words.first[:-1]] = True
    return out[:-1]


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed [start, end) word ranges) and kept_text (kept words
    joined by one space) of each document; ``docs`` has doc_id (an integer) and text."""
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_pieces = max(parts, math.ceil(size / PIECE))
    # A word and its gap are three bytes or more on average in any text worth the name.
    n_buckets = max(parts, math.ceil(size / 3 * SHORT / BUCKET))
    piece = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_pieces)).cast("int").alias("piece")
    dealt = given.select(piece, "doc_id", "text").repartition(n_pieces, "piece")

    def by(messages: DataFrame, column: str, n: int):
        return messages.repartition(n, column).groupBy(column)

    counts = dealt.groupBy("piece").applyInArrow(_counter(width, n_buckets), MESSAGE)
    elsewhere = by(counts, "bucket", n_buckets).applyInArrow(_answer, MESSAGE)
    places = dealt.groupBy("piece").cogroup(by(elsewhere, "piece", n_pieces)).applyInArrow(_placer(width, n_buckets), MESSAGE)
    lost = by(places, "bucket", n_buckets).applyInArrow(_losers, MESSAGE)
    return dealt.groupBy("piece").cogroup(by(lost, "piece", n_pieces)).applyInArrow(_cutter(width, n_buckets), RESULT)
