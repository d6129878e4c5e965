"""Alignment of two tokenizers: groups of tokens between common byte offsets, and links between overlapping tokens.

A document's two token streams tile the same bytes. Where tokens of both end, the streams are cut; a cut closes a
group. The streams are dealt into chunks by byte range, and each chunk becomes a ``Fragment``: an open prefix
(tokens before its first cut), closed groups, and an open suffix. Fragments compose associatively: suffix and
prefix join into one more closed group, or a longer open run if a chunk has no cut. A document of one chunk
is finished where it was tokenised; the chunks of longer ones meet in a tree of ``FANIN`` fragments a task,
so that none sees more than these.

A token is never cut and lies in the chunk in which it ends. Corpus-wide counts of linked id pairs are summed in Spark and
written as sorted blocks of ``BLOCK_PAIRS`` pairs to the shared folder, which tasks read there, a block at
a time; the number of pairs is bounded by the vocabularies, not by the corpus.

The tokenizer files are read by the driver and broadcast (a few MB). A byte-level vocabulary whose ids are its merge ranks is
run by ``tiktoken``, any other by ``tokenizers``; results are the same.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte for byte, have no
tokens: counts 0 and an empty ``groups_sha256``. Rows are documents of their own, whatever their doc_id, and equal ones count
each time. Other columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.scan import pieces, text_column
from gleanery.llm.stage import shared_folder, written
from gleanery.llm.warc import open_folder

CHUNK_BYTES = 64 << 10
FANIN = 8
#: Linked id pairs that a task holds at once (17 bytes each).
BLOCK_PAIRS = 4 << 20
#: Links that a task gathers before it counts them.
GATHERED = 4 << 20
#: Blocks that one stage looks up, each in a Python worker of its own.
STAGED_BLOCKS = 4
LONG_BLANK = re.compile(r"\s{2000}")
TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte, as letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A, from the text of its json file."""

    def __init__(self, source: bytes):
        spec = json.loads(source)
        letters = byte_letters()
        vocab = {t: i for t, i in spec["model"]["vocab"].items()}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        self.bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if token not in added:
                self.bytes[i] = bytes(letters[c] for c in token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ranked = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        before = spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if ranked and plain and not spec.get("normalizer"):
            import tiktoken

            # Fixed value: the split of byte-level vocabularies.
            pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
            ranks = {self.bytes[i]: i for t, i in vocab.items() if t not in added}
            encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            # The split takes a step of the stack per blank of a run, so long runs go the other way.
            self.encode = lambda texts: [
                self.merged([t])[0] if LONG_BLANK.search(t) else encoding.encode_ordinary(t) for t in texts
            ]
        else:
            self.encode = self.merged
        self.source, self.tokenizer = source, None

    def merged(self, texts: list[str]) -> list[list[int]]:
        """Ids by the merges of the file itself."""
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.source.decode())
            self.tokenizer.encode_special_tokens = True
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B, from the bytes of its model file."""

    def __init__(self, source: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=source)
        self.bytes: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        self.encode = lambda texts: model.encode(texts, num_threads=1)


@dataclass
class Stream:
    """Tokens and the byte offsets at which they end."""

    ids: np.ndarray
    ends: np.ndarray

    def part(self, mask) -> Stream:
        return Stream(self.ids[mask], self.ends[mask])

    def __add__(self, other: Stream) -> Stream:
        return Stream(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))


def _empty() -> Stream:
    return Stream(np.zeros(0, np.int64), np.zeros(0, np.int64))


def linked(a: Stream, b: Stream, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of all pairs whose byte ranges overlap; both begin at ``start``."""
    begins = np.r_[start, a.ends[:-1]] if len(a.ends) else a.ends
    first = np.searchsorted(b.ends, begins, "right")
    n = np.searchsorted(b.ends, a.ends, "left") - first + 1
    left = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
    return left, np.repeat(first, n) + within


#: Decimal digits of an id and one byte of punctuation.
_WIDTH = 12


def _digits(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Text of every id as a row of bytes, right-aligned before a free last byte, and its length."""
    ids = np.arange(max(1, limit))
    table, length = np.zeros((len(ids), _WIDTH), np.uint8), np.ones(len(ids), np.int64)
    rest = ids.copy()
    for place in range(_WIDTH - 2, -1, -1):
        table[:, place] = 48 + rest % 10
        rest //= 10
        length += rest > 0
    return table, length


class Writer:
    """Text of groups: ``a1,a2|b1;a3|b2,b3`` with a semicolon after each group, so that texts join by concatenation."""

    def __init__(self, limit: int):
        self.table, self.length = _digits(limit)

    def text(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all groups in order, and where each token's text ends, with the tokens sorted by group and side."""
        ids, side = np.concatenate([a, b]), np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)]
        key = 2 * np.concatenate([a_group, b_group]) + side
        order = np.argsort(key, kind="stable")
        ids, key = ids[order], key[order]
        cells = self.table[ids]
        last = np.ones(len(key), bool)
        last[:-1] = key[1:] != key[:-1]
        cells[:, -1] = np.where(last, np.where(key % 2 == 0, ord("|"), ord(";")), ord(","))
        size = self.length[ids] + 1
        keep = np.arange(_WIDTH) >= (_WIDTH - size)[:, None]
        return cells[keep], np.cumsum(size)


def pack(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending codes with their counts as a compressed blob: differences, byte plane by byte plane."""
    deltas = np.diff(codes, prepend=0).astype("<i8")
    planes = np.concatenate([deltas.view(np.uint8).reshape(-1, 8).T.ravel(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()])
    return len(codes).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 12 * n, "zstd", asbytes=True), np.uint8)
    deltas = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view("<i8").ravel()
    return np.cumsum(deltas), np.ascontiguousarray(planes[8 * n :].reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def counted(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, ascending, with the sum of its counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


@dataclass
class Fragment:
    """A run of bytes of one document. ``cut`` tells whether a group begins or ends in it; without one all its tokens are ``prefix``."""

    cut: bool = False
    tail: int = 0  # offset of the last cut
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    text: bytes = b""
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    prefix: tuple[Stream, Stream] = field(default_factory=lambda: (_empty(), _empty()))
    suffix: tuple[Stream, Stream] = field(default_factory=lambda: (_empty(), _empty()))


def compose(left: Fragment, right: Fragment, writer: Writer, width: int) -> Fragment:
    """The fragment of two neighbouring runs of bytes; associative."""
    n_a, n_b = left.n_a + right.n_a, left.n_b + right.n_b
    if not left.cut:
        run = tuple(x + y for x, y in zip(left.prefix, right.prefix))
        return Fragment(right.cut, right.tail, n_a, n_b, right.n_groups, right.text, right.codes, right.counts, run, right.suffix)
    run = tuple(x + y for x, y in zip(left.suffix, right.prefix))
    if not right.cut:
        return Fragment(True, left.tail, n_a, n_b, left.n_groups, left.text, left.codes, left.counts, left.prefix, run)
    a, b = run
    i, j = linked(a, b, left.tail)
    codes, counts = counted(
        np.concatenate([left.codes, a.ids[i] * width + b.ids[j], right.codes]),
        np.concatenate([left.counts, np.ones(len(i), np.int64), right.counts]),
    )
    same = lambda x: np.zeros(len(x.ids), np.int64)
    middle = writer.text(a.ids, same(a), b.ids, same(b))[0].tobytes()
    closed = int(len(a.ids) > 0)
    return Fragment(
        True, right.tail, n_a, n_b, left.n_groups + closed + right.n_groups, left.text + middle + right.text, codes, counts,
        left.prefix, right.suffix,
    )


def fragments(a: list, b: list, sizes: np.ndarray, writer: Writer, width: int, lengths, chunk_bytes: int) -> Iterator[tuple[int, int, int, Fragment]]:
    """(document, chunk, chunks of the document, fragment) of documents given as token lists and sizes in bytes.

    All documents of a batch are aligned together; ``lengths`` has the bytes of every id of both tokenizers.
    """
    flat = [np.concatenate([np.asarray(x, np.int64) for x in side]) if side else np.zeros(0, np.int64) for side in (a, b)]
    streams = [Stream(ids, np.cumsum(size[ids])) for ids, size in zip(flat, lengths)]
    doc_ends = np.cumsum(sizes)
    doc_starts = doc_ends - sizes
    chunks = -(-sizes // chunk_bytes)
    first_chunk = np.cumsum(chunks) - chunks

    def chunk_of(end: np.ndarray) -> np.ndarray:
        """The chunk in which a token or cut at this offset lies."""
        doc = np.searchsorted(doc_ends, end, "left")
        return first_chunk[doc] + (end - doc_starts[doc] - 1) // chunk_bytes

    sa, sb = streams
    near = np.minimum(np.searchsorted(sb.ends, sa.ends), max(0, len(sb.ends) - 1))
    cuts = sa.ends[sb.ends[near] == sa.ends] if len(sb.ends) else sa.ends[:0]
    begin = np.r_[0, cuts[:-1]] if len(cuts) else cuts
    cut_chunk = chunk_of(cuts)
    # A group that starts a document starts in its first chunk, any other one where the cut before it lies.
    at_start = np.isin(begin, doc_starts)
    begin_chunk = np.where(at_start, first_chunk[np.searchsorted(doc_ends, begin, "right")] if len(cuts) else 0, np.r_[0, cut_chunk[:-1]] if len(cuts) else 0)
    closed = begin_chunk == cut_chunk
    groups = [np.searchsorted(cuts, s.ends, "left") for s in streams]
    homes = [chunk_of(s.ends) for s in streams]
    inside = [closed[g] for g in groups]

    i, j = linked(sa, sb)
    kept = inside[0][i]
    i, j = i[kept], j[kept]
    key, times = np.unique(homes[0][i] * (1 << 40) + sa.ids[i] * width + sb.ids[j], return_counts=True)
    link_bounds = np.searchsorted(key >> 40, np.arange(chunks.sum() + 1))

    ga, gb = groups[0][inside[0]], groups[1][inside[1]]
    text, text_ends = writer.text(sa.ids[inside[0]], ga, sb.ids[inside[1]], gb)
    group_chunk = cut_chunk[np.sort(np.concatenate([ga, gb]))]
    token_bounds = np.searchsorted(group_chunk, np.arange(chunks.sum() + 1))
    text_bounds = np.r_[0, text_ends][token_bounds]
    n_closed = np.bincount(cut_chunk[closed], minlength=chunks.sum())
    n_cuts = np.bincount(cut_chunk, minlength=chunks.sum())
    # The last cut of every chunk; a document's first chunk has one at its start.
    tails = np.zeros(chunks.sum(), np.int64)
    np.maximum.at(tails, cut_chunk, cuts)
    home_bounds = [np.searchsorted(h, np.arange(chunks.sum() + 1)) for h in homes]
    docs = np.repeat(np.arange(len(sizes)), chunks)
    for c, doc in enumerate(docs.tolist()):
        number, base = c - int(first_chunk[doc]), int(doc_starts[doc])
        low, high = int(link_bounds[c]), int(link_bounds[c + 1])
        counts = [int(h[c + 1] - h[c]) for h in home_bounds]
        out = Fragment(
            bool(n_cuts[c]) or number == 0, max(0, int(tails[c]) - base), counts[0], counts[1], int(n_closed[c]),
            text[text_bounds[c] : text_bounds[c + 1]].tobytes(), key[low:high] & ((1 << 40) - 1), times[low:high],
        )
        if chunks[doc] > 1:
            opened, ended = [], []
            for s, g, h in zip(streams, groups, home_bounds):
                tokens = np.arange(h[c], h[c + 1])
                tokens = tokens[~closed[g[tokens]]]
                # Open tokens whose group ends here come before the first cut.
                before = (cut_chunk[g[tokens]] == c) | (begin_chunk[g[tokens]] != c)
                opened.append(Stream(s.ids[tokens[before]], s.ends[tokens[before]] - base))
                ended.append(Stream(s.ids[tokens[~before]], s.ends[tokens[~before]] - base))
            out.prefix, out.suffix = tuple(opened), tuple(ended)
        yield doc, number, int(chunks[doc]), out


_SIDES = ("prefix_a", "prefix_b", "suffix_a", "suffix_b")
ROWS = T.StructType(
    [
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
        T.StructField("chunk", T.LongType()), T.StructField("chunks", T.LongType()),
        T.StructField("cut", T.BooleanType()), T.StructField("tail", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups", T.BinaryType()), T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType()),
        *[T.StructField(f"{s}_{w}", T.ArrayType(T.LongType())) for s in _SIDES for w in ("ids", "ends")],
    ]
)
_ARROW = pa.schema(
    [
        (f.name, pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else
         {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}[f.dataType.simpleString()])
        for f in ROWS.fields
    ]
)


def _record(row: int, doc_id: int | None, chunk: int, chunks: int, f: Fragment) -> dict:
    done = chunks == 1
    sha = hashlib.sha256(f.text[:-1]).hexdigest() if done and f.text else "" if done else None
    out = {
        "row": row, "doc_id": doc_id, "chunk": chunk, "chunks": chunks, "cut": f.cut, "tail": f.tail, "n_a": f.n_a, "n_b": f.n_b,
        "n_groups": f.n_groups, "n_links": int(f.counts.sum()), "groups": None if done else f.text, "groups_sha256": sha,
        "links": pack(f.codes, f.counts),
    }
    for name, stream in zip(_SIDES, (*f.prefix, *f.suffix)):
        out[f"{name}_ids"], out[f"{name}_ends"] = (None, None) if done else (stream.ids, stream.ends)
    return out


def _fragment(r: dict) -> Fragment:
    codes, counts = unpack(r["links"])
    sides = [Stream(np.array(r[f"{s}_ids"], np.int64), np.array(r[f"{s}_ends"], np.int64)) for s in _SIDES]
    return Fragment(r["cut"], r["tail"], r["n_a"], r["n_b"], r["n_groups"], r["groups"], codes, counts, tuple(sides[:2]), tuple(sides[2:]))


def _batch(records: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in records], f.type) for f in _ARROW], schema=_ARROW)


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def chunked(docs: DataFrame, shared, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Every document tokenised by both tokenizers, as rows of fragments: one for a short document, one a chunk otherwise."""
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = ByteLevel(shared.value[0]), Pieces(shared.value[1])
        lengths = [np.array([len(x) for x in t.bytes], np.int64) for t in (first, second)]
        writer, width = Writer(max(map(len, lengths))), len(second.bytes)
        for piece in pieces(batches):
            raw = [x or b"" for x in text_column(piece).cast(pa.binary()).to_pylist()]
            texts = [_text(x) for x in raw]
            a, b = first.encode([" " + t for t in texts]), second.encode(texts)
            for k, text in enumerate(raw):
                whole = b" " + text
                same = text and all(b"".join([t.bytes[i] for i in ids[k]]) == whole for t, ids in ((first, a), (second, b)))
                if not same:
                    a[k], b[k] = [], []
            sizes = np.array([len(x) + 1 if len(y) else 0 for x, y in zip(raw, a)], np.int64)
            rows, ids = piece.column("row").to_pylist(), piece.column("doc_id").to_pylist()
            held = [k for k in range(len(raw)) if sizes[k]]
            records = [_record(rows[k], ids[k], 0, 1, Fragment()) for k in range(len(raw)) if not sizes[k]]
            if held:
                made = fragments([a[k] for k in held], [b[k] for k in held], sizes[held], writer, width, lengths, chunk_bytes)
                records += [_record(rows[held[d]], ids[held[d]], c, n, f) for d, c, n, f in made]
            yield _batch(records)

    return given.mapInArrow(run, ROWS)


def reduced(rows: DataFrame, limit: int, width: int, fanin: int = FANIN) -> DataFrame:
    """One row per document: neighbouring fragments of a document are composed, ``fanin`` in a task, until one is left."""

    def fold(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        writer = Writer(limit)
        whole = reduce(lambda x, y: compose(x, y, writer, width), map(_fragment, found))
        head = found[0]
        return pa.Table.from_batches([_batch([_record(head["row"], head["doc_id"], head["chunk"] // fanin, -(-head["chunks"] // fanin), whole)])])

    done = rows.where("chunks = 1")
    left = rows.agg(F.max("chunks")).first()[0] or 1
    while left > 1:
        groups = rows.where("chunks > 1").groupBy("row", F.floor(F.col("chunk") / fanin).alias("of"))
        rows = written(groups.applyInArrow(fold, ROWS), "fragments")
        done = done.unionByName(rows.where("chunks = 1"))
        left = -(-left // fanin)
    return done


def pair_counts(finished: DataFrame) -> DataFrame:
    """code and n, the corpus-wide number of links of each id pair; tasks count before they send."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, size = [], 0
        for batch in batches:
            for blob in batch.column("links").to_pylist():
                held.append(unpack(blob))
                size += len(held[-1][0])
                if size > GATHERED:
                    held.append((codes, counts))
                    codes, counts = counted(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        codes, counts = counted(*map(np.concatenate, zip(*held, (codes, counts))))
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    return finished.select("links").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def pair_blocks(counts: DataFrame, width: int, folder: str, block_pairs: int = BLOCK_PAIRS) -> int:
    """Write code, n and best (whether no other pair of its B id has more links) as sorted blocks; returns their number."""
    counts = written(counts, "pairs")
    # One row per id of B: bounded by its vocabulary.
    most = F.broadcast(counts.groupBy((F.col("code") % width).alias("b")).agg(F.max("n").alias("most")))
    marked = counts.join(most, F.col("code") % width == F.col("b")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    # Half full on average, so that an uneven share of the hash fits.
    blocks = max(1, -(-2 * counts.count() // block_pairs))
    marked = marked.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
    marked.repartition(blocks, "block").sortWithinPartitions("block", "code").write.partitionBy("block").parquet(folder)
    return blocks


def scored(finished: DataFrame, folder: str, blocks: int) -> DataFrame:
    """``finished`` plus n_best and count_sum; every task reads the blocks from the shared folder."""
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "n_best", "count_sum"]
    rows = finished.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")}).select(*keep)
    schema = rows.schema

    def look_up(block: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, path = open_folder(f"{folder}/block={block}")
            table = pq.read_table(path, filesystem=system, partitioning=None).combine_chunks().sort_by("code")
            codes, n, best = (table.column(c).to_numpy() for c in ("code", "n", "best"))
            for batch in batches:
                blobs = [unpack(x) for x in batch.column("links").to_pylist()]
                sizes = np.array([len(c) for c, _ in blobs], np.int64)
                wanted, times = map(np.concatenate, zip(*blobs))
                at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
                times = np.where(codes[at] == wanted, times, 0)
                sums = [np.r_[0, np.cumsum(times * x[at])] for x in (best, n)]
                ends = np.cumsum(sizes)
                more = [s[ends] - s[ends - sizes] for s in sums]
                columns = [pa.array(batch.column(c).to_numpy() + x) for c, x in zip(("n_best", "count_sum"), more)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], batch.schema.names)

        return run

    system, path = open_folder(folder)
    held = {os.path.basename(f.path) for f in system.get_file_info(pafs.FileSelector(path)) if f.type == pafs.FileType.Directory}
    there = [k for k in range(blocks) if f"block={k}" in held]
    for k, block in enumerate(there, 1):
        rows = rows.mapInArrow(look_up(block), schema)
        if k % STAGED_BLOCKS == 0 and k < len(there):
            rows = written(rows, "scored")
    return rows.drop("links")


def align(
    docs: DataFrame, folder: str = TOKENIZERS, file_a: str = FILE_A, file_b: str = FILE_B,
    chunk_bytes: int = CHUNK_BYTES, fanin: int = FANIN, block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document; see the module."""
    spark = docs.sparkSession
    sources = tuple(_read(f"{folder}/{name}") for name in (file_a, file_b))
    shared = spark.sparkContext.broadcast(sources)
    width, limit = len(Pieces(sources[1]).bytes), max(len(ByteLevel(sources[0]).bytes), len(Pieces(sources[1]).bytes))
    finished = reduced(written(chunked(docs, shared, chunk_bytes), "fragments"), limit, width, fanin)
    pairs = shared_folder(spark, "blocks")
    blocks = pair_blocks(pair_counts(finished), width, pairs, block_pairs)
    return scored(finished, pairs, blocks)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
