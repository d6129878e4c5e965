"""Words of Arrow text columns as numpy arrays: positions, hashes, windows.

Everything works on the UTF-8 bytes of a whole batch at once, so no Python loop runs per word or
per document. Both word classes split at ASCII bytes only; every byte of a multi-byte character
is 128 or more and belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are held as numpy arrays at once (about 60 bytes of arrays for each).
PIECE_BYTES = 1 << 19

_CODES = np.arange(256)
#: `[^\x20\x09-\x0D]+`
SPACE = (_CODES == 0x20) | ((_CODES >= 0x09) & (_CODES <= 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, to be used on lower-cased text
NOT_ALNUM = (
    (_CODES <= 0x2F)
    | ((_CODES >= 0x3A) & (_CODES <= 0x60))
    | ((_CODES >= 0x7B) & (_CODES <= 0x7F))
)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)

_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
#: Two independent odd multipliers for Rabin-Karp hashes of words.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i`` modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), dtype=np.uint64, out=out[1:])
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds (one more than rows) of a text column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def pieces(
    batches: Iterable[pa.RecordBatch], name: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` text bytes; a longer text makes a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(text_column(batch, name)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


class Words:
    """The words of some documents: byte positions, document of each, word range of each."""

    def __init__(self, column: pa.Array, separators: np.ndarray, lower: bool = False):
        data, self.doc_bytes = text_buffers(column)
        self.data = LOWER[data] if lower else data
        inside = ~separators[self.data]
        n = len(data)
        opens = np.zeros(n + 1, bool)
        opens[self.doc_bytes] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | opens[:n]))
        self.end = np.flatnonzero(inside & (~after | opens[1:])) + 1
        #: Words of document d are first[d] up to first[d + 1].
        self.first = np.searchsorted(self.start, self.doc_bytes)
        self.n_docs = len(column)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def windows(self, hashes: np.ndarray, width: int, base: int = BASES[0]) -> np.ndarray:
        """Rabin-Karp hash of the ``width`` words from each word on; see ``whole``."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        sums = _sums(hashes, base)
        back = powers(_inverse(base), n)
        return mix((sums[width:] - sums[:n]) * back)

    def whole(self, width: int) -> np.ndarray:
        """Start words of the windows that lie within one document."""
        n = len(self) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[:n] == self.doc[width - 1 :])

    def covered(self, starts: np.ndarray, widths: np.ndarray | int) -> np.ndarray:
        """Mask of the words inside any window that begins at ``starts``."""
        edge = np.zeros(len(self) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + widths, -1)
        return np.cumsum(edge[:-1]) > 0

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each document."""
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def bytes_per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each document."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.doc_bytes[1:]] - sums[self.doc_bytes[:-1]]

    def join(self, keep: np.ndarray) -> pa.Array:
        """Each document's kept words, joined by one space."""
        kept = np.flatnonzero(keep)
        start, end, doc = self.start[kept], self.end[kept], self.doc[kept]
        spaced = np.zeros(len(kept), bool)
        spaced[:-1] = doc[:-1] == doc[1:]
        edge = np.zeros(len(self.data) + 2, np.int32)
        edge[start] += 1
        np.add.at(edge, end + spaced, -1)
        chosen = np.cumsum(edge[: len(self.data)]) > 0
        data = self.data.copy()
        data[end[spaced]] = 0x20
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(chosen, out=sums[1:])
        bounds = sums[self.doc_bytes]
        return pa.LargeStringArray.from_buffers(
            self.n_docs, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[chosen].tobytes())
        )


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend. Long inputs go in blocks of bounded memory."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + 2 * PIECE_BYTES, "right")))
        low, high = start[at], end[at:stop].max()
        sums = _sums(data[low:high].astype(np.uint64) + _U(1), _BYTE_BASE)
        back = powers(_inverse(_BYTE_BASE), int(high - low))
        s, e = start[at:stop] - low, end[at:stop] - low
        value = (sums[e] - sums[s]) * back[np.minimum(s, high - low - 1)]
        out[at:stop] = mix(value ^ mix((e - s).astype(np.uint64)))
        at = stop
    return out


def repeated(values: np.ndarray) -> np.ndarray:
    """Mask of the values that occur more than once."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    mask = np.zeros(len(values), bool)
    mask[order[1:][same]] = True
    mask[order[:-1][same]] = True
    return mask
