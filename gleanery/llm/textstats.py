"""Statistics of whole texts, a batch at a time: character classes, repeats, lines, features."""

from __future__ import annotations

import numpy as np

from gleanery.llm.scan import Words, mix, repeated, span_hashes

SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol", "other")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.int64)
    codes = np.arange(256)
    table[(codes >= 97) & (codes <= 122)] = CLASSES.index("lower")
    table[(codes >= 65) & (codes <= 90)] = CLASSES.index("upper")
    table[(codes >= 48) & (codes <= 57)] = CLASSES.index("digit")
    table[(codes == 32) | ((codes >= 9) & (codes <= 13))] = CLASSES.index("space")
    table[list(b".,;:")] = CLASSES.index("stop")
    table[list(b"!?'\"()-")] = CLASSES.index("mark")
    table[list(b"#*$%&|<>@^_~=+/\\[]{}`")] = CLASSES.index("symbol")
    return table


_CLASS = _class_table()
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def by_doc(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that are equal only for equal keys of the same document."""
    return mix(keys ^ mix(doc.astype(np.uint64) * _STEP))


def first_marks(w: Words) -> np.ndarray:
    """Mask of the bytes that begin a character."""
    return (w.data & 0xC0) != 0x80


def class_counts(w: Words) -> np.ndarray:
    """Characters of each class (columns) in each document (rows)."""
    begins = first_marks(w)
    doc = np.repeat(np.arange(w.n_docs), np.diff(w.doc_bytes))[begins]
    n = len(CLASSES)
    return np.bincount(doc * n + _CLASS[w.data[begins]], minlength=w.n_docs * n).reshape(-1, n)


def symbol_counts(w: Words) -> np.ndarray:
    return w.bytes_per_doc(_SYMBOL[w.data])


def word_chars(w: Words, separators: np.ndarray) -> np.ndarray:
    """Code points in words."""
    return w.bytes_per_doc(first_marks(w) & ~separators[w.data])


def lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every \\n-split line that has a word."""
    breaks = np.flatnonzero(w.data == 10)
    start = np.union1d(w.doc_bytes[:-1], breaks + 1)
    start = start[start < len(w.data)]
    end = np.append(start[1:], len(w.data))
    end = end - (w.data[end - 1] == 10) if len(end) else end
    has_word = np.searchsorted(w.start, start) < np.searchsorted(w.start, end)
    start, end = start[has_word], end[has_word]
    return start, end, np.searchsorted(w.doc_bytes, start, "right") - 1


def later_equal(keys: np.ndarray) -> np.ndarray:
    """Mask of the values that stand earlier, too."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    mask = np.zeros(len(keys), bool)
    mask[order[1:][ranked[1:] == ranked[:-1]]] = True
    return mask


def duplicate_lines(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines equal to an earlier one, and lines with a word, of each document."""
    start, end, doc = lines(w)
    later = later_equal(by_doc(span_hashes(w.data, start, end), doc))
    return np.bincount(doc[later], minlength=w.n_docs), np.bincount(doc, minlength=w.n_docs)


def repeat_words(w: Words, hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Words inside ``width``-word windows that the document has twice or more."""
    starts = w.whole(width)
    keys = by_doc(w.windows(hashes, width)[starts], w.doc[starts]) if len(starts) else np.zeros(0, np.uint64)
    return w.per_doc(w.covered(starts[repeated(keys)], width))


FEATURES = (
    "log_words", "log_chars", "word_chars", "short_words", "long_words", "lower", "upper", "digit", "space",
    "stop", "mark", "symbol", "other", "bang", "pipe", "duplicate_lines", "repeat_words", "distinct_words",
    "words_per_line", "word_without_letter", "shouted_words", "symbol_ends", "stop_ends",
)


def features(w: Words, separators: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per document; an empty text has zeros."""
    hashes = w.hashes()
    n = w.counts
    words = np.maximum(n, 1)
    classes = class_counts(w)
    chars = np.maximum(classes.sum(axis=1), 1)
    width = w.end - w.start
    dup, n_lines = duplicate_lines(w)
    again = later_equal(by_doc(hashes, w.doc))
    last = _CLASS[w.data[w.end - 1]] if len(w) else np.zeros(0, np.int64)

    def letters(table: list[str]) -> np.ndarray:
        member = np.isin(_CLASS, [CLASSES.index(x) for x in table])[w.data]
        sums = np.concatenate([[0], np.cumsum(member)])
        return sums[w.end] - sums[w.start]

    upper = letters(["upper"])
    columns = [
        np.log1p(n),
        np.log1p(classes.sum(axis=1)),
        word_chars(w, separators) / words,
        w.per_doc(width <= 3) / words,
        w.per_doc(width >= 12) / words,
        *(classes / chars[:, None]).T,
        w.bytes_per_doc(w.data == ord("!")) / chars,
        w.bytes_per_doc(w.data == ord("|")) / chars,
        dup / np.maximum(n_lines, 1),
        repeat_words(w, hashes) / words,
        1 - w.per_doc(again) / words,
        np.log1p(n / np.maximum(n_lines, 1)),
        w.per_doc(letters(["lower", "upper", "other"]) == 0) / words,
        w.per_doc((upper >= 2) & (letters(["lower"]) == 0)) / words,
        w.per_doc(last == CLASSES.index("symbol")) / words,
        w.per_doc(last == CLASSES.index("stop")) / words,
    ]
    return np.stack(columns, axis=1).astype(np.float64)
