import random
import re

import numpy as np
import pyarrow as pa

from gleanery.llm.scan import NOT_ALNUM, SPACE, Words, pieces

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def texts(n=200):
    rng = random.Random(3)
    made = ["".join(rng.choice("ab Zé\n\t-9 ") for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [None, "", " ", "a", " b", "c "] + made


def words_of(w):
    return [w.data[s:e].tobytes().decode() for s, e in zip(w.start, w.end)]


def test_words_match_the_patterns():
    given = texts()
    w = Words(pa.array(given), SPACE)
    assert words_of(w) == [x for t in given for x in SPACED.findall(t or "")]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in given]
    w = Words(pa.array(given), NOT_ALNUM, lower=True)
    assert words_of(w) == [x for t in lower for x in ALNUM.findall(t)]
    assert w.counts.tolist() == [len(ALNUM.findall(t)) for t in lower]


def test_hashes_and_windows_tell_words_apart():
    w = Words(pa.array(texts()), SPACE)
    words, hashes = words_of(w), w.hashes()
    assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist())))
    starts = w.whole(3)
    keys = w.windows(hashes, 3)[starts].tolist()
    spans = [tuple(words[i : i + 3]) for i in starts]
    assert len(set(spans)) == len(set(keys)) == len(set(zip(spans, keys)))
    assert all(w.doc[i] == w.doc[i + 2] for i in starts)


def test_join_keeps_order_and_documents():
    given = texts()
    w = Words(pa.array(given, pa.large_string()), SPACE)
    keep = np.random.default_rng(1).random(len(w)) < 0.5
    want = [
        " ".join(x for x, k in zip(SPACED.findall(t or ""), keep[w.first[d] : w.first[d + 1]]) if k)
        for d, t in enumerate(given)
    ]
    assert w.join(keep).to_pylist() == want


def test_pieces_hold_every_row_once_within_the_limit():
    batch = pa.RecordBatch.from_pydict({"id": list(range(206)), "text": texts()})
    cut = list(pieces([batch, batch.slice(0, 0)], limit=100))
    assert [x for p in cut for x in p.column(0).to_pylist()] == list(range(206))
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 100 for p in cut)


def test_empty_batch():
    w = Words(pa.array([], pa.string()), SPACE)
    assert len(w) == 0 and len(w.hashes()) == 0 and len(w.whole(2)) == 0 and w.join(np.zeros(0, bool)).to_pylist() == []
