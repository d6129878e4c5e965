"""Cross-tokenizer alignment against a plain version that reads the whole table."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pytest

from gleanery.llm import alignment as al

FOLDER = "/opt/tokenizers"


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{FOLDER}/{al.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{al.FILE_B}")
    letters = al.byte_letters()

    def a_bytes(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), a_bytes, b.encode, b_bytes


def brute(rows, tokenizers):
    encode_a, a_bytes, encode_b, b_bytes = tokenizers
    counts, docs = Counter(), []
    for doc_id, text in rows:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        spans = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(size(i)), i))
                at += len(size(i))
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= cut) for side in spans))
            start = cut
        docs.append((doc_id, len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(
        (
            doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, groups, links in docs
    )


TEXTS = [
    None, "", " ", "\n\n\t ", "one", "é", "naïve café — 日本語テキスト 👩‍👩‍👧", "<|endoftext|> and </s> <0x41> stay text", "has ▁ in it",
    "same text", "same text", "  two  spaces\r\nand lines ", "x" * 300, "\u0000 \u001f   　 odd blanks", "don't we'll 12345 6.7e8",
    "́ combining ​ zero ﻿ width", "ａｂｃ ﬁ ① fullwidth", "a b\u0085c᠎d",
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    stock = "the of and to in Energie größer été niño 42 , . ( ) - supercalifragilistic Zürich \n \n\n  ".split(" ")
    longer = ["".join(rng.choice(stock) + rng.choice([" ", "", "  "]) for _ in range(n)) for n in (40, 300, 900)]
    return [(i, t) for i, t in enumerate(TEXTS + longer)] + [(3, "a second row of 3"), (None, "no id")]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("chunk_bytes, fanin, block_pairs", [(1 << 16, 8, 1 << 22), (7, 2, 64), (50, 3, 200)])
def test_equals_brute_force(spark, make, tokenizers, rows, chunk_bytes, fanin, block_pairs):
    """Whole, and cut into chunks smaller than a token."""
    docs = make([(i, t, "row", "links", 1) for i, t in rows]).withColumnRenamed("lang", "n_best").withColumnRenamed("source", "code")
    found = al.align(docs, chunk_bytes=chunk_bytes, fanin=fanin, block_pairs=block_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = [tuple(r[c] for c in COLUMNS) for r in found.collect()]
    named = [(-1 if i is None else i, t) for i, t in rows]
    want = brute(named, tokenizers)
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want
    assert all(r[4] == r[1] + r[2] - r[3] for r in got)


def test_composition_is_associative(tokenizers):
    encode_a, a_bytes, encode_b, b_bytes = tokenizers
    text = "Wörter und tokens, überall different cuts; 日本語 too " * 3
    a, b = encode_a(text), encode_b(text)
    lengths = [np.zeros(60_000, np.int64) for _ in range(2)]
    for ids, size, table in ((a, a_bytes, lengths[0]), (b, b_bytes, lengths[1])):
        for i in ids:
            table[i] = len(size(i))
    writer, width = al.Writer(60_000), 32_000
    sizes = np.array([len(text.encode()) + 1])
    whole = next(al.fragments([a], [b], sizes, writer, width, lengths, 1 << 20))[3]
    for chunk in (1, 2, 5, 13):
        parts = [f for *_, f in al.fragments([a], [b], sizes, writer, width, lengths, chunk)]
        join = lambda x, y: al.compose(x, y, writer, width)
        left = reduce(join, parts)
        right = parts[-1]
        for part in reversed(parts[:-1]):
            right = join(part, right)
        for one in (left, right):
            assert one.text == whole.text and one.n_groups == whole.n_groups and (one.n_a, one.n_b) == (len(a), len(b))
            assert np.array_equal(one.codes, whole.codes) and np.array_equal(one.counts, whole.counts)


def test_both_encoders_of_a_agree(tokenizers):
    """The ranks give what the merges give, on odd blanks and long runs, too."""
    encode_a = tokenizers[0]
    with open(f"{FOLDER}/{al.FILE_A}", "rb") as f:
        ranked = al.ByteLevel(f.read())
    rng = random.Random(9)
    letters = "ab Ü\t\n\r\u000b\u000c\u0085  ᠎    　​﻿'sllRE19٣²½é日本👩‍.,_-|"
    texts = [t for t in TEXTS if t] + ["".join(rng.choice(letters) for _ in range(60)) for _ in range(400)] + ["ab" * 20_000, " " * 20_000, "x" + " " * 1_000_000 + "\n" * 9_000 + "y"]
    assert ranked.encode([" " + t for t in texts]) == [encode_a(t) for t in texts]


def test_blobs_return():
    codes = np.array([0, 5, 1 << 39], np.int64)
    back = al.unpack(al.pack(codes, np.array([1, 2, 300])))
    assert back[0].tolist() == codes.tolist() and back[1].tolist() == [1, 2, 300]


def test_empty_table(make):
    assert al.align(make([])).count() == 0
