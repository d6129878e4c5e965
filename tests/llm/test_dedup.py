import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gleanery.llm import bottomk, substrings
from gleanery.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_substrings(rows, width):
    first, split = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        words = split[i] = WORD.findall(rows[i][1] or "")
        for s in range(len(words) - width + 1):
            first.setdefault(tuple(words[s : s + width]), (i, s))
    out = {}
    for i in order:
        words, gone = split[i], set()
        for s in range(len(words) - width + 1):
            if first[tuple(words[s : s + width])] != (i, s):
                gone.update(range(s, s + width))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out[rows[i][0]] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substrings_equal_brute_force(make, odd_texts):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    shared = " ".join(rng.choice(words) for _ in range(30))
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    for i in range(60):
        own = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        rows.append((100 + i, f"{own} {shared}\n{own}" if i % 3 else own))
    rows.append((None, shared))
    for width in (4, 20):
        got = substrings.dedup_substrings(make(rows).withColumn("piece", F.lit("clash")), width).collect()
        seen = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got}
        assert seen == brute_substrings(rows, width)
        for r in got:
            assert sum(e - s for s, e in r.spans) == r.n_removed
            assert all(a[1] < b[0] for a, b in zip(r.spans, r.spans[1:]))


def test_substrings_keep_one_of_repeated_rows(make):
    text = " ".join(f"x{i}" for i in range(25))
    got = substrings.dedup_substrings(make([(1, text), (1, text), (2, text)])).collect()
    assert sorted(r.n_removed for r in got) == [0, 25, 25]
    assert substrings.dedup_substrings(make([(1, text)]).where("false")).collect() == []


def test_substring_buckets_cost_the_same_for_many_pieces():
    """The same hashes of a bucket, sent by 4 or by 400 pieces."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 32, 100_000, dtype=np.uint64)
    took = {}
    for n in (4, 400):
        # Each hash goes to two pieces, and as many more are in one piece only.
        sent = [np.concatenate([hashes[k % (n // 2) :: n // 2], rng.integers(0, 1 << 32, 200_000 // n)]) for k in range(n)]
        sent = [np.unique(x.astype(np.uint32)) for x in sent]
        table = substrings._packed(list(range(n)), [7] * n, [substrings._short(x) for x in sent])
        began = time.process_time()
        answers = substrings._answer(table)
        took[n] = time.process_time() - began
        counts = Counter(np.concatenate(sent).tolist())
        got = {p: np.frombuffer(d, "<u4").tolist() for p, d in zip(answers["piece"].to_pylist(), answers["data"].to_pylist())}
        assert got == {k: [h for h in x.tolist() if counts[h] > 1] for k, x in enumerate(sent)}
        assert set(answers["bucket"].to_pylist()) == {7}
    assert took[400] < 5 * took[4] + 0.2


def test_substring_windows_equal_in_one_hash_only_differ():
    a = np.array([5, 1, 5, 2, 1, 9, 2, 1], np.uint64)
    b = np.array([7, 7, 7, 7, 7, 3, 7, 7], np.uint64)
    at, starts = substrings._runs(a, b, np.arange(8))
    assert [sorted(x.tolist()) for x in np.split(at, starts[1:])] == [[5], [1, 4, 7], [3, 6], [0, 2]]
    at, starts = substrings._runs(a, b, np.zeros(0, np.int64))
    assert len(at) == len(starts) == 0


def test_substring_earliest_of_equal_windows_stays():
    """Pieces 3 and 8 have equal doc_ids, piece 5 a later one; hash 4 is elsewhere under another second hash."""
    rows = {8: [(4, 10, 6), (1, 2, 9)], 5: [(4, 10, 7), (4, 11, 1)], 3: [(4, 10, 6), (1, 2, 10)]}
    data = [b"".join(np.array(c, kind).tobytes() for c, kind in zip(zip(*x), ("<u4", "<u8", "<i8"))) for x in rows.values()]
    answers = substrings._losers(substrings._packed(list(rows), [2] * 3, data))
    lost = {p: (np.frombuffer(d, "<u4", len(d) // 12).tolist(), np.frombuffer(d, "<u8", len(d) // 12, len(d) // 3).tolist()) for p, d in zip(answers["piece"].to_pylist(), answers["data"].to_pylist())}
    assert lost == {8: ([4], [10]), 5: ([4], [10]), 3: ([1], [2])}


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows, size):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            a, b = sets[i], sets[j]
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, n):
    rows = []
    for base in range(n):
        words = [f"v{rng.randint(0, 300)}" for _ in range(rng.choice([1, 2, 4, 5, 6, 8, 12, 40, 150]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(copy) // 15))):
                copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 300)}"
            rows.append(" ".join(copy if rng.random() < 0.7 else copy[:-1]))
    return rows


def test_groups_equal_brute_force(make, odd_texts):
    rows = list(enumerate(odd_texts + near_copies(random.Random(2), 60)))
    for size in (2, 5):
        got = bottomk.near_duplicates(make(rows).withColumn("component", F.lit(1)), size).collect()
        want = brute_components(rows, size)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_long_lists_of_unlike_classes(make):
    """Texts that share a passage but are no near copies, and a chain, keep exact groups."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = [" ".join(passage + [f"t{rng.randint(0, 9)}x{i}" for i in range(rng.randint(8, 30))]) for _ in range(40)]
    chain = [f"c{i}" for i in range(60)]
    rows += [" ".join(chain[3 * i : 3 * i + 40]) for i in range(6)]
    rows = list(enumerate(rows))
    got = bottomk.near_duplicates(make(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 2)


def test_rows_without_id_and_no_rows(make):
    rows = [(None, "a b c"), (None, "a b c"), (4, "a b c"), (3, "a b c")]
    got = bottomk.near_duplicates(make(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(3, 3, True), (4, 3, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert bottomk.near_duplicates(make(rows).where("false")).collect() == []
    kept = bottomk.drop_near_duplicates(make(rows + [(3, "a b c")]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "None", "None"]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
