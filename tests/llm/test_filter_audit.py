"""Filter audit against a plain version, and the shared matrix against word counts."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from gleanery.llm import filter_audit as fa
from gleanery.llm.scan import SPACE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    texts = [(i, lang or "", text or "") for i, text, lang in docs]
    good, toxic = ({i for i, *row in labels if row[k] == 1 and i is not None} for k in (0, 1))
    failed = []
    for i, part, text in texts:
        words = WORD.findall(text)
        failed.append({
            name for name, bad in (
                ("A", len(words) < 100),
                ("B", 100 * len(set(words)) < 80 * len(words)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
                ("D", bool(re.search(r"[#$%&*|]", text))),
                ("E", i is not None and any(j is not None and j < i and t == text for j, _, t in texts)),
            ) if bad
        })
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in texts}:
        rows = [(i, f) for (i, p, _), f in zip(texts, failed) if p == part]
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [i for i, f in rows if name in f and not f & before]
                shapley[part, name] += len(here)
                out[part, order, step] = (
                    sum(not f & (before | {name}) for _, f in rows), len(here), sum(name in f and bool(f & before) for _, f in rows),
                    sum(f == {name} for _, f in rows), sum(i in good for i in here), sum(i in toxic for i in here),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in frame.collect()}


@pytest.fixture(scope="module")
def rows(odd_texts):
    rng = random.Random(3)
    stock = ["".join(rng.choice("abcdeEÉ#é") for _ in range(5)) for _ in range(400)]
    texts = odd_texts + [" ".join(rng.choice(stock) for _ in range(rng.choice([20, 99, 100, 101, 300]))) for _ in range(30)]
    texts += texts[8:20] + ["COPY of a text"] * 25
    langs = ["en", None, "", "de|x"]
    docs = [(i, t, langs[i % 4]) for i, t in enumerate(texts)]
    return docs + docs[5:9] + [(7, "another text of 7", "en"), (None, "no id", "en"), (None, "no id", "en"), (90_000, "no id", "en")]


LABELS = [(i, [0, 1, None][i % 3], [1, 0, None, 0][i % 4]) for i in range(60)] + [(3, 1, 1), (None, 1, 1)]


def tables(spark, make, rows):
    docs = make(rows).withColumnRenamed("source", "shard").withColumnRenamed("n_chars", "failed")
    return docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("shard_bytes", [1, 3_000, 1 << 24])
def test_equals_brute_force(spark, make, rows, shard_bytes):
    docs, labels = tables(spark, make, rows)
    assert found(fa.audit(docs, labels, shard_bytes=shard_bytes)) == brute(rows, LABELS)


def test_matrix_counts_words(spark, make, rows):
    """Columns are one per different word of the corpus, and a row holds its document's counts."""
    docs, _ = tables(spark, make, rows)
    shards = fa.packed(docs, docs["lang"], 5_000).cache()
    words = fa.numbered(shards)
    seen, names = {}, {}
    known = {r.shard: r for r in words.groupBy("shard").agg({"at": "collect_list", "column": "collect_list"}).collect()}
    for shard in shards.collect():
        for at, column in zip(known[shard.shard][1], known[shard.shard][2]) if shard.shard in known else ():
            for i, c in zip(np.frombuffer(at, "<i4"), np.frombuffer(column, "<i8")):
                assert names.setdefault(int(c), shard.words[i]) == shard.words[i]
    assert len(set(names.values())) == len(names) == len({w for _, t, _ in rows for w in WORD.findall(t or "")})
    for block in fa.matrix(shards, words).collect():
        for k, i in enumerate(block.doc_id):
            cells = range(block.starts[k], block.starts[k + 1])
            seen.setdefault(i, []).append({names[block.columns[c]]: block.counts[c] for c in cells})
    for i, text, _ in rows:
        assert dict(Counter(WORD.findall(text or ""))) in seen[i]
    assert SPACE[9] and sum(map(len, seen.values())) == len(rows)


def test_empty_tables(spark, make):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(make([]), labels).count() == 0
    assert len(found(fa.audit(make([(1, None, None)]), labels))) == 600
