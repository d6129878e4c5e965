"""Embedding near-dedup against all pairs, and the graphs' recall."""

import math
import random

import numpy as np
import pytest

from gleanery.llm import embeddings as em
from gleanery.llm import hnsw

SCHEMA = "vec_id long, embedding array<double>, label int, node long, h1 string"


def comparable(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows):
    good = [k for k, (_, v) in enumerate(rows) if rows[k][0] is not None and comparable(v)]
    near = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            x, y = rows[a][1], rows[b][1]
            if a != b and len(x) == len(y):
                s, t = max(map(abs, x)), max(map(abs, y))
                x, y = [p / s for p in x], [p / t for p in y]
                if math.fsum(p * q for p, q in zip(x, y)) / math.hypot(*x) / math.hypot(*y) >= 0.9:
                    near[a].add(b)
    out = []
    for k, (i, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            for b in near[todo.pop()] - reach:
                reach.add(b)
                todo.append(b)
        least = min((rows[b][0] for b in reach if rows[b][0] is not None), default=None)
        out.append((i, len(near[k]), least, i == least))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vector = lambda n=8: [rng.gauss(0, 1) for _ in range(n)]
    near = lambda v, s: [x + rng.gauss(0, s) for x in v]
    out = [vector() for _ in range(60)]
    for v in out[:6]:
        out += [near(v, 0.1) for _ in range(6)]
    chain = vector()
    for _ in range(8):
        chain = near(chain, 0.25)
        out.append(chain)
    out += [list(out[0])] * 20 + [[2.5 * x for x in out[1]], [-0.0, 1.0] + [0.0] * 6, [0.0, 1.0] + [0.0] * 6]
    out += [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [1e300] * 8, [1e-300] * 8]
    out += [out[0][:7], out[0][:7], [3.0], [4.0], [-1.0]]
    rng.shuffle(out)
    named = list(enumerate(out))
    return named + [(5, vector()), (5, named[9][1]), (7, named[7][1]), (None, named[0][1])]


@pytest.mark.parametrize("shard_rows", [10_000, 12, 1])
def test_equals_all_pairs(spark, rows, shard_rows):
    """One shard, several, and one or two vectors each; other columns have the names of internal ones."""
    some = rows if shard_rows > 1 else rows[:12]
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in some], SCHEMA).repartition(3)
    got = em.near_duplicates(table, shard_rows=shard_rows)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = [(i, n, c, True if i is None else k) for i, n, c, k in brute(some)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_no_comparable_vectors(spark):
    assert em.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = em.near_duplicates(spark.createDataFrame([(1, None, 1, 2, "x"), (2, [0.0], 1, 2, "x")], SCHEMA)).collect()
    assert sorted(map(tuple, alone)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_walks_find_planted_copies():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2_500, 32))
    x[1_000:1_600] = x[7] + 0.02 * rng.normal(size=(600, 32))  # one large group
    x[1_600:2_000] = x[:400] + 0.05 * rng.normal(size=(400, 32))
    x = em.unit(x)[rng.permutation(len(x))]
    graph = hnsw.build(x)
    again, more = hnsw.load(hnsw.dump(graph, n=np.arange(3)))
    assert np.array_equal(again.levels[0], graph.levels[0]) and more["n"].tolist() == [0, 1, 2]
    true = graph.x @ graph.x.T >= 0.9
    width = hnsw.audited(graph, graph.x[::20], 0.9, 8, 0.995)
    r, c = hnsw.hits(again, graph.x, 0.9, width)
    assert true[r, c].mean() > 0.999 and len(set(zip(r.tolist(), c.tolist()))) == len(r) >= 0.99 * true.sum()


def test_forest_keeps_components():
    rng = np.random.default_rng(4)
    found = rng.random((30, 40)) < 0.03
    left, right = np.arange(30) * 2, np.arange(40) * 2 + 1
    nodes, roots = em.forest(found, left, right)

    def labels(edges):
        group = {int(n): int(n) for n in [*left, *right]}
        for _ in range(80):
            for a, b in edges:
                group[a] = group[b] = min(group[a], group[b])
        return group

    pairs = [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(found))]
    a, b = labels(list(zip(nodes.tolist(), roots.tolist()))), labels(pairs)
    assert {k: min(m for m in a if a[m] == a[k]) for k in a} == {k: min(m for m in b if b[m] == b[k]) for k in b}
