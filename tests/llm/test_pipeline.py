import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from gleanery.llm import oracle, quality, queries
from tests.llm.test_dedup import brute_components
from tests.llm.test_order import water_fill
from tests.llm.test_texts import brute_hits

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, make, tmp_path_factory):
    rng = random.Random(12)
    words = [f"word{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(5)]
    rows, labels = [], []
    for i in range(260):
        body = [rng.choice(words) for _ in range(rng.randint(15, 60))]
        if i % 13 == 4:
            body = rows[i - 1][1].split()
            body[0] = "changed"
        if i % 17 == 5:
            body += items[i % 5][1].split()
        if i % 5 == 0:
            body = [f"{w}$$%%" for w in body]
        rows.append((i, " ".join(body).capitalize() + ".", "en", f"s{i % 4}" if i % 3 else "s0", 5))
        labels.append((i, int(i % 5 != 0), 0))
    rows += [(260, None, None, None, None), (261, "", "en", "s9", 0), rows[7], rows[7]]
    folder = str(tmp_path_factory.mktemp("tables"))
    make(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def brute_mix(rows):
    """Copies of each document (whole ones) that the mix takes."""
    sizes = Counter()
    for row in rows:
        sizes[row[3]] += len(WORD.findall(row[1] or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    targets = water_fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    copies = Counter()
    for source in sizes:
        start = 0
        own = [r for r in rows if r[3] == source]
        for row in sorted(own, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0])):
            size = len(WORD.findall(row[1] or ""))
            for epoch in range(3):
                words = math.floor(min(size, max(0.0, targets[source] - start - epoch * sizes[source])))
                copies[row[0]] += words > 0 and 2 * words > size
            start += size
    return {i: n for i, n in copies.items() if n}


def test_pipeline_equals_brute_force(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = quality.classify(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.doc_id for r in scored.where(F.col("score") >= quality.THRESHOLD).select("doc_id").collect()}
    assert good >= {i for i in range(260) if i % 5} and not good & {i for i in range(260) if i % 5 == 0}
    left = [r for r in {r[0]: r for r in rows}.values() if r[0] in good]
    groups = brute_components([(r[0], r[1]) for r in left], 5)
    left = [r for r in left if groups[r[0]][1] == r[0]]
    left = [r for r in left if brute_hits(r[1], items, 10)[1] == 0]
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == [*docs.columns, "shard", "slot"]
    got = got.collect()
    assert dict(Counter(r.doc_id for r in got)) == brute_mix(left)
    texts = {r[0]: r[1:] for r in rows}
    assert all((r.text, r.lang, r.source, r.n_chars) == texts[r.doc_id] for r in got)
    shards = Counter(r.shard for r in got)
    assert max(shards.values()) - min(shards.values()) <= 1
    assert {(r.shard, r.slot) for r in got} == {(s, i) for s, n in shards.items() for i in range(n)}


def test_stages_keep_the_columns_and_take_no_documents(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights", "sharding",
    ]
    none = docs.where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, folder)
        assert out.columns[:5] == docs.columns and out.collect() == []


def test_registered_queries_and_twins():
    names = contract.queries()
    assert [len([n for n in names if n.startswith(f"op{k}_")]) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(oracle.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_queries_equal_their_twins(spark, name):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = db.execute(oracle.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))
