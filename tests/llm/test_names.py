"""User columns that are named like internal ones come back as they were."""

import pytest
from pyspark.sql import functions as F

from gleanery.llm import bottomk, hilbert, mixing, quality, toxicity
from gleanery.llm.names import free_names
from gleanery.llm.prefix import row_key

HELPERS = [
    "_key", "_KEY", "_id", "_text", "_position", "_part", "_place", "_order", "mix_key", "_mix_key", "MIX_POSITION", "place_key", "id_key",
    "text_key", "size", "target", "copies", "taken", "position", "weight", "label", "x", "score", "y", "curve", "text_crc32", "rank",
    "before", "digest", "head", "first_id", "component_id", "class_id", "doc", "n", "a.b", "back`tick",
]
HELPERS = [h for i, h in enumerate(HELPERS) if h.lower() not in {x.lower() for x in HELPERS[:i]}]


def quoted(name):
    return "`" + name.replace("`", "``") + "`"


@pytest.fixture(scope="module")
def docs(make):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(i, " ".join(words[(i * 7 + j * j) % 10] + str(i % 6) for j in range(30)), "en", f"s{i % 3}") for i in range(24)]
    return make(rows).select("*", *[F.concat(F.lit(h + ":"), F.col("doc_id")).alias(h) for h in HELPERS])


def held(frame, but=()):
    names = [h for h in HELPERS if h not in but]
    rows = frame.select("doc_id", *[F.col(quoted(h)) for h in names]).collect()
    assert rows
    for r in rows:
        assert [r[i + 1] for i in range(len(names))] == [f"{h}:{r[0]}" for h in names]
    return rows


def test_mix(docs):
    mixed = mixing.mix(docs, mixing.cycle_schedule(docs))
    assert mixed.columns == docs.columns
    held(mixed)


def test_place(docs):
    placed = hilbert.place(docs, 5)
    assert placed.columns == [*docs.columns, "shard", "slot"] and len(held(placed)) == 24


def test_drop_near_duplicates(docs):
    kept = bottomk.drop_near_duplicates(docs, words=5)
    assert kept.columns == docs.columns
    assert len(held(kept)) == 24 and bottomk.drop_near_duplicates(docs.union(docs), words=5).count() == 24


@pytest.mark.parametrize("module", [quality, toxicity])
def test_fits(spark, docs, module):
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2, "u") for i in range(24)], "doc_id long, quality int, toxic int, _id string")
    plain = docs.select("doc_id", "text")
    one, other = module.fit(docs, labels), module.fit(plain, labels.drop("_id"))
    if module is quality:
        assert one["start"] == other["start"]
    else:
        assert [m["share"] for m in one] == [m["share"] for m in other]


def test_free_names(docs):
    names = free_names(docs, "mix_key", "mix_key", "fresh")
    assert names == ["__mix_key", "___mix_key", "fresh"]


def test_keys_tell_rows_apart(spark):
    rows = [("a", None), (None, "a"), ("\x00", None), (None, None), ("a\x01", "b"), ("a", "\x01b"), ("1:a", ""), ("", "1:a"), ("-", "-")]
    frame = spark.createDataFrame(rows, "p string, q string")
    assert frame.select(row_key(frame)).distinct().count() == len(rows)
