import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import hilbert, mixing
from gleanery.llm.prefix import ranked

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sourced(rng):
    rows = []
    for name, count in (("a", 40), ("b", 3), (None, 20), ("Z", 5), ("é", 8), ("empty", 3)):
        for _ in range(count):
            n = 0 if name == "empty" else rng.randint(0, 60)
            rows.append((len(rows), "w " * n if n else rng.choice([None, "", " \n"]), "en", name))
    return rows + [rows[0], (None, "one two", "en", "a")]


def water_fill(sizes, weights, repeats):
    """Targets by fixing one cap after the other."""
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(repeats * sizes[s] for s in capped)
        weight = sum(weights[s] for s in sizes if s not in capped)
        level = left / weight if weight else 0
        over = {s for s in sizes if s not in capped and level * weights[s] > repeats * sizes[s]}
        if not over:
            return {s: repeats * sizes[s] if s in capped else level * weights[s] for s in sizes}
        capped |= over


@pytest.fixture(scope="module")
def planned(make):
    rows = sourced(random.Random(11))
    docs = make(rows)
    return rows, docs, mixing.plan(docs, mixing.cycle_schedule(docs)).collect()


def test_targets_and_taken_words(planned):
    rows, _, got = planned
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    assert len(got) == len(rows)
    for r in got:
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(want[r.source]))
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies)
    for source in sizes:
        taken = sum(r.taken for r in got if r.source == source)
        assert want[source] - 1 <= taken <= want[source] + 1e-6


def test_plan_is_the_same_on_other_partitions(planned):
    _, docs, got = planned
    again = mixing.plan(docs.repartition(7), mixing.cycle_schedule(docs)).collect()
    key = lambda r: (str(r.doc_id), r.taken, [c.position for c in r.copies])
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_positions_follow_the_schedule(spark, make):
    docs = make([(i, "w " * 10, "en", "ab"[i % 2]) for i in range(400)])
    knots = [("a", 0.0, 1.0), ("a", 0.5, 3.0), ("a", 1.0, 0.0), ("b", 0.0, 2.0), ("b", 1.0, 2.0)]
    schedule = spark.createDataFrame(knots, "source string, t double, weight double")
    got = mixing.plan(docs, schedule).collect()
    places = {s: np.sort([c.position for r in got if r.source == s for c in r.copies]) for s in "ab"}
    t = np.linspace(0, 1, 20001)
    for s, weight in (("a", np.interp(t, [0, 0.5, 1], [1, 3, 0])), ("b", np.full(len(t), 2.0))):
        demand = np.cumsum(weight) / weight.sum()
        share = np.arange(len(places[s])) / len(places[s])
        assert places[s] == pytest.approx(np.interp(share, demand, t), abs=2e-2)
    ordered = mixing.training_order(mixing.plan(docs, schedule)).collect()
    found = [r.position for r in ordered if r.position is not None]
    assert found == sorted(found) and all(r.position is None for r in ordered[len(found) :])


def test_mix_gives_whole_documents(planned):
    rows, docs, got = planned
    mixed = mixing.mix(docs, mixing.cycle_schedule(docs))
    assert mixed.columns == docs.columns
    want = {}
    for r in got:
        want[r.doc_id] = want.get(r.doc_id, 0) + sum(2 * c.words > r.size for c in r.copies)
    have = {}
    for r in mixed.collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + 1
    assert have == {i: n for i, n in want.items() if n}


def test_nothing_to_mix(make):
    none = make([(1, "a", "en", "s")]).where("false")
    assert mixing.plan(none, mixing.cycle_schedule(none)).collect() == []
    blank = make([(1, None, "en", "s"), (2, " ", "en", None)])
    assert [(r.target, r.taken) for r in mixing.plan(blank, mixing.cycle_schedule(blank)).collect()] == [(0.0, 0)] * 2


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack([a.ravel() for a in np.meshgrid(*[np.arange(1 << bits)] * dims)])
        index = hilbert.curve(cells, bits)
        assert sorted(index) == list(range(1 << bits * dims))
        steps = np.abs(np.diff(cells[:, np.argsort(index)])).sum(axis=0)
        assert (steps == 1).all()


def test_shards_are_even_runs_of_the_curve(make, odd_texts):
    rng = random.Random(2)
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for i, t in enumerate(odd_texts * 7)]
    rows += [rows[0], (None, "x", None, None)]
    docs = make(rows).withColumn("curve", F.lit(1)).withColumn("size", F.lit("old"))
    for shards in (24, 5, 200):
        got = hilbert.shard_documents(docs, shards).collect()
        assert len(got) == len(rows)
        groups = {}
        for r in got:
            groups.setdefault(r.shard, []).append(r)
        counts = [len(groups.get(s, [])) for s in range(shards)]
        assert max(counts) - min(counts) <= 1 and set(groups) <= set(range(shards))
        assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in groups.values())
        ordered = sorted(got, key=lambda r: (r.shard, r.slot))
        keys = [(r.curve, r.text_crc32) for r in ordered]
        assert keys == sorted(keys)
    texts = {i: t or "" for i, t, *_ in rows}
    for r in got:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 8, zlib.crc32(texts[r.doc_id].encode()))
    assert hilbert.shard_documents(docs.where("false")).collect() == []


def test_place_keeps_rows_and_copies(make):
    rows = [(1, "a", "en", "s"), (1, "a", "en", "s"), (2, None, None, None), (1, "other", "en", "s")]
    placed = hilbert.place(make(rows).withColumn("shard", F.lit("old")), 3)
    assert placed.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    got = placed.collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(r[0]), str(r[1])) for r in rows)
    assert len({(r.shard, r.slot) for r in got}) == 4
    found = {r.shard: (r.min_doc_id, r.max_doc_id) for r in hilbert.ranges(placed, ["doc_id"]).collect()}
    assert set(found) == {r.shard for r in got}


def test_running_totals_with_one_hot_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", (F.col("id") % 7).alias("v"))
    got = ranked(rows, ["k", "id"], "v").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(5000))
    assert [r.before for r in got] == [0, *np.cumsum([r.v for r in got])[:-1]]
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_shards_can_be_skipped_by_every_dimension(make):
    """Share of shards that a reader of one language, one source or a range of sizes cannot skip."""
    rng = random.Random(12)
    langs, sources = ["en"] * 6 + ["de", "es", "fr"], [f"src{i}" for i in range(20)] + ["src3"] * 10
    rows = [(i, "x" * int(rng.lognormvariate(6, 1.3)), rng.choice(langs), rng.choice(sources)) for i in range(3000)]
    placed = hilbert.place(make(rows))
    sized = placed.withColumn("length", F.octet_length("text"))
    spans = hilbert.ranges(sized, ["lang", "source", "length"]).collect()
    read = lambda c, low, high: sum(r[f"min_{c}"] <= high and low <= r[f"max_{c}"] for r in spans) / len(spans)
    by_lang = {x: read("lang", x, x) for x in ("de", "en", "es", "fr")}
    by_source = [read("source", x, x) for x in sorted(set(sources))]
    lengths = sorted(len(r[1]) for r in rows)
    by_size = [read("length", lengths[i * 300], lengths[i * 300 + 299]) for i in range(10)]
    assert max(by_lang[x] for x in ("de", "es", "fr")) <= 0.35 and by_lang["en"] <= 0.8
    assert np.mean(by_source) <= 0.5 and np.mean(by_size) <= 0.5
