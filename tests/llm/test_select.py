import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.llm import divergence, quality, textstats, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the of and to in a is that for it was on are with mountain river story garden people window letter".split()


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    held = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            held.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(held))


def js(p, q):
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt((part(p) + part(q)) / 2)


def prose(rng, n):
    return " ".join(rng.choice(PROSE) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def mixed(make, odd_texts):
    rng = random.Random(4)
    rows = [(i, t, "en") for i, t in enumerate(odd_texts[:8] + odd_texts[9:])]
    rows += [(100 + i, prose(rng, rng.randint(60, 200)), "en") for i in range(60)]
    rows += [(200 + i, re.sub(r"(\w+)", r"\1$$$***", prose(rng, 120)), "en") for i in range(4)]
    rows += [(300 + i, prose(rng, 40), None) for i in range(2)] + [(400, "x y z w v u " * 20, "en")]
    rows += [(100, rows[9][1], "en"), (None, prose(rng, 80), "de")]
    return rows


def test_base_counts_equal_brute_force(make, mixed):
    got = divergence.judge(make(mixed).withColumn("n_words", F.lit(7))).collect()
    assert len(got) == len(mixed)
    want = {i: brute_counts(t) for i, t, _ in mixed}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in got:
        assert tuple(r[n] for n in names) == want[r.doc_id]
        n, repeats = r.n_words, r.n_repeat_words
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (r.kept and r.base_failed)


def test_divergent_documents_go_and_prose_stays(make, mixed):
    got = divergence.judge(make(mixed)).collect()
    verdict = {r.doc_id: r for r in got}
    assert all(verdict[100 + i].kept for i in range(60)) and not any(verdict[200 + i].kept for i in range(4))
    assert all(r.char_distance is None for r in got if r.n_words < divergence.MIN_WORDS)
    texts = {i: t for i, t, lang in mixed if lang == "en" and t}
    passing = [r.doc_id for r in got if not r.base_failed and r.doc_id in texts]

    def classes(text):
        return [sum(textstats.CLASSES[textstats._CLASS[c.encode()[0]]] == k for c in text) for k in textstats.CLASSES]

    sums = np.sum([classes(texts[i]) for i in passing], axis=0)
    for i in (100, 101, 200):
        assert verdict[i].char_distance == pytest.approx(js(classes(texts[i]), sums), abs=1e-9)


def test_no_documents(make):
    assert divergence.judge(make([(1, "a")]).where("false")).collect() == []


def test_trees_learn_a_step_and_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 6))
    y = ((x[:, 1] > 0.3) ^ (x[:, 4] > 0.6)).astype(float)
    model = quality.fit_trees(x[:3000], y[:3000])
    p = quality.score_trees(model, x[3000:])
    assert ((p > 0.5) == y[3000:]).mean() > 0.97
    one = np.array([walk(model, row) for row in x[3000:3050]])
    assert p[:50] == pytest.approx(one)
    assert quality.score_trees(quality.fit_trees(x[:10], np.ones(10)), x[:3]).tolist() == [1, 1, 1]
    assert quality.score_trees(quality.fit_trees(x[:0], y[:0]), x[:2]).tolist() == [0.5, 0.5]


def walk(model, row):
    raw = model["start"]
    for feature, threshold, leaf in zip(model["feature"], model["threshold"], model["leaf"]):
        at = 0
        for _ in range(model["depth"]):
            at = 2 * at + 1 + int(row[feature[at]] > threshold[at])
        raw += leaf[at - (2 ** model["depth"] - 1)]
    return 1 / (1 + math.exp(-raw))


@pytest.fixture(scope="module")
def judged(spark, make):
    """Documents with quality and toxicity labels."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        text = prose(rng, rng.randint(20, 120))
        bad, toxic = i % 4 == 0, i % 5 == 1
        if toxic:
            text = text.replace("river", rng.choice(["Nasty", "vile,"]), 2) + " nasty"
        rows.append((i, re.sub(r"(\w+)", r"\1%%%", text) if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(None, "the river"), (700, None), (701, ""), (5, rows[5][1])]
    labels += [(None, 1, 1), (3, None, None), (7, 1, 0), (9999, 0, 1)]
    return make(rows).withColumn("score", F.lit("old")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(judged):
    docs, labels = judged
    got = quality.classify(docs, labels).select("doc_id", "score", quality.held_out(F.col("doc_id")).alias("h")).collect()
    assert len(got) == 604 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.h and r.doc_id is not None and r.doc_id < 600]
    assert {r.doc_id for r in held} >= {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 4 != 0) for r in held]) > 0.95
    again = quality.classify(docs.repartition(5), labels).select("doc_id", "score").collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in got}


def test_held_out_labels_are_not_used(judged):
    _, labels = judged
    used = {r.doc_id for r in quality.labelled(labels).collect()}
    assert used and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in used)
    assert quality.drawn(quality.labelled(labels), 10**6).count() == len(used)
    assert quality.drawn(quality.labelled(labels), 100).count() < 150


def test_without_labels(judged):
    docs, labels = judged
    none = labels.where("false")
    assert {r.score for r in quality.classify(docs, none).select("score").collect()} == {0.5}
    rated = toxicity.rate_documents(docs, none).select("toxic").collect()
    assert {r.toxic for r in rated} == {0.0} and len(rated) == 604


def test_toxicity_chain_on_held_out_rows(judged):
    docs, labels = judged
    got = toxicity.rate_documents(docs, labels).select("doc_id", "toxic", "low_quality", "toxic_prose").collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.toxic >= toxicity.THRESHOLD) == (r.doc_id % 5 == 1) for r in held]) > 0.95
    assert all(r.toxic < toxicity.THRESHOLD for r in got if r.doc_id in (700, 701))


def test_later_models_train_on_out_of_fold_probabilities(monkeypatch):
    rng = np.random.default_rng(1)
    n = 120
    doc, bins = np.repeat(np.arange(n), 3), rng.integers(0, 50, 3 * n)
    y = np.stack([rng.random(n) < 0.5, rng.random(n) < 0.4], axis=1).astype(float)
    fold = np.arange(n) % toxicity.FOLDS
    seen = []
    real = toxicity.fit_linear

    def spy(doc, bin_, extra, target, rows, chosen=None):
        seen.append((extra.copy(), rows.copy()))
        return real(doc, bin_, extra, target, rows, chosen)

    monkeypatch.setattr(toxicity, "fit_linear", spy)
    models = toxicity.fit_chain(doc, bins, y, fold)
    extra = seen[-1][0]
    for f in range(toxicity.FOLDS):
        part = real(doc, bins, np.zeros((n, 0)), y[:, 0], fold != f)
        p = toxicity.apply_linear(part, doc, bins, np.zeros((n, 0)))
        assert extra[fold == f, 0] == pytest.approx(p[fold == f])
    assert len(models) == 2 and toxicity.apply_chain(models, doc, bins, n).shape == (n, 2)


def brute_columns(rows, y):
    """The columns whose shares among positive and negative rows differ most, by plain counting."""
    n, positive = len(rows), sum(y)
    score = {}
    for bin_ in set().union(*rows):
        total = sum(bin_ in r for r in rows)
        pos = sum(t for r, t in zip(rows, y) if bin_ in r)
        share = total / n
        score[bin_] = abs(pos / positive - (total - pos) / (n - positive)) / np.sqrt(share * (1 - share) + 1 / n)
    return score


def test_chain_equals_brute_force(spark, judged, monkeypatch):
    """Columns picked in Spark are those of a plain count, and the models are those of all columns of the whole sample
    on the driver; scores are those of a walk over the words; a null label leaves its row out of one category only."""
    docs, labels = judged
    labels = labels.withColumn("quality", F.when(F.col("doc_id") % 7 != 0, F.col("quality")))
    sample = toxicity.hashed_sample(docs, labels)
    rows = sample.orderBy("doc_id").collect()
    assert any(r.y[0] is None and r.y[1] is not None for r in rows)
    chosen = toxicity.choose(sample, 3)
    for (k, left), columns in chosen.items():
        held = [r for r in rows if r.y[k] is not None and r.fold != left]
        score = brute_columns([set(r.bins) for r in held], [r.y[k] for r in held])
        assert len(columns) == min(toxicity.KEPT, len(score)) and len(set(columns)) == len(columns)
        floor = sorted(score.values(), reverse=True)[len(columns) - 1]
        assert all(score[c] >= floor - 1e-9 for c in columns.tolist())
    doc = np.repeat(np.arange(len(rows)), [len(r.bins) for r in rows])
    bins = np.array([b for r in rows for b in r.bins])
    y = np.array([[np.nan if v is None else v for v in r.y] for r in rows])
    want = toxicity.fit_chain(doc, bins, y, np.array([r.fold for r in rows]), chosen)
    got = toxicity.fit(docs, labels)
    for a, b in zip(got, want):
        assert a["share"] == b["share"] and np.array_equal(a["ids"], b["ids"]) and a["weights"] == pytest.approx(b["weights"], abs=1e-9)
    rated = {(r.doc_id, r.text): (r.low_quality, r.toxic, r.toxic_prose) for r in toxicity.score(docs, got, ["low_quality", "toxic", "toxic_prose"]).collect()}
    for (_, text), found in list(rated.items())[::40]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        known = set(toxicity.hashed_words(pa.array([" ".join(words)]))[1].tolist())
        seen = []
        for model in got:
            weight = dict(zip(model["ids"].tolist(), model["weights"]))
            raw = sum(w for b, w in weight.items() if b in known)
            raw += sum(p * w for p, w in zip(seen, model["weights"][len(model["ids"]) :])) + model["weights"][-1]
            seen.append(1 / (1 + np.exp(-raw)))
        assert found == pytest.approx(seen, abs=1e-9)


def grown(x, y, p, rows, depth, cuts):
    """A tree as nested (feature, cut, left, right) or a leaf value, by trying every cut of every feature."""
    g, h = p - y, p * (1 - p)
    value = lambda r: g[r].sum() ** 2 / (h[r].sum() + quality.L2)
    best = (1e-9, None)
    if depth:
        for f, cut in ((f, c) for f in range(x.shape[1]) for c in cuts[f]):
            left = rows & (x[:, f] <= cut)
            if min(h[left].sum(), h[rows & ~left].sum()) < quality.MIN_WEIGHT:
                continue
            gain = value(left) + value(rows & ~left) - value(rows)
            if gain > best[0] + 1e-9:
                best = (gain, (f, cut))
    if best[1] is None:
        return -quality.RATE * g[rows].sum() / (h[rows].sum() + quality.L2)
    f, cut = best[1]
    left = rows & (x[:, f] <= cut)
    return f, cut, grown(x, y, p, left, depth - 1, cuts), grown(x, y, p, rows & ~left, depth - 1, cuts)


def test_first_tree_equals_a_plain_split_search():
    rng = np.random.default_rng(21)
    x = np.round(rng.normal(size=(300, 5)), 2)
    y = ((x[:, 1] + 0.5 * x[:, 3] * (x[:, 0] > 0) + rng.normal(0, 0.4, 300)) > 0).astype(float)
    model = quality.fit_trees(x, y, trees=1, depth=3)
    tree = grown(x, y, np.full(300, y.mean()), np.ones(300, bool), 3, quality.bin_edges(x))

    def walk(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    raw = np.log(y.mean() / (1 - y.mean())) + np.array([walk(tree, row) for row in x])
    assert quality.score_trees(model, x) == pytest.approx(1 / (1 + np.exp(-raw)), abs=1e-9)
