import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.functions import blocks
from gleanery.operators import concepts, genres, lsa, postings, search, terms
from gleanery.operators import search as search_module
from gleanery.sinks.model_store import load_model, model_path, save_model

SCHEMA = "doc_id long, title string, genre string, tokens array<string>"


@pytest.fixture(scope="module")
def small(spark):
    lists = [["alpha", "alpha", "beta", "rare"], ["beta", "gamma"], ["alpha", "gamma", "gamma"], []]
    return spark.createDataFrame(
        [(i, f"t{i}", f"g{i}, x", t) for i, t in enumerate(lists)], SCHEMA
    )


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i:02d}" for i in range(30)]
    chance = 1.0 / np.arange(1, 31)
    rows = [
        (i, f"t{i}", "g", list(rng.choice(words, size=rng.integers(0, 40), p=chance / chance.sum())))
        for i in range(200)
    ]
    rows = [(i, t, g, [str(w) for w in ws]) for i, t, g, ws in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def matrix_of(corpus, vocab):
    lists = {r.doc_id: r.tokens for r in corpus.collect()}
    out = np.zeros((len(lists), len(vocab.terms)))
    for d, ws in lists.items():
        for j, (term, idf) in enumerate(zip(vocab.terms, vocab.idfs)):
            if ws:
                out[d, j] = idf * ws.count(term) / len(ws)
    return out


def hits_of(df):
    return [
        (r.query_id, r["rank"], r.doc_id, r.score)
        for r in df.orderBy("query_id", "rank").collect()
    ]


def queries_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def test_singular_values_and_energy(small):
    model = lsa.fit_lsa(small, 3, 3)
    assert model.sigmas() == pytest.approx([0.66906548, 0.34657359, 0.29920652], abs=1e-8)
    report = lsa.singular_value_report(model)
    assert report.agg(F.sum("energy")).first()[0] == pytest.approx(0.65728641, abs=1e-8)


def test_keyword_scores(spark, small):
    queries = queries_of(spark, "alpha gamma", "alpha alpha gamma", "zzz")
    full = {
        (q, d): s for q, _, d, s in hits_of(search.search(lsa.fit_lsa(small, 3, 3), queries))
    }
    assert [full[0, d] for d in range(4)] == pytest.approx([0.240227, 0.240227, 0.480453, 0], abs=1e-6)
    log2 = np.log(2)
    assert full[1, 0] == pytest.approx(2 * log2 * 0.346574, abs=1e-5)
    cut = {(q, d): s for q, _, d, s in hits_of(search.search(lsa.fit_lsa(small, 3, 2), queries))}
    assert [cut[0, d] for d in range(4)] == pytest.approx([0.276258, 0.312289, 0.399130, 0], abs=1e-6)


def test_ties_and_unknown_queries_prefer_larger_ids(spark, small):
    hits = hits_of(search.search(lsa.fit_lsa(small, 3, 3), queries_of(spark, "alpha gamma", "zzz"), 2))
    assert [(q, r, d) for q, r, d, _ in hits] == [(0, 1, 2), (0, 2, 1), (1, 1, 3), (1, 2, 2)]


def test_svd_matches_numpy(corpus):
    vocab = terms.collect_vocabulary(corpus, 20)
    a = matrix_of(corpus, vocab)
    model = lsa.fit_lsa(corpus, 20, 6)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert model.sigmas() == pytest.approx(s[:6], abs=1e-9)
    v = np.array([r.v for r in model.term_factors.orderBy("term_id").collect()])
    assert v.T @ v == pytest.approx(np.eye(6), abs=1e-9)
    us = np.array([r.us for r in model.doc_factors.orderBy("doc_id").collect()])
    assert us == pytest.approx(a @ v, abs=1e-12)
    assert np.all(v[np.abs(v).argmax(axis=0), np.arange(6)] > 0)


def test_matrices_in_blocks_agree(spark, corpus, monkeypatch):
    queries = queries_of(spark, "w00 w03", "w05 w19")
    vocab = terms.collect_vocabulary(corpus, 20)
    rows = terms.sparse_rows(terms.tfidf_vectors(corpus, vocab))
    model = lsa.fit_lsa(corpus, 20, 5)
    v = np.array([r.v for r in model.term_factors.orderBy("term_id").collect()])

    def results():
        exact = hits_of(postings.exact_search(rows, vocab, queries))
        us = blocks.project_rows(rows, v, ["doc_id"], "us").orderBy("doc_id").collect()
        return exact, [r.us for r in us]

    whole = results()
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 8 * 20 * 2)
    parts = results()
    assert parts[0] == whole[0]
    assert np.array(parts[1]) == pytest.approx(np.array(whole[1]), abs=1e-12)


def test_small_scores_keep_their_order(spark):
    docs = spark.createDataFrame([(i, [s]) for i, s in ((1, 3e-11), (2, 1e-11), (3, 2e-11), (4, 0.0))], "doc_id long, us array<double>")
    best = blocks.top_rows(docs, np.eye(1), 3, "doc_id", ["doc_id"], vector="us").orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in best] == [(1, 3e-11), (3, 2e-11), (2, 1e-11)]
    noisy = np.array([0.1 + 0.2, 0.3, -0.3, 0.0, 1e300, 5e-300])
    assert blocks.leading_digits(noisy).tolist() == [0.3, 0.3, -0.3, 0.0, 1e300, 5e-300]


def test_rank_one_matrix_yields_one_concept(spark):
    docs = spark.createDataFrame(
        [(0, "a", "g", ["x", "y"]), (1, "b", "g", ["x", "y"]), (2, "c", "g", [])], SCHEMA
    )
    model = lsa.fit_lsa(docs, 2, 2)
    assert model.k == 1
    assert len(model.doc_factors.first().us) == 1


def test_concepts(corpus):
    model = lsa.fit_lsa(corpus, 20, 4)
    v = {r.term: r.v for r in model.term_factors.collect()}
    sigma = model.sigmas()
    us = {r.doc_id: r.us for r in model.doc_factors.collect()}
    found = concepts.concept_terms(model, 5).orderBy("concept", "rank").collect()
    for c in range(4):
        want = sorted(v, key=lambda t: -v[t][c])[:5]
        assert [r.term for r in found if r.concept == c] == want
        best = sorted(us, key=lambda d: (round(us[d][c] / sigma[c], 10), d), reverse=True)[:7]
        docs = concepts.concept_docs(model, 7).filter(F.col("concept") == c).orderBy("rank")
        assert [r.doc_id for r in docs.collect()] == best
    by_size = concepts.concept_terms(model, 5, by="abs").filter("concept = 1").orderBy("rank")
    assert [r.term for r in by_size.collect()] == sorted(v, key=lambda t: -abs(v[t][1]))[:5]
    assert {r.concept for r in concepts.concept_report(model, 3, shown=2).collect()} == {0, 1}
    names = concepts.concept_names(concepts.concept_report(model, 3)).collect()
    assert len(names) == 8 and all(len(r.names.split(", ")) == 3 for r in names)


def test_search_matches_brute_force_on_any_partitioning(spark, corpus):
    vocab = terms.collect_vocabulary(corpus, 20)
    a = matrix_of(corpus, vocab)
    queries = queries_of(spark, "w00 w03", "w05 w05 w19 nothing", "")
    weight = np.zeros((20, 3))
    for q, text in enumerate(["w00 w03", "w05 w05 w19"]):
        for term in text.split():
            weight[vocab.terms.index(term), q] += vocab.idfs[vocab.terms.index(term)]
    scores = np.round(a @ weight, 10)
    want = [
        (q, rank + 1, d)
        for q in range(3)
        for rank, d in enumerate(sorted(range(200), key=lambda d: (-scores[d, q], -d))[:10])
    ]
    for parts in (1, 7):
        rows = terms.sparse_rows(terms.tfidf_vectors(corpus.repartition(parts), vocab))
        hits = hits_of(postings.exact_search(rows, vocab, queries))
        assert [h[:3] for h in hits] == want
        full = hits_of(search.search(lsa.fit_lsa(corpus.repartition(parts), 20, 20), queries))
        assert [h[:3] for h in full] == want


def test_many_query_blocks_agree_with_one(spark, corpus, monkeypatch):
    model = lsa.fit_lsa(corpus, 20, 5)
    queries = queries_of(spark, *[f"w{i:02d} w{i + 1:02d}" for i in range(9)])
    one = hits_of(search.search(model, queries, 4))
    monkeypatch.setattr(search_module, "MAX_QUERY_BLOCK_BYTES", 2 * 8 * 5)
    assert hits_of(search.search(model, queries, 4)) == one


def test_small_chunks_and_batches_agree(spark, corpus, monkeypatch):
    vocab = terms.collect_vocabulary(corpus, 20)
    a = matrix_of(corpus, vocab)
    ids, weights = [], []
    import pyarrow as pa

    for row in a:
        ids.append(np.flatnonzero(row).tolist())
        weights.append(row[np.flatnonzero(row)].tolist())
    m = np.arange(60.0).reshape(20, 3)
    monkeypatch.setattr(blocks, "_MAX_WORK_CELLS", 6)
    got = blocks.sparse_product(
        pa.array(ids, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float64())), m
    )
    assert got == pytest.approx(a @ m)
    sliced = blocks.sparse_product(
        pa.array(ids, pa.list_(pa.int32()))[50:90],
        pa.array(weights, pa.list_(pa.float64()))[50:90], m,
    )
    assert sliced == pytest.approx((a @ m)[50:90])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        model = lsa.fit_lsa(corpus.coalesce(1), 20, 3)
        small_batches = hits_of(search.search(model, queries_of(spark, "w01"), 10))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    model = lsa.fit_lsa(corpus.coalesce(1), 20, 3)
    large_batches = hits_of(search.search(model, queries_of(spark, "w01"), 10))
    # The iterative SVD sums the rows of a partition in other groups.
    assert [h[:3] for h in large_batches] == [h[:3] for h in small_batches]
    assert [h[3] for h in large_batches] == pytest.approx([h[3] for h in small_batches], rel=1e-6)


def test_model_round_trip(spark, small, tmp_path):
    docs = small.repartition(4, "doc_id")
    model = lsa.fit_lsa(docs, 3, 2)
    path = model_path(str(tmp_path), "pattern", 3, 2)
    assert path.endswith("pattern/model_terms3_k2")
    save_model(model, path)
    queries = search.parse_queries(spark, " alpha gamma, ,BETA ")
    assert queries.count() == 2
    before, after = search.search(model, queries), search.search(load_model(spark, path), queries)
    assert hits_of(before) == hits_of(after)
    assert {r.title for r in after.collect()} == {"t0", "t1", "t2", "t3"}
    with pytest.raises(Exception):
        save_model(model, path)


def test_incomplete_model_is_refused(spark, small, tmp_path):
    path = str(tmp_path / "model")
    save_model(lsa.fit_lsa(small, 3, 2), path)
    spark.createDataFrame([(4, 3, 9)], "num_docs long, num_terms int, k int").write.mode(
        "overwrite"
    ).parquet(f"{path}/meta")
    with pytest.raises(ValueError, match="concepts"):
        load_model(spark, path)
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "nowhere"))
    damaged = str(tmp_path / "damaged")
    save_model(lsa.fit_lsa(small, 3, 2), damaged)
    left = small.sparkSession.createDataFrame(load_model(spark, damaged).doc_factors.collect()[:1])
    left.write.mode("overwrite").parquet(f"{damaged}/doc_factors")
    with pytest.raises(ValueError, match="1 documents"):
        load_model(spark, damaged)


def test_genres(spark):
    docs = spark.createDataFrame(
        [(1, "Same", "old"), (2, "Same", "new"), (3, "Other", "a, b ,c,d,e,f"), (4, "War", "drama / war")],
        "doc_id long, title string, genre string",
    )
    by_title = genres.genre_by_title(docs)
    assert {r.title: r.genre for r in by_title.collect()}["Same"] == "new"
    hits = spark.createDataFrame([(1, "Same"), (9, "Gone")], "doc_id long, title string")
    assert {r.title: r.genre for r in genres.with_genres(hits, by_title).collect()} == {
        "Same": "new", "Gone": "Unknown",
    }
    titled = genres.with_titles(hits.select("doc_id"), docs)
    assert {r.doc_id: r.title for r in titled.collect()} == {1: "Same", 9: "unknown"}
    first = {r.doc_id: r.genres for r in genres.first_genres(docs).collect()}
    assert first[3] == ["a", "b", "c", "d", "e"] and first[4] == ["drama / war"]


def test_top_n_is_pruned_before_the_shuffle(spark, small):
    hits = search.search(lsa.fit_lsa(small, 3, 2), queries_of(spark, "alpha"), 2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_u_is_orthonormal_and_solvers_agree(corpus):
    one, other = lsa.fit_lsa(corpus, 20, 5), lsa.fit_lsa(corpus, 20, 5, solver="gram")
    assert one.sigmas() == pytest.approx(other.sigmas(), abs=1e-9)
    for model in (one, other):
        assert np.abs(lsa.factor_gram(model) - np.eye(5)).max() < 1e-9
        for r in model.doc_factors.collect():
            assert np.array(r.us) == pytest.approx(np.array(r.u) * model.sigmas(), abs=1e-12)
    with pytest.raises(ValueError):
        lsa.fit_lsa(corpus, 20, 5, solver="other")


def test_decoded_rows_are_released(spark, corpus):
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size
    before = held()
    lsa.fit_lsa(corpus, 20, 3)
    assert held() == before


def test_corpus_without_terms(spark, tmp_path):
    docs = spark.createDataFrame([(1, "t", []), (2, "u", [])], "doc_id long, title string, tokens array<string>")
    model = lsa.fit_lsa(docs, 5, 3)
    assert (model.k, model.num_terms, model.num_docs) == (0, 0, 2)
    assert [(r.u, r.us) for r in model.doc_factors.collect()] == [([], [])] * 2
    assert concepts.concept_terms(model).count() == 0 and model.sigmas().tolist() == []
    save_model(model, str(tmp_path / "none"))
    assert load_model(spark, str(tmp_path / "none")).k == 0


def test_lost_job_leaves_no_model(spark, small, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    model, path = lsa.fit_lsa(small, 3, 2), str(tmp_path / "models" / "m")
    write, calls = DataFrameWriter.parquet, []

    def third_fails(self, where, *args, **kwargs):
        calls.append(where)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return write(self, where, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", third_fails)
    with pytest.raises(RuntimeError):
        save_model(model, path)
    monkeypatch.undo()
    assert list((tmp_path / "models").iterdir()) == []
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    # What an older version left half done does not block the place.
    model.singular_values.write.parquet(f"{path}/singular_values")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    save_model(model, path)
    assert load_model(spark, path).k == 2
    with pytest.raises(FileExistsError):
        save_model(model, path)
    save_model(lsa.fit_lsa(small, 3, 1), path, mode="overwrite")
    assert load_model(spark, path).k == 1 and [p.name for p in (tmp_path / "models").iterdir()] == ["m"]


def test_catalogue(spark, small, tmp_path):
    from gleanery.sinks import catalogue

    root = str(tmp_path / "catalogue")
    docs = small.withColumn("title", F.lit("t"))
    for variant, k in (("pattern", 1), ("pattern", 2), ("lemma", 2)):
        catalogue.add_model(lsa.fit_lsa(docs, 3, k), root, variant, 3, k, (k, 1.0, 0.5, 2.0, 1.0))
    catalogue.add_model(lsa.fit_lsa(docs, 2, 2), root, "pattern", 3, 2, (2, 1.0, 0.75, 2.0, 1.0))
    runs = {(r.variant, r.num_terms, r.k): r.share for r in catalogue.runs(spark, root).collect()}
    assert runs == {("pattern", 3, 1): 0.5, ("pattern", 3, 2): 0.75, ("lemma", 3, 2): 0.5}
    factors = catalogue.read_models(spark, root, "doc_factors")
    assert factors.groupBy("variant", "k").count().count() == 3
    one = factors.where("variant = 'lemma' AND k = 2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "variant" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == small.count() and "doc_factors" in factors.inputFiles()[0]
    model = catalogue.load_from(spark, root, "pattern", 3, 2)
    assert (model.num_terms, model.k) == (2, 2) and "u" in model.doc_factors.columns
    with pytest.raises(FileNotFoundError):
        catalogue.load_from(spark, root, "lemma", 3, 1)


def test_postings_skip_blocks(spark):
    """Blocks that cannot reach the top n are not read, and the hits are those of all documents."""
    rng = np.random.default_rng(8)
    weights = [(d, t, float(rng.pareto(1.2) + 0.01) * (0.01 if d % 7 else 1.0)) for d in range(400) for t in range(12) if rng.random() < 0.4]
    rows = spark.createDataFrame(weights, "doc_id long, term_id int, weight double").repartition(5)
    docs = spark.createDataFrame([(d, f"t{d % 5}") for d in range(403)], "doc_id long, title string")
    vocab = spark.createDataFrame([(t, f"w{t:02d}", 0.5 + t / 10) for t in range(12)], "term_id int, term string, idf double")
    asked = ["w03", "w01 w07", "w02 w02 w11 w05", "unknown", "w09 unknown w09", ""]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    for block_docs in (4096, 30):
        blocks_ = postings.build_postings(rows, 403, block_docs).cache()
        values = search.known_terms(queries, vocab)
        needed = postings.needed_blocks(blocks_, values, 5)
        every = values.join(blocks_.select("term_id", "level").distinct(), "term_id")
        assert needed.where("query_id = 0").count() < every.where("query_id = 0").count() / 3
        assert needed.count() < every.count()
        found = postings.search_postings(blocks_, docs, vocab, queries, 5).orderBy("query_id", "rank").collect()
        for q, text in enumerate(asked):
            scores = {d: 0.0 for d in range(403)}
            for word in text.split():
                for d, t, w in weights:
                    if word == f"w{t:02d}":
                        scores[d] += (0.5 + t / 10) * w
            want = sorted(scores, key=lambda d: (round(scores[d], 9), d), reverse=True)[:5]
            hits = [r for r in found if r.query_id == q]
            assert [r.doc_id for r in hits] == want and [r.rank for r in hits] == [1, 2, 3, 4, 5]
            assert [r.score for r in hits] == pytest.approx([scores[d] for d in want]) and hits[0].title == f"t{want[0] % 5}"
        blocks_.unpersist()
