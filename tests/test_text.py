import math

import pytest
from pyspark.sql import functions as F

from gleanery.functions import dictionary
from gleanery.operators import lemmas, terms, tokens

SCHEMA = "doc_id long, title string, text string"


def docs_of(spark, *texts):
    return spark.createDataFrame([(i, f"t{i}", t) for i, t in enumerate(texts)], SCHEMA)


def token_lists(df):
    return [r["tokens"] for r in df.orderBy("doc_id").collect()]


def test_pattern_tokenizer(spark):
    docs = docs_of(
        spark,
        "  Serious incident, against serious -3,5 1.2.3 x-ray_scan 42 100 word",
        "",
        None,
        "a" * 24 + " " + "b" * 25 + "\tÜberall \r\nNumber7 -1,234 12,",
    )
    assert token_lists(tokens.tokenize_pattern(docs, ["against"])) == [
        ["serious", "serious", "-3,5", "x-ray_scan", "100"],
        [],
        [],
        ["a" * 24, "-1,234"],
    ]


def test_letters_only_lemmas(spark):
    docs = docs_of(spark, "León l3 ab the dogs' don't x-ray running. Dogs!", "", None)
    table = spark.createDataFrame(
        [("dogs", "dog"), ("running", "run"), ("unused", "x")], "token string, lemma string"
    )
    found = token_lists(tokens.tokenize_lemma(docs, ["the"], table))
    assert sorted(found[0]) == ["dog", "dog", "león", "run"]
    assert found[1:] == [[], []]


def test_stop_words_as_a_table(spark):
    docs = docs_of(spark, "serious matter against matter", "against", "matter 123")
    words = spark.createDataFrame([("against",), ("123",)], "word string")
    listed = token_lists(tokens.tokenize_pattern(docs, ["against", "123"]))
    assert token_lists(tokens.tokenize_pattern(docs, words)) == listed
    assert listed == [["serious", "matter", "matter"], [], ["matter"]]


def test_dictionary_of_any_size_keeps_order_and_rows(spark):
    """One shard or many: the same lists in the order of the text."""
    docs = docs_of(spark, "zetas and dogs cats zetas", "", None, "cats cats").withColumn("genre", F.lit("g"))
    docs = docs.unionAll(docs.where("doc_id = 0"))
    pairs = [("dogs", "cats"), ("cats", "cat"), ("zetas", "zeta"), ("unused", "x"), ("and", None)]
    table = spark.createDataFrame(pairs, "token string, lemma string")
    surface = docs.select("doc_id", "genre", tokens.surface_tokens(F.col("text")).alias("tokens"))
    want = ["zeta cats cat zeta", "zeta cats cat zeta", "", "", "cat cat"]
    for shard_tokens in (1 << 20, 3, 1):
        coded = dictionary.code_tokens(surface, shard_tokens)
        found = dictionary.decode_tokens(coded, tokens._replaced(coded.words, table))
        assert found.columns == ["doc_id", "genre", "tokens"]
        assert [" ".join(r.tokens) for r in found.orderBy("doc_id").collect()] == want
    lemmas = tokens.tokenize_lemma(docs, ["and"], table)
    assert [" ".join(r.tokens) for r in lemmas.orderBy("doc_id").collect()] == want
    unchanged = tokens.look_up(surface, table.limit(0)).orderBy("doc_id").collect()
    assert unchanged[4].tokens == ["cats", "cats"]


def test_annotator_runs_once_per_task(spark):
    def factory():
        return lambda text: [w.rstrip("s") for w in text.split()]

    docs = docs_of(spark, "Dogs chase the Cats ab x1x", None)
    assert token_lists(tokens.tokenize_annotator(docs, ["the"], factory)) == [
        ["dog", "chase", "cat"],
        [],
    ]


def test_derived_lemmas(spark):
    words = "church churches city cities walk walks walked walking make making was glass pass sing bus"
    table = spark.createDataFrame([(w,) for w in words.split()], "token string")
    assert {r.token: r.lemma for r in lemmas.derive_lemmas(table).collect()} == {
        "churches": "church", "cities": "city", "walks": "walk", "walked": "walk",
        "walking": "walk", "making": "make", "was": "be",
    }


def test_sentence_counts(spark):
    docs = docs_of(spark, "One. Two! Three?  Four", "", "no mark", "3.5 stays. end.", None)
    rows = tokens.sentence_counts(docs).orderBy("doc_id").collect()
    assert [r.sentences for r in rows][:4] == [4, 0, 1, 2]


@pytest.fixture(scope="module")
def small(spark):
    lists = [["alpha", "alpha", "beta", "rare"], ["beta", "gamma"], ["alpha", "gamma", "gamma"], []]
    return spark.createDataFrame(
        [(i, f"t{i}", t) for i, t in enumerate(lists)],
        "doc_id long, title string, tokens array<string>",
    )


def test_frequencies(small):
    tf = {(r.doc_id, r.term): (r.tf, r.doc_len) for r in terms.term_frequencies(small).collect()}
    assert tf[0, "alpha"] == (2, 4) and tf[2, "gamma"] == (2, 3) and len(tf) == 7
    df = {r.term: r.df for r in terms.document_frequencies(small).collect()}
    assert df == {"alpha": 2, "beta": 2, "gamma": 2, "rare": 1}
    assert [r.doc_len for r in terms.document_lengths(small).orderBy("doc_id").collect()] == [4, 2, 3, 0]


def test_vocabulary(small):
    rows = terms.vocabulary(small, 3).orderBy("term_id").collect()
    assert [(r.term_id, r.term, r.df) for r in rows] == [
        (0, "alpha", 2), (1, "beta", 2), (2, "gamma", 2),
    ]
    assert all(r.idf == pytest.approx(math.log(2)) for r in rows)
    assert terms.collect_vocabulary(small, 2).terms == ["alpha", "beta"]


EXPECTED = {
    (0, 0): 0.346574, (0, 1): 0.173287, (1, 1): 0.346574, (1, 2): 0.346574,
    (2, 0): 0.231049, (2, 2): 0.462098,
}


def test_weights_by_vectors_and_by_join(small):
    by_vector = terms.tfidf_weights(small, 3)
    by_join = terms.join_weights(terms.term_frequencies(small), terms.vocabulary(small, 3))
    for table in (by_vector, by_join):
        found = {(r.doc_id, r.term_id): r.weight for r in table.collect()}
        assert found == pytest.approx(EXPECTED, abs=1e-6)


def test_empty_document_keeps_its_row(small):
    vocab = terms.collect_vocabulary(small, 3)
    rows = terms.sparse_rows(terms.tfidf_vectors(small, vocab)).orderBy("doc_id").collect()
    assert len(rows) == 4 and sum(rows[3].weights) == 0


def test_whole_weight_path_stays_off_the_shuffle(small):
    vocab = terms.collect_vocabulary(small, 3)
    plan = terms.long_weights(terms.sparse_rows(terms.tfidf_vectors(small, vocab)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_hot_token_in_every_document(spark):
    lists = spark.range(500).select(
        F.col("id").alias("doc_id"), F.array_repeat(F.lit("common"), 50).alias("tokens")
    )
    assert terms.document_frequencies(lists).collect()[0].df == 500
    assert {r.tf for r in terms.term_frequencies(lists).collect()} == {50}
