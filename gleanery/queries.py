"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.sampling import sample_by_key
from gleanery.functions.text import (
    blank_split,
    header_attribute,
    surface_tokens,
    without_words,
)
from gleanery.operators import concepts, genres, lemmas, lsa, outliers, postings, search, terms, tokens
from gleanery.plans.corpus import LEMMA, PATTERN, tokenize
from gleanery.plans.sweep import sweep_lsa
from gleanery.session import local_table, scratch_folder, spread, staged
from gleanery.sinks.exports import cluster_rows, export_samples, sample_means, sample_outliers
from gleanery.sinks.model_store import load_model, model_path, save_model
from gleanery.sources.articles import as_documents, extract_articles, parse_records, read_records
from gleanery.sources.movies import MOVIE_SCHEMA, read_movies
from gleanery.sources.sensors import (
    read_checked_runs,
    read_cluster_samples,
    read_runs,
    reading_problems,
    run_id,
)
from gleanery.sources.stopwords import read_stop_words
from gleanery.sources.tables import read_table

VOCABULARY = 500
FULL_RANK = 60
#: Concepts whose singular values lie far enough apart to be compared one by one.
LEADING = 3
SENSOR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
FEATURES = [f"z_{c}" for c in SENSOR_COLUMNS]
ROW_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
CLUSTER_COUNTS = range(2, 13)
LLOYD_PASSES = 3
SAMPLE_FRACTION = 0.2
SAMPLE_SEED = 1


def fixed_centers(k: int) -> list[tuple[float, float, float]]:
    """Start centres on a line through standardised space."""
    steps = [-1.5 + 3.0 * j / (k - 1) for j in range(k)]
    return [(s, -0.5 * s, 0.25 * s * s) for s in steps]


FIXED = {k: fixed_centers(k) for k in CLUSTER_COUNTS}


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus (doc_id, title, genre, text): the source stands for the title, the language
    for the genre."""
    table = read_table(spark, sf, "documents", spread_by="doc_id")
    return table.select(
        "doc_id", F.col("source").alias("title"), F.col("lang").alias("genre"), "text"
    )


def pattern_docs(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.tokenize_pattern(documents(spark, sf), read_stop_words(spark))


def lemma_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    surface = documents(spark, sf).select(surface_tokens(F.col("text")).alias("tokens"))
    return lemmas.derive_lemmas(staged(lemmas.distinct_tokens(surface)))


def benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    table = read_table(spark, sf, "benchmark")
    return table.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def full_rank_model(spark: SparkSession, sf: str) -> lsa.LsaModel:
    return lsa.fit_lsa(pattern_docs(spark, sf), FULL_RANK, FULL_RANK)


def reduced_model(spark: SparkSession, sf: str) -> lsa.LsaModel:
    # The vocabulary is small enough for its Gram matrix.
    return lsa.fit_lsa(pattern_docs(spark, sf), VOCABULARY, 25, solver="gram")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").select(*ROW_KEYS, *SENSOR_COLUMNS)


def points(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.standardize(readings(spark, sf), SENSOR_COLUMNS)


def row_hash(keys: list[str]) -> Column:
    return F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- sources -------------------------------------------------------------------


def article_extract(spark: SparkSession, sf: str) -> DataFrame:
    record = F.concat(
        F.lit('<doc id="'), F.col("doc_id").cast("string"), F.lit('" url="http://x/'),
        F.col("doc_id").cast("string"), F.lit('" title="'), F.col("title"), F.lit('">\n'),
        F.col("text"), F.lit("\n</doc>\n"),
    )
    untitled = F.concat(F.lit('<doc id="0" url="u" title="">\n'), F.col("text"), F.lit("\n</doc>\n"))
    hollow = F.lit('<doc id="0" url="u" title="Hollow">\n</doc>\n')
    unclosed = F.concat(F.lit('<doc id="0" url="u" title="Open">\n'), F.col("text"))
    files = documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("path"),
        F.concat(hollow, untitled, record, unclosed).alias("text"),
    )
    found = extract_articles(files)
    return found.select(
        F.col("wiki_id").cast("long").alias("wiki_id"), "url", "title",
        F.length("content").alias("content_chars"), F.md5("content").alias("content_md5"),
    )


def article_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as article files and read back, record by record."""
    path = scratch_folder(spark, "articles")
    line = F.concat(
        F.lit('<doc id="'), F.col("doc_id").cast("string"), F.lit('" url="http://x/'), F.col("doc_id").cast("string"),
        F.lit('" title="'), F.col("title"), F.lit('">\n'), F.col("text"), F.lit("\n</doc>"),
    )
    documents(spark, sf).select(line.alias("value")).write.text(path)
    articles = parse_records(read_records(spark, path))
    ids = as_documents(articles).agg(F.countDistinct("doc_id")).first()[0]
    return articles.select(
        F.col("wiki_id").cast("long").alias("wiki_id"), "url", "title", F.length("content").alias("content_chars"),
        F.md5("content").alias("content_md5"), F.lit(ids).cast("long").alias("ids"),
    )


def page_header(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages").select(
        "page_id",
        header_attribute(F.col("html"), "lang").alias("lang"),
        header_attribute(F.col("html"), "charset").alias("charset"),
        header_attribute(F.col("html"), "missing").alias("missing"),
    )


def run_id_extract(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", run_id(F.col("url"), r"page=(\d+)").alias("run_id"))


def stop_word_list(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents hold each stop word as a token."""
    held = documents(spark, sf).select(
        "doc_id", F.explode(F.array_distinct(blank_split(F.col("text")))).alias("word")
    )
    found = held.filter(F.col("word").isin(read_stop_words(spark)))
    return found.groupBy("word").agg(F.count("*").alias("docs"))


def movie_scan(spark: SparkSession, sf: str) -> DataFrame:
    movies = read_movies(spark, movie_file(spark, documents(spark, sf)))
    return movies.select("title", "genre", F.md5("text").alias("plot_md5"))


def movie_file(spark: SparkSession, docs: DataFrame) -> str:
    """Documents written as a movie file."""
    path = scratch_folder(spark, "movies")
    named = {"Title": "title", "Genre": "genre", "Plot": "text", "Wiki Page": "doc_id"}
    rows = docs.select(
        *[
            (F.col(named[f.name]) if f.name in named else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MOVIE_SCHEMA
        ]
    )
    rows.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def movie_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Every document twice in a movie file: ids, token and term counts of the equal rows."""
    docs = documents(spark, sf)
    movies = staged(read_movies(spark, movie_file(spark, docs.unionAll(docs))))
    found = tokens.tokenize_pattern(movies.withColumn("md5", F.md5("text")), read_stop_words(spark))
    counted = terms.term_frequencies(found).groupBy("doc_id").agg(
        F.max("doc_len").alias("doc_len"), F.sum("tf").alias("tf")
    )
    return (
        found.join(counted, "doc_id", "left")
        .groupBy("title", "genre", "md5")
        .agg(
            F.count("*").alias("rows"),
            F.countDistinct("doc_id").alias("ids"),
            F.coalesce(F.max("doc_len"), F.lit(0)).alias("doc_len"),
            F.coalesce(F.sum("tf"), F.lit(0)).alias("terms"),
        )
    )


def sensor_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "runs")
    rows = read_table(spark, sf, "lineitem").select("l_linenumber", *SENSOR_COLUMNS)
    rows.write.partitionBy("l_linenumber").csv(path)
    return read_runs(spark, f"{path}/*", r"l_linenumber=(\d+)/")


def sensor_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Readings written as lines of which some are cut, lengthened or spoilt: what the reader makes of them."""
    path = scratch_folder(spark, "lines")
    kind = F.pmod("l_orderkey", F.lit(9))
    fields = [F.col(c).cast("string") for c in SENSOR_COLUMNS]
    line = (
        F.when(kind == 0, F.concat_ws(",", *fields[:2]))
        .when(kind == 1, F.concat_ws(",", fields[0], F.lit("n/a"), fields[2]))
        .when(kind == 2, F.concat_ws(",", *fields, F.lit("7")))
        .when(kind == 3, F.concat_ws(",", F.lit(""), *fields[1:]))
        .otherwise(F.concat_ws(",", *fields))
    )
    rows = read_table(spark, sf, "lineitem").select("l_linenumber", line.alias("value"))
    rows.write.partitionBy("l_linenumber").text(path)
    found = reading_problems(read_checked_runs(spark, f"{path}/*", r"l_linenumber=(\d+)/"))
    return found.groupBy("runId", "problem").agg(F.sum("lines").alias("lines"), F.sum("usable").alias("usable"))


def sample_key(spark: SparkSession, sf: str) -> DataFrame:
    sample = sample_by_key(documents(spark, sf), ["doc_id"], SAMPLE_FRACTION, SAMPLE_SEED)
    return sample.select("doc_id", "title")


# --- text ----------------------------------------------------------------------


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    size = F.size("tokens")
    return pattern_docs(spark, sf).agg(
        F.count("*").alias("documents"),
        F.count(F.when(size > 0, 1)).alias("documents_with_tokens"),
        F.sum(size).cast("long").alias("tokens"),
    )


def stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = without_words(blank_split(F.col("text")), read_stop_words(spark))
    return documents(spark, sf).select("doc_id", F.array_join(kept, " ").alias("kept"))


def tokenize_regex(spark: SparkSession, sf: str) -> DataFrame:
    return pattern_docs(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def tokenize_lemma(spark: SparkSession, sf: str) -> DataFrame:
    found = tokenize(documents(spark, sf), LEMMA, read_stop_words(spark))
    return found.select("doc_id", F.array_join(F.array_sort("tokens"), " ").alias("tokens"))


def sentence_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.sentence_counts(documents(spark, sf))


def term_freq(spark: SparkSession, sf: str) -> DataFrame:
    return terms.term_frequencies(pattern_docs(spark, sf))


def doc_length(spark: SparkSession, sf: str) -> DataFrame:
    return terms.document_lengths(pattern_docs(spark, sf))


def doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    return terms.document_frequencies(pattern_docs(spark, sf))


def vocab_top(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(terms.vocabulary(pattern_docs(spark, sf), VOCABULARY), 8, "idf")


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(terms.tfidf_weights(pattern_docs(spark, sf), VOCABULARY), 8, "weight")


def tfidf_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = pattern_docs(spark, sf)
    vocab = terms.vocabulary(docs, VOCABULARY)
    return rounded(terms.join_weights(terms.term_frequencies(docs), vocab), 8, "weight")


# --- latent concepts -----------------------------------------------------------


def gram_matrix(spark: SparkSession, sf: str) -> DataFrame:
    docs = pattern_docs(spark, sf)
    vocab = terms.collect_vocabulary(docs, FULL_RANK)
    gram = lsa.gram_matrix(terms.tfidf_vectors(docs, vocab))
    i, j = (x.astype(np.int32) for x in np.nonzero(gram))
    entries = local_table(spark, i=pa.array(i), j=pa.array(j), value=pa.array(gram[i, j]))
    return rounded(entries, 8, "value")


def svd_energy(spark: SparkSession, sf: str) -> DataFrame:
    report = lsa.singular_value_report(full_rank_model(spark, sf))
    return report.agg(F.round(F.sum("energy"), 6).alias("energy"))


def document_energy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(lsa.document_energy(full_rank_model(spark, sf)), 8, "energy")


def term_energy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(lsa.term_energy(full_rank_model(spark, sf)), 6, "energy")


def svd_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """At full rank: the sum of sigma**4, which is that of the squared Gram entries, and the largest
    deviations of V'V and U'U from the identity and of each concept's length |Av| from its sigma."""
    model = full_rank_model(spark, sf)
    sigma = F.col("sigma")
    gram = lsa.factor_gram(model)
    upright = float(np.abs(gram - np.eye(len(gram))).max()) < 1e-8
    powers = model.singular_values.agg(F.round(F.sum(sigma * sigma * sigma * sigma), 5).alias("sigma4"))
    entries = model.term_factors.select("term_id", F.posexplode("v").alias("i", "x"))
    other = entries.toDF("term_id", "j", "y")
    products = entries.join(other, "term_id").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("p"))
    unit = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    orthogonal = products.agg((F.max(F.abs(F.col("p") - unit)) < 1e-8).alias("orthogonal"))
    lengths = (
        model.doc_factors.select(F.posexplode("us").alias("concept", "u"))
        .groupBy("concept")
        .agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("length"))
        .join(model.singular_values, "concept")
        .agg((F.max(F.abs(F.col("length") - sigma)) < 1e-8).alias("scaled"))
    )
    # One row each.
    return powers.crossJoin(orthogonal).crossJoin(lengths).withColumn("u_orthogonal", F.lit(upright))


def singular_values(spark: SparkSession, sf: str) -> DataFrame:
    return lsa.singular_value_report(reduced_model(spark, sf))


def concept_terms(spark: SparkSession, sf: str) -> DataFrame:
    return concepts.concept_terms(reduced_model(spark, sf))


def concept_docs(spark: SparkSession, sf: str) -> DataFrame:
    return concepts.concept_docs(reduced_model(spark, sf))


def concept_report(spark: SparkSession, sf: str) -> DataFrame:
    return concepts.concept_names(concepts.concept_report(reduced_model(spark, sf)))


def leading_model(spark: SparkSession, sf: str) -> lsa.LsaModel:
    return lsa.fit_lsa(pattern_docs(spark, sf), FULL_RANK, LEADING)


def leading_values(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(lsa.singular_value_report(leading_model(spark, sf)), 6, "sigma", "energy")


def leading_terms(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(concepts.concept_terms(leading_model(spark, sf)), 6, "score")


def leading_docs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(concepts.concept_docs(leading_model(spark, sf)), 6, "score")


def leading_report(spark: SparkSession, sf: str) -> DataFrame:
    return concepts.concept_names(concepts.concept_report(leading_model(spark, sf)))


def leading_search(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of a model of a few concepts, which are not those of all weights."""
    return rounded(search.search(leading_model(spark, sf), benchmark_queries(spark, sf)), 6, "score")


def lsa_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return sweep_lsa(
        documents(spark, sf), read_stop_words(spark), variants=(LEMMA, PATTERN),
        num_terms=(100, 200), concepts=(5, 10, 25),
    ).drop("seconds", "token_seconds")


def lsa_sweep_full(spark: SparkSession, sf: str) -> DataFrame:
    """At full rank the energy of a model is that of its weights."""
    found = sweep_lsa(
        documents(spark, sf), read_stop_words(spark), variants=(PATTERN,), num_terms=(30, FULL_RANK),
        concepts=(FULL_RANK,),
    )
    return rounded(found.select("variant", "num_terms", "energy", "share"), 6, "energy", "share")


# --- search --------------------------------------------------------------------


def keyword_search_exact(spark: SparkSession, sf: str) -> DataFrame:
    docs = pattern_docs(spark, sf)
    vocab = terms.collect_vocabulary(docs, VOCABULARY)
    rows = terms.sparse_rows(terms.tfidf_vectors(docs, vocab))
    return postings.exact_search(rows, vocab, benchmark_queries(spark, sf))


def keyword_search_lsa(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(full_rank_model(spark, sf), benchmark_queries(spark, sf))


def keyword_search_reduced(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(reduced_model(spark, sf), benchmark_queries(spark, sf))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    model = full_rank_model(spark, sf)
    path = model_path(scratch_folder(spark, "model"), PATTERN, FULL_RANK, FULL_RANK)
    save_model(model, path)
    return search.search(load_model(spark, path), benchmark_queries(spark, sf))


def query_terms(spark: SparkSession, sf: str) -> DataFrame:
    vocab = terms.vocabulary(pattern_docs(spark, sf), VOCABULARY)
    return rounded(search.known_terms(benchmark_queries(spark, sf), vocab), 8, "value")


# --- titles and genres ---------------------------------------------------------


def title_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Titles of all documents named by the events; events name other ids, too."""
    hits = read_table(spark, sf, "events").select("event_id", F.col("user_id").alias("doc_id"))
    return genres.with_titles(hits, documents(spark, sf))


def genre_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Genres by title of pages: each takes the title of the source of its number, of which some
    are no document's."""
    by_title = genres.genre_by_title(documents(spark, sf))
    number = F.pmod("page_id", F.lit(25)).cast("string")
    pages = read_table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), F.concat(F.lit("src"), number).alias("title")
    )
    return genres.with_genres(pages, by_title)


def genre_top5(spark: SparkSession, sf: str) -> DataFrame:
    listed = documents(spark, sf).select("doc_id", F.col("text").alias("genre"))
    found = genres.first_genres(listed)
    return found.select("doc_id", F.array_join("genres", "|").alias("genres"))


# --- sensors -------------------------------------------------------------------


def column_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = outliers.column_stats(readings(spark, sf), SENSOR_COLUMNS)
    return rounded(stats, 4, *stats.columns)


def zscore(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(points(spark, sf).select(*ROW_KEYS, *FEATURES), 6, *FEATURES)


def assign_distance(spark: SparkSession, sf: str) -> DataFrame:
    marked = outliers.assign(points(spark, sf), FEATURES, FIXED[5])
    return rounded(marked.select(*ROW_KEYS, "cluster", "distance"), 6, "distance")


def lloyd_step(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(outliers.lloyd_step(points(spark, sf), FEATURES, FIXED[5]), 6, *FEATURES)


def lloyd_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Centres after a few iterations from fixed starts."""
    standard = spread(points(spark, sf), "l_orderkey")
    centers = outliers.fit_sweep(standard, FEATURES, FIXED, max_iter=LLOYD_PASSES)
    return rounded(outliers.center_report(standard, centers, FEATURES), 6, *FEATURES)


def outliers_top25(spark: SparkSession, sf: str) -> DataFrame:
    found = outliers.top_outliers(points(spark, sf), FEATURES, FIXED, SENSOR_COLUMNS)
    return rounded(found, 6, "distance")


def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.cluster_sizes(outliers.cluster_profile(points(spark, sf), FEATURES, FIXED))


def elbow(spark: SparkSession, sf: str) -> DataFrame:
    profile = outliers.cluster_profile(points(spark, sf), FEATURES, FIXED)
    return rounded(outliers.elbow(profile), 6, "mean_distance")


def _started(spark: SparkSession, sf: str) -> tuple[DataFrame, dict]:
    standard = spread(points(spark, sf), "l_orderkey")
    return standard, outliers.hashed_starts(standard, FEATURES, CLUSTER_COUNTS, row_hash(ROW_KEYS))


def _fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, dict]:
    standard, starts = _started(spark, sf)
    return standard, outliers.fit_sweep(standard, FEATURES, starts)


def kmeans_sweep(spark: SparkSession, sf: str) -> DataFrame:
    standard, centers = _fitted(spark, sf)
    profile = outliers.cluster_profile(standard, FEATURES, centers)
    report = outliers.center_report(standard, centers, FEATURES)
    return rounded(rounded(report.join(profile, ["k", "cluster"]), 5, *FEATURES), 3, "total_distance")


def kmeans_outliers(spark: SparkSession, sf: str) -> DataFrame:
    standard, centers = _fitted(spark, sf)
    return rounded(outliers.top_outliers(standard, FEATURES, centers, SENSOR_COLUMNS), 5, "distance")


def kmeans_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Per k: readings covered, centres with points, and how far a centre is at most from the mean of
    the points nearest to it (0 for a fit that has converged)."""
    standard, starts = _started(spark, sf)
    _, checks = outliers.checked_sweep(standard, FEATURES, starts)
    return checks.select("k", F.col("points").alias("readings"), "clusters", F.round("largest_gap", 5).alias("largest_gap"))


def _exported(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "samples")
    sample = sample_by_key(points(spark, sf), ROW_KEYS, SAMPLE_FRACTION, SAMPLE_SEED)
    assigned = outliers.assign_sweep(sample, FEATURES, FIXED, SENSOR_COLUMNS)
    names = ["sensor1", "sensor2", "sensor3"]
    export_samples(assigned.withColumnsRenamed(dict(zip(SENSOR_COLUMNS, names))), path, names)
    return read_cluster_samples(spark, path)


def cluster_sample(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sample_means(_exported(spark, sf)), 6, "mean_distance")


def sample_outlier_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = sample_outliers(_exported(spark, sf), ["sensor1", "sensor2", "sensor3"])
    return rounded(found.drop("rank"), 6, "distance")


def sample_cluster_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cluster_rows(_exported(spark, sf), 1), 6, "distance")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        article_extract, article_files, page_header, run_id_extract, stop_word_list, movie_scan, movie_duplicates,
        lemma_dictionary, sensor_scan, sensor_problems,
        sample_key, corpus_stats, stopword_filter, tokenize_regex, tokenize_lemma,
        sentence_counts, term_freq, doc_length, doc_freq, vocab_top, tfidf_weights, tfidf_join,
        gram_matrix, svd_energy, svd_invariants, document_energy, term_energy, singular_values, concept_terms,
        concept_docs, concept_report, leading_values, leading_terms, leading_docs, leading_report, leading_search, lsa_sweep, lsa_sweep_full, keyword_search_exact, keyword_search_lsa,
        keyword_search_reduced, model_roundtrip, query_terms, title_lookup, genre_lookup,
        genre_top5, column_stats, zscore, assign_distance, lloyd_step, lloyd_sweep, outliers_top25,
        cluster_sizes, elbow, kmeans_sweep, kmeans_outliers, kmeans_partition, cluster_sample,
        sample_outlier_rows, sample_cluster_rows,
    )
}
