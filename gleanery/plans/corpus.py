"""Corpus LSA job: articles to a saved model with its reports, and search over it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.concepts import concept_names, concept_report
from gleanery.operators.lsa import LsaModel, fit_lsa, singular_value_report
from gleanery.operators.search import parse_queries, search
from gleanery.operators.tokens import tokenize_lemma, tokenize_pattern
from gleanery.session import job_scope, kept, staged
from gleanery.sinks.model_store import check_free, load_model, model_path, save_model
from gleanery.sources.articles import as_documents, file_names, parse_records, read_records
from gleanery.sources.stopwords import read_stop_words

# Defaults of the job and the query it tries out.
SAMPLE, NUM_TERMS, CONCEPTS = 0.01, 5000, 25
TRIAL_QUERY = "serious incident"
SHOWN_ROWS = 5
LEMMA, PATTERN = "lemma", "pattern"


@dataclass
class CorpusReport:
    model: LsaModel
    path: str
    singular_values: DataFrame
    concepts: DataFrame
    names: DataFrame
    counts: DataFrame
    preview: DataFrame
    trial: DataFrame


def tokenize(
    docs: DataFrame, variant: str, stop_words: list[str] | DataFrame, lemmas: DataFrame | None = None
) -> DataFrame:
    """Tokenised documents. Without a lemma table one is derived from the documents."""
    if variant == PATTERN:
        return tokenize_pattern(docs, stop_words)
    if variant != LEMMA:
        raise ValueError(f"unknown tokenizer {variant!r}")
    return tokenize_lemma(docs, stop_words, lemmas)


def run_corpus(
    spark: SparkSession,
    articles: str,
    out: str,
    stop_words: str | None = None,
    sample: float = SAMPLE,
    num_terms: int = NUM_TERMS,
    k: int = CONCEPTS,
    variant: str = LEMMA,
    lemmas: DataFrame | None = None,
    seed: int = 1,
) -> CorpusReport:
    path = model_path(out, variant, num_terms, k)
    check_free(spark, path)
    files = file_names(spark, articles, sample, seed)
    docs = as_documents(parse_records(read_records(spark, articles, sample, seed)))
    with job_scope():
        tokens = staged(tokenize(docs, variant, read_stop_words(spark, stop_words), lemmas))
        save_model(fit_lsa(tokens, num_terms, k), path)
        model = load_model(spark, path)
        counts = kept(corpus_counts(files, tokens, model))
    report = concept_report(model)
    return CorpusReport(
        model,
        path,
        singular_value_report(model),
        report,
        concept_names(report),
        counts,
        docs.limit(SHOWN_ROWS),
        search(model, parse_queries(spark, TRIAL_QUERY)),
    )


def corpus_counts(files: DataFrame | None, tokens: DataFrame, model: LsaModel) -> DataFrame:
    """(what, n): files, documents, documents with tokens, tokens, and vectors of the model."""
    size = F.size("tokens")
    documents = tokens.agg(
        F.count("*").alias("documents"),
        F.count(F.when(size > 0, 1)).alias("documents_with_tokens"),
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("tokens"),
    )
    parts = [documents, model.doc_factors.agg(F.count("*").alias("vectors"))]
    if files is not None:
        parts.append(files.agg(F.count("*").alias("files")))
    rows = [
        part.select(F.explode(F.create_map(*[x for c in part.columns for x in (F.lit(c), F.col(c))])).alias("what", "n"))
        for part in parts
    ]
    return reduce(DataFrame.unionByName, rows)


def run_search(spark: SparkSession, path: str, queries: str, n: int = 10) -> DataFrame:
    """Hits for comma-separated queries over a saved model."""
    return search(load_model(spark, path), parse_queries(spark, queries), n)
