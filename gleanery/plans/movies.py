"""Movie-plot LSA job: concepts with genres and a batch of keyword queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gleanery.operators.concepts import concept_docs, concept_terms
from gleanery.operators.genres import first_genres
from gleanery.operators.lsa import LsaModel, fit_lsa
from gleanery.operators.search import parse_queries, search
from gleanery.plans.corpus import LEMMA, SHOWN_ROWS, corpus_counts, tokenize
from gleanery.session import job_scope, kept, staged
from gleanery.sinks.model_store import check_free, load_model, save_model
from gleanery.sources.movies import read_movies
from gleanery.sources.stopwords import read_stop_words

# Parameters and queries of the job.
NUM_TERMS, CONCEPTS = 5000, 25
QUERIES = (
    "love romance, war battle, comedy funny, murder mystery, space alien, "
    "family drama, horror scary, adventure journey, robot future, western cowboy"
)


@dataclass
class MovieReport:
    model: LsaModel
    concept_terms: DataFrame
    concept_docs: DataFrame
    hits: DataFrame
    counts: DataFrame
    preview: DataFrame


def run_movies(
    spark: SparkSession,
    movies: str,
    out: str,
    stop_words: str | None = None,
    lemmas: DataFrame | None = None,
    num_terms: int = NUM_TERMS,
    k: int = CONCEPTS,
    queries: str = QUERIES,
) -> MovieReport:
    check_free(spark, out)
    with job_scope():
        docs = staged(read_movies(spark, movies))
        tokens = staged(tokenize(docs, LEMMA, read_stop_words(spark, stop_words), lemmas))
        save_model(fit_lsa(tokens, num_terms, k), out)
        model = load_model(spark, out)
        counts, preview = kept(corpus_counts(None, tokens, model)), kept(docs.limit(SHOWN_ROWS))
    return MovieReport(
        model,
        concept_terms(model),
        first_genres(concept_docs(model)),
        search(model, parse_queries(spark, queries)),
        counts,
        preview,
    )
