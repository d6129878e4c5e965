"""Hyper-parameter sweep: tokenizers x vocabulary sizes x concept counts."""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from gleanery.operators.lsa import factor_tables, tfidf_rows, total_energy, truncated_svd
from gleanery.operators.terms import collect_vocabulary, sparse_rows
from gleanery.plans.corpus import LEMMA, PATTERN, tokenize
from gleanery.session import job_scope, staged
from gleanery.sinks.catalogue import add_model
from gleanery.sinks.model_store import model_path, save_model

# The grid.
NUM_TERMS = (5000, 10000, 20000)
CONCEPTS = (25, 100, 250)


def sweep_lsa(
    docs: DataFrame,
    stop_words: list[str] | DataFrame,
    lemmas: DataFrame | None = None,
    variants: Sequence[str] = (LEMMA, PATTERN),
    num_terms: Sequence[int] = NUM_TERMS,
    concepts: Sequence[int] = CONCEPTS,
    out: str | None = None,
    catalogue: str | None = None,
    solver: str = "arpack",
) -> DataFrame:
    """(variant, num_terms, k, rank, energy, share, seconds, token_seconds), a row per model.

    Documents are tokenised once per variant, a smaller vocabulary is the head of a larger one, and one
    decomposition of the largest k serves every smaller k. ``seconds`` of a row are those of its
    vocabulary's weights and decomposition plus those of storing its own model; what the
    variant's tokens took is in the rows' ``token_seconds``. ``out`` takes a folder per model, ``catalogue`` is the root of
    tables that hold all models and these rows.
    """
    with job_scope():
        results = _swept(docs, stop_words, lemmas, variants, num_terms, concepts, out, catalogue, solver)
    return docs.sparkSession.createDataFrame(
        results,
        "variant string, num_terms int, k int, rank int, energy double, share double, "
        "seconds double, token_seconds double",
    )


def _swept(docs, stop_words, lemmas, variants, num_terms, concepts, out, catalogue, solver) -> list[tuple]:
    results = []
    for variant in variants:
        started = time.monotonic()
        tokens = staged(tokenize(docs, variant, stop_words, lemmas))
        token_seconds = time.monotonic() - started
        full = collect_vocabulary(tokens, max(num_terms))
        for asked in num_terms:
            started = time.monotonic()
            vocab = full.first(asked)
            vectors = tfidf_rows(tokens, vocab)
            sigma, v = truncated_svd(vectors, len(vocab.terms), max(concepts), solver)
            total = total_energy(sparse_rows(vectors))
            shared = time.monotonic() - started
            for k in concepts:
                started = time.monotonic()
                if out is not None or catalogue is not None:
                    model = factor_tables(sparse_rows(vectors), vocab, sigma[:k], v[:, :k])
                if out is not None:
                    save_model(model, model_path(out, variant, asked, k))
                energy = float(np.sum(sigma[:k] ** 2))
                own = time.monotonic() - started
                run = (min(k, len(sigma)), energy, energy / total if total else 0.0, shared + own, token_seconds)
                if catalogue is not None:
                    add_model(model, catalogue, variant, asked, k, run)
                results.append((variant, asked, k, *run))
    return results
