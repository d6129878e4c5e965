"""Term counts, vocabulary, IDF and TF-IDF weights over documents with a token list.

``docs`` has ``doc_id``, ``tokens array<string>`` and any columns to carry along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Interaction,
    VectorAssembler,
    VectorSizeHint,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def each_token(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """One row (*columns, term) per token.

    ``explode`` of a column would add a ``size > 0`` filter that runs the tokeniser a
    second time below the first; the outer form does not.
    """
    rows = docs.select(*columns, F.explode_outer("tokens").alias("term"))
    return rows.filter(F.col("term").isNotNull())


def document_lengths(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.size("tokens").cast("long").alias("doc_len"))


def term_frequencies(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_len, term, tf); ``doc_len`` counts every kept token.

    The tokens of a document are sorted and counted inside its row: no shuffle, and rows that
    share a doc_id stay apart.
    """
    ordered = F.array_sort("tokens")
    count = F.size("_t")
    starts = F.filter(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: (i <= count) & ((i == 1) | (F.get("_t", i - 2) != F.get("_t", i - 1))),
    )
    ends = F.concat(F.slice("_s", 2, F.size("_s")), F.array(count + 1))
    pairs = F.arrays_zip(
        F.transform("_s", lambda i: F.get("_t", i - 1)).alias("term"),
        F.zip_with("_s", ends, lambda s, e: (e - s).cast("long")).alias("tf"),
    )
    rows = docs.select("doc_id", ordered.alias("_t")).withColumn("_s", starts)
    # The outer form, for the reason given at ``each_token``.
    found = rows.select(
        "doc_id", count.cast("long").alias("doc_len"), F.inline_outer(pairs).alias("term", "tf")
    )
    return found.filter(F.col("term").isNotNull())


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df). Terms are made distinct inside the row, so only counts are shuffled."""
    terms = docs.select(F.explode(F.array_distinct("tokens")).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def vocabulary(docs: DataFrame, num_terms: int) -> DataFrame:
    """(term_id, term, df, idf) of the ``num_terms`` terms found in most documents.

    Ties go to the smaller term. ``idf = ln(N / df)`` with N counting empty documents.
    """
    top = document_frequencies(docs).orderBy(F.desc("df"), "term").limit(num_terms)
    place = F.row_number().over(Window.orderBy(F.desc("df"), "term")) - 1
    total = docs.select(F.count("*").cast("double")).scalar()
    return top.select(
        place.cast("int").alias("term_id"), "term", "df", F.log(total / F.col("df")).alias("idf")
    )


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary held by the driver; its size is a parameter, not data."""

    terms: list[str]
    dfs: list[int]
    num_docs: int

    @property
    def idfs(self) -> list[float]:
        return [math.log(self.num_docs / df) for df in self.dfs]

    def first(self, num_terms: int) -> Vocabulary:
        return Vocabulary(self.terms[:num_terms], self.dfs[:num_terms], self.num_docs)


def collect_vocabulary(docs: DataFrame, num_terms: int) -> Vocabulary:
    top = document_frequencies(docs).orderBy(F.desc("df"), "term").limit(num_terms).collect()
    return Vocabulary([r["term"] for r in top], [r["df"] for r in top], docs.count())


def tfidf_vectors(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Adds ``features``, the sparse vector of ``idf * tf / doc_len``, row by row.

    Built from ML feature transformers only: no shuffle, and a document without
    vocabulary terms keeps its row with an empty vector.
    """
    carried = docs.columns
    if not vocab.terms:
        return docs.withColumn("features", array_to_vector(F.array().cast("array<double>")))
    length = F.size("tokens")
    scaled = docs.withColumn(
        "_scale", F.when(length > 0, F.lit(1.0) / length).otherwise(F.lit(0.0))
    )
    counts = CountVectorizerModel.from_vocabulary(vocab.terms, "tokens", "_counts")
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(vocab.idfs), inputCol="_counts", outputCol="_weighed"
    )
    hint = VectorSizeHint(
        inputCol="_weighed", size=len(vocab.terms), handleInvalid="optimistic"
    )
    attributes = VectorAssembler(inputCols=["_weighed"], outputCol="_assembled")
    by_length = Interaction(inputCols=["_scale", "_assembled"], outputCol="features")
    for stage in (counts, weigh, hint, attributes, by_length):
        scaled = stage.transform(scaled)
    return scaled.select(*carried, "features")


def sparse_rows(vectors: DataFrame) -> DataFrame:
    """Adds ``ids``/``weights``, the entries of ``features``, in place of it and the tokens."""
    carried = [c for c in vectors.columns if c not in ("features", "tokens")]
    # A dense vector has no index list; its entries are numbered from 0.
    v = F.unwrap_udt("features")
    entries = vectors.select(*carried, v.alias("v"))
    ids = F.coalesce(
        F.col("v.indices"),
        F.transform("v.values", lambda _, i: i),
    )
    return entries.select(*carried, ids.alias("ids"), F.col("v.values").alias("weights"))


def long_weights(rows: DataFrame) -> DataFrame:
    """(doc_id, term_id, weight) of sparse rows; a term found in every document weighs 0."""
    pairs = rows.select("doc_id", F.explode(F.arrays_zip("ids", "weights")).alias("e"))
    return pairs.select(
        "doc_id", F.col("e.ids").alias("term_id"), F.col("e.weights").alias("weight")
    ).filter(F.col("weight") != 0)


def tfidf_weights(docs: DataFrame, num_terms: int) -> DataFrame:
    """(doc_id, term_id, weight) for the ``num_terms`` most frequent terms, which every task gets."""
    vocab = collect_vocabulary(docs, num_terms)
    return long_weights(sparse_rows(tfidf_vectors(docs, vocab)))


def join_weights(frequencies: DataFrame, vocab: DataFrame) -> DataFrame:
    """The same weights by a join on the term, for a vocabulary that should not be sent to every task."""
    return frequencies.join(vocab, "term").select(
        "doc_id", "term_id", (F.col("idf") * F.col("tf") / F.col("doc_len")).alias("weight")
    ).filter(F.col("weight") != 0)
