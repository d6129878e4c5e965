"""Latent semantic analysis: truncated SVD of the TF-IDF rows and its factor tables."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.blocks import project_rows
from gleanery.operators.terms import (
    Vocabulary,
    collect_vocabulary,
    sparse_rows,
    tfidf_vectors,
)
from gleanery.session import local_table, staged

RELATIVE_CUT = 1e-6


@dataclass
class LsaModel:
    """Factor tables of one fit.

    doc_factors(doc_id, ..., u array<double>, us array<double>), term_factors(term_id, term, df, idf,
    v array<double>), singular_values(concept, sigma). A model of a corpus without terms has no concepts and empty lists.
    """

    doc_factors: DataFrame
    term_factors: DataFrame
    singular_values: DataFrame
    num_docs: int
    num_terms: int
    k: int

    def sigmas(self) -> np.ndarray:
        rows = self.singular_values.orderBy("concept").collect()
        return np.array([r["sigma"] for r in rows])


def row_matrix(vectors: DataFrame) -> RowMatrix:
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors.select("features"), "features"))


def gram_matrix(vectors: DataFrame) -> np.ndarray:
    """``A'A`` of the TF-IDF rows in one pass; terms x terms, so bounded by the vocabulary."""
    return row_matrix(vectors).computeGramianMatrix().toArray()


@contextmanager
def decoded_rows(vectors: DataFrame):
    """A ``RowMatrix`` whose decoded rows stay on the executors until the block ends.

    A persisted DataFrame column would keep them encoded, and each of the many passes of a decomposition
    would decode and convert every row again.
    """
    matrix = row_matrix(vectors)
    rows = matrix._java_matrix_wrapper._java_model.rows()
    rows.persist(vectors.sparkSession.sparkContext._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK))
    try:
        yield matrix
    finally:
        rows.unpersist(False)


def truncated_svd(
    vectors: DataFrame, num_terms: int, k: int, solver: str = "arpack"
) -> tuple[np.ndarray, np.ndarray]:
    """(sigma, V) of the TF-IDF rows.

    ``arpack`` is MLlib's distributed SVD: a pass over the rows per iteration, in which only a vector of
    ``num_terms`` numbers crosses the network. ``gram`` makes one pass that sums ``A'A``, which takes
    ``num_terms ** 2`` doubles in every task and on the driver and loses sigmas below 1e-8 of the first; for
    a few hundred terms that is the faster one. The caller chooses; the size of the data does not.
    """
    if solver not in ("arpack", "gram"):
        raise ValueError(f"unknown solver {solver!r}")
    k = min(k, num_terms)
    if k == 0:
        return np.zeros(0), np.zeros((num_terms, 0))
    if solver == "gram":
        squares, v = np.linalg.eigh(gram_matrix(vectors))
        return _cleaned(np.sqrt(np.maximum(squares[::-1][:k], 0.0)), v[:, ::-1][:, :k])
    with decoded_rows(vectors) as matrix:
        svd = matrix.computeSVD(k, computeU=False)
        return _cleaned(svd.s.toArray(), svd.V.toArray())


def _cleaned(sigma: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop numerically zero factors; make the largest entry of every concept positive."""
    kept = sigma > RELATIVE_CUT * (sigma[0] if len(sigma) else 0.0)
    sigma, v = sigma[kept], v[:, kept]
    strongest = v[np.argmax(np.abs(v), axis=0), np.arange(v.shape[1])]
    return sigma, v * np.where(strongest < 0, -1.0, 1.0)


def factor_tables(
    rows: DataFrame, vocab: Vocabulary, sigma: np.ndarray, v: np.ndarray
) -> LsaModel:
    """Factor tables over sparse rows; ``us = row x V`` keeps the document's own columns."""
    spark: SparkSession = rows.sparkSession
    carried = [c for c in rows.columns if c not in ("ids", "weights")]
    offsets = np.arange(len(vocab.terms) + 1, dtype=np.int32) * v.shape[1]
    terms = local_table(
        spark,
        term_id=pa.array(range(len(vocab.terms)), pa.int32()),
        term=pa.array(vocab.terms, pa.string()),
        df=pa.array(vocab.dfs, pa.int64()),
        idf=pa.array(vocab.idfs, pa.float64()),
        v=pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ravel(v))),
    )
    values = local_table(
        spark,
        concept=pa.array(range(len(sigma)), pa.int32()),
        sigma=pa.array(sigma, pa.float64()),
    )
    return LsaModel(
        doc_factors=with_u(project_rows(rows, v, carried, "us"), sigma),
        term_factors=terms,
        singular_values=values,
        num_docs=vocab.num_docs,
        num_terms=len(vocab.terms),
        k=len(sigma),
    )


def with_u(doc_factors: DataFrame, sigma: np.ndarray) -> DataFrame:
    """Adds ``u``, the rows of U, to (..., us): each concept is divided by its own sigma."""
    carried = [c for c in doc_factors.columns if c != "us"]
    values = F.array(*[F.lit(float(s)) for s in sigma]).cast("array<double>")
    return doc_factors.select(*carried, F.zip_with("us", values, lambda x, s: x / s).alias("u"), "us")


def factor_gram(model: LsaModel) -> np.ndarray:
    """``U'U``, concepts x concepts, in one pass over the document factors."""
    rows = model.doc_factors.select(array_to_vector("u").alias("features"))
    return gram_matrix(rows)


def tfidf_rows(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The TF-IDF rows of a fit without their tokens, staged: the SVD and the factors read them."""
    return staged(tfidf_vectors(docs, vocab).drop("tokens"))


def fit_lsa(docs: DataFrame, num_terms: int, k: int, solver: str = "arpack") -> LsaModel:
    """LSA model of tokenised documents."""
    vocab = collect_vocabulary(docs, num_terms)
    vectors = tfidf_rows(docs, vocab)
    sigma, v = truncated_svd(vectors, len(vocab.terms), k, solver)
    return factor_tables(sparse_rows(vectors), vocab, sigma, v)


def total_energy(rows: DataFrame) -> float:
    """Sum of squared weights of sparse rows, the energy of a full decomposition."""
    squared = F.aggregate("weights", F.lit(0.0), lambda total, w: total + w * w)
    return rows.agg(F.coalesce(F.sum(squared), F.lit(0.0))).first()[0]


def singular_value_report(model: LsaModel) -> DataFrame:
    """(concept, sigma, energy): energy is the squared singular value."""
    return model.singular_values.withColumn("energy", F.col("sigma") * F.col("sigma"))


def document_energy(model: LsaModel) -> DataFrame:
    """(doc_id, energy): squared length of each document in concept space."""
    energy = F.aggregate("us", F.lit(0.0), lambda total, x: total + x * x)
    return model.doc_factors.select("doc_id", energy.alias("energy"))


def term_energy(model: LsaModel) -> DataFrame:
    """(term, energy): squared length of each term over the kept concepts."""
    parts = model.term_factors.select("term", F.posexplode("v").alias("concept", "value"))
    scaled = parts.join(model.singular_values, "concept").withColumn(
        "part", F.pow(F.col("value") * F.col("sigma"), F.lit(2.0))
    )
    return scaled.groupBy("term").agg(F.sum("part").alias("energy"))
