"""Top terms and documents per concept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.blocks import top_columns
from gleanery.operators.lsa import LsaModel


#: Decimals to which the weights of terms are sure.
WEIGHT_DIGITS = 9


def concept_terms(model: LsaModel, n: int = 25, by: str = "signed") -> DataFrame:
    """(concept, rank, term, score) by weight, or by its size with ``by="abs"``; the smaller term id wins
    a tie, that is of weights (entries of unit vectors) that a solver does not tell apart."""
    weights = model.term_factors.select(
        "term_id", "term", F.posexplode("v").alias("concept", "score")
    )
    key = F.round(F.abs("score") if by == "abs" else F.col("score"), WEIGHT_DIGITS)
    order = Window.partitionBy("concept").orderBy(key.desc(), "term_id")
    ranked = weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select("concept", "rank", "term", "score")


def concept_docs(model: LsaModel, n: int = 25) -> DataFrame:
    """(concept, rank, doc_id, title[, genre], score) by the document's weight in U."""
    carried = [c for c in model.doc_factors.columns if c not in ("u", "us")]
    best = top_columns(model.doc_factors, model.k, n, "doc_id", carried, "u")
    return best.withColumnRenamed("direction", "concept").select(
        "concept", "rank", *carried, "score"
    )


#: Fixed value: concepts that a report shows.
SHOWN_CONCEPTS = 25


def concept_report(model: LsaModel, n: int = 25, shown: int = SHOWN_CONCEPTS) -> DataFrame:
    """(concept, kind, rank, name, score) of the top terms and documents of the first ``shown``
    concepts."""
    terms = concept_terms(model, n).select(
        "concept", F.lit("term").alias("kind"), "rank", F.col("term").alias("name"), "score"
    )
    docs = concept_docs(model, n).select(
        "concept", F.lit("doc").alias("kind"), "rank", F.col("title").alias("name"), "score"
    )
    return terms.unionByName(docs).filter(F.col("concept") < shown)


def concept_names(report: DataFrame) -> DataFrame:
    """(concept, kind, names): the ranked names of each concept in one line."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "name")))
    return report.groupBy("concept", "kind").agg(
        F.array_join(F.transform(pairs, lambda p: p["name"]), ", ").alias("names")
    )
