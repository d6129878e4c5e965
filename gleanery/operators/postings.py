"""Exact keyword search by an inverted index in impact order.

A posting block holds documents of one term whose weights lie within a factor of ``2 ** (1 / LEVELS)``: (term_id, level, slice,
n, least, most, docs array<struct<doc_id, weight>>). Slices are dealt by document so that a block has about ``BLOCK_DOCS`` documents. From the blocks'
heads alone follows a score that n documents of a query reach at least (n documents of its best term), and a bound of what
a document of a block can reach. Blocks that cannot reach it are skipped: none of their documents is a hit. The rest is
joined and summed; queries, postings and scores stay tables. Queries of one term skip nearly all blocks, those of many terms few.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.blocks import leading_digits_of
from gleanery.operators.search import known_terms
from gleanery.operators.terms import Vocabulary, long_weights
from gleanery.session import delete_folder, local_table, owned, scratch_folder, staged

BLOCK_DOCS = 4096
LEVELS = 2
#: Bounds and sums of the same numbers may differ in their last digits.
SLACK = 1e-9


def build_postings(weights: DataFrame, num_docs: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Posting blocks of (doc_id, term_id, weight); zero weights have none."""
    slices = max(1, -(-num_docs // block_docs))
    placed = weights.where("weight > 0").select(
        "term_id", F.floor(-LEVELS * F.log2("weight")).cast("int").alias("level"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int").alias("slice"), "doc_id", "weight",
    )
    return placed.groupBy("term_id", "level", "slice").agg(
        F.count("*").alias("n"), F.min("weight").alias("least"), F.max("weight").alias("most"),
        F.collect_list(F.struct("doc_id", "weight")).alias("docs"),
    )


def write_postings(postings: DataFrame, path: str) -> None:
    """Blocks in order of terms, so that a read for some terms skips the files of others."""
    postings.repartitionByRange("term_id", "level").sortWithinPartitions("term_id", "level").write.parquet(path)


def needed_blocks(postings: DataFrame, values: DataFrame, n: int) -> DataFrame:
    """(query_id, term_id, value, level) of the blocks that may hold one of the top ``n`` of a query, given
    its terms ``values`` (query_id, term_id, value)."""
    heads = postings.groupBy("term_id", "level").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    # A few dozen levels per term.
    better = Window.partitionBy("term_id").orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = heads.withColumn("seen", F.sum("n").over(better))
    terms = ranked.groupBy("term_id").agg(
        F.max("most").alias("best"), F.max(F.when(F.col("seen") >= n, F.col("least"))).alias("sure")
    )
    known = values.join(terms, "term_id")
    reach = known.groupBy("query_id").agg(
        F.sum(F.col("value") * F.col("best")).alias("total"),
        F.coalesce(F.max(F.col("value") * F.col("sure")), F.lit(0.0)).alias("reached"),
    )
    bound = F.col("total") - F.col("value") * (F.col("best") - F.col("most"))
    each = known.join(reach, "query_id").join(heads.select("term_id", "level", "most"), "term_id")
    return each.where(bound >= F.col("reached") * (1 - SLACK)).select("query_id", "term_id", "value", "level")


def search_postings(postings: DataFrame, docs: DataFrame, vocab: DataFrame, queries: DataFrame, n: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, ..., score): the top ``n`` documents of each query by ``sum idf * times * weight``.

    ``docs`` has one row per doc_id, with columns to carry. Documents without any term of a query score 0 and fill up its
    hits, larger ids first, as they do for other ties.
    """
    values = known_terms(queries, vocab)
    wanted = needed_blocks(postings, values, n)
    pairs = wanted.join(postings.select("term_id", "level", "docs"), ["term_id", "level"]).select(
        "query_id", "value", F.explode("docs").alias("d")
    )
    scores = pairs.groupBy("query_id", F.col("d.doc_id").alias("doc_id")).agg(F.sum(F.col("value") * F.col("d.weight")).alias("s"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("doc_id"))
    best = _top(scores.select("query_id", "doc_id", leading_digits_of(F.col("s")).alias("score")).where("score > 0"), place, n)
    # Of the 2n largest ids at least n are none of a query's at most n hits.
    last = [r["doc_id"] for r in docs.select("doc_id").orderBy(F.desc("doc_id")).limit(2 * n).collect()]
    fill = queries.select("query_id", F.explode(F.array(*[F.lit(i) for i in last]) if last else F.array().cast("array<long>")).alias("doc_id"))
    fill = fill.join(best.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti").withColumn("score", F.lit(0.0))
    hits = _top(best.drop("rank").unionByName(fill), place, n)
    carried = [c for c in docs.columns if c != "doc_id"]
    return hits.join(docs, "doc_id").select("query_id", "rank", "doc_id", *carried, "score")


def _top(scores: DataFrame, place, n: int) -> DataFrame:
    return scores.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= n)


def vocabulary_table(spark, vocab) -> DataFrame:
    """(term_id, term, idf) of a vocabulary held by the driver."""
    return local_table(
        spark, term_id=pa.array(range(len(vocab.terms)), pa.int32()), term=pa.array(vocab.terms, pa.string()),
        idf=pa.array(vocab.idfs, pa.float64()),
    )


def exact_search(rows: DataFrame, vocab: Vocabulary, queries: DataFrame, n: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, ..., score) by ``sum idf * weight`` over sparse rows (doc_id, ..., ids, weights)."""
    spark = rows.sparkSession
    rows = staged(rows)
    path = scratch_folder(spark, "postings")
    write_postings(build_postings(long_weights(rows), vocab.num_docs), path)
    owned(lambda: delete_folder(spark, path))
    docs = rows.drop("ids", "weights")
    return search_postings(spark.read.parquet(path), docs, vocabulary_table(spark, vocab), queries, n)
