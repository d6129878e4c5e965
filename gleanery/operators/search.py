"""Keyword search over an LSA model, or exactly over the TF-IDF rows."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.blocks import top_rows_of_file
from gleanery.functions.text import blank_split
from gleanery.operators.lsa import LsaModel
from gleanery.session import delete_folder, file_system, local_table, owned, scratch_folder

#: Queries, and bytes of their vectors, that are scored in one pass over the documents. All hits are the
#: same for any block size.
MAX_QUERY_BLOCK = 1024
MAX_QUERY_BLOCK_BYTES = 64 << 20


def parse_queries(spark: SparkSession, text: str) -> DataFrame:
    """``"q1, q2"`` as queries(query_id, query); blank entries are dropped."""
    queries = [q.strip() for q in text.split(",")]
    kept = [q for q in queries if q]
    return local_table(
        spark, query_id=pa.array(range(len(kept)), pa.int64()), query=pa.array(kept, pa.string())
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, times); a repeated term counts as often as it is given."""
    terms = queries.select("query_id", F.explode(blank_split(F.col("query"))).alias("term"))
    return terms.groupBy("query_id", "term").agg(F.count("*").alias("times"))


def known_terms(queries: DataFrame, vocab: DataFrame, *carried: str) -> DataFrame:
    """Query terms found in the vocabulary: (query_id, term_id, value = idf * times, *carried)."""
    found = query_terms(queries).join(vocab, "term")
    value = (F.col("idf") * F.col("times")).alias("value")
    return found.select("query_id", "term_id", value, *carried)


def query_factors(queries: DataFrame, term_factors: DataFrame) -> DataFrame:
    """(query_id, factors array<struct<concept, value>>), the projection ``V' q``.

    Queries without a known term have a NULL list.
    """
    found = known_terms(queries, term_factors, "v")
    parts = found.select("query_id", "value", F.posexplode("v").alias("concept", "weight"))
    summed = parts.groupBy("query_id", "concept").agg(
        F.sum(F.col("value") * F.col("weight")).alias("value")
    )
    lists = summed.groupBy("query_id").agg(
        F.collect_list(F.struct("concept", "value")).alias("entries")
    )
    return queries.select("query_id").join(lists, "query_id", "left")


def query_files(factors: DataFrame, width: int) -> list[str]:
    """Write the vectors of the queries (query_id, vector) to the shared folder, in files of one block each."""
    spark = factors.sparkSession
    size = max(1, min(MAX_QUERY_BLOCK, MAX_QUERY_BLOCK_BYTES // (8 * max(1, width))))
    dense = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda c: F.coalesce(F.try_element_at("known", c), F.lit(0.0)))
    known = factors.withColumn("known", F.map_from_entries(F.coalesce("entries", F.array().cast(_ENTRIES))))
    vector = dense if width else F.array().cast("array<double>")
    path = scratch_folder(spark, "queries")
    owned(lambda: delete_folder(spark, path))
    known.select("query_id", vector.alias("vector")).write.option("maxRecordsPerFile", size).parquet(path)
    files, folder = file_system(spark, path)
    names = [f.getPath().toString() for f in files.listStatus(folder)]
    return sorted(n for n in names if n.endswith(".parquet"))


_ENTRIES = "array<struct<concept:int,value:double>>"


def search(model: LsaModel, queries: DataFrame, n: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, title[, genre], score): top ``n`` by ``US . V'q``.

    The queries' vectors are a table; tasks read it from the shared folder, a block of queries in each pass over
    the documents.
    """
    rows = model.doc_factors
    carried = [c for c in rows.columns if c not in ("u", "us")]
    kind = queries.schema["query_id"]
    found = [
        top_rows_of_file(rows, file, kind, n, "doc_id", carried, "us")
        for file in query_files(query_factors(queries, model.term_factors), model.k)
    ]
    if not found:
        raise ValueError("no queries given")
    return reduce(DataFrame.unionByName, found).select("query_id", "rank", *carried, "score")
