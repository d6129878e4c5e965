"""Near duplicates among embeddings by HNSW graphs, one per shard.

Equal vectors make one class, which counts as often as it has rows. Classes are dealt by hash into one shard a core, or more
where these would have over ``shard_rows``; a task builds each shard's graph and writes it to the shared folder. A task for each
pair of shards reads both, walks the classes of either through the graph of the other, widens the beam
until an audit against a scan passes, verifies the cosine of what it found in double precision, and sends on, for
each class with links, their number and one edge of a spanning forest: pairs of copies are counted, never sent. Forests are
united by alternating stars.

Every shard is asked for every class. With a shard a core the visits grow in proportion to the rows; beyond ``shard_rows`` classes a
core, which a task could not hold (450 bytes a vector of 64 numbers, and a byte per pair of classes of two shards), with their square. A pair of
classes is missed only if both walks miss it; the audits of ``AUDIT`` members and strangers a graph ask for ``RECALL``.

Defined results: vectors that are null, empty or zero, or hold a null or non-finite component, and rows without id link with nothing (0 links,
their own component, kept); vectors of different lengths are not compared; rows that share an id are vectors of their own, and
count as links of each other if alike; an empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import hnsw
from gleanery.llm.components import components
from gleanery.llm.stage import shared_folder, written
from gleanery.llm.warc import open_folder

SIMILARITY = 0.9
SHARD_ROWS = 16_384
BEAM, RECALL, AUDIT = 32, 0.995, 128
#: Rows of a shard that are verified at once.
VERIFIED = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, without overflow on the way."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def members(table: DataFrame, id_col: str, column: str) -> DataFrame:
    """id, vector (null where it cannot be compared) and two hashes of it."""
    v = F.col(f"`{column}`").cast("array<double>")
    odd = F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    some = F.exists(v, lambda x: x != 0)
    good = F.col(f"`{id_col}`").isNotNull() & ~odd & some
    rows = table.select(F.col(f"`{id_col}`").alias("id"), F.when(good, F.transform(v, lambda x: x + F.lit(0.0))).alias("vector"))
    return rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})


def classes(rows: DataFrame) -> DataFrame:
    """node, first_id, n, h1, h2, dim and vector of every different vector; nodes ascend with first_id."""
    order = ["first_id", "h1", "h2"]
    alike = rows.where("vector IS NOT NULL").groupBy("vector", "h1", "h2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    placed = alike.withColumn("dim", F.size("vector")).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(placed.withColumn("node", F.monotonically_increasing_id()), "classes")


def graphs(nodes: DataFrame, shards: int, folder: str, least: float, recall: float, width: int) -> DataFrame:
    """dim, shard and file of the graph of every shard."""

    def build(table: pa.Table) -> pa.Table:
        order = np.random.default_rng(0).permutation(np.argsort(table.column("h1").to_numpy(), kind="stable"))
        table = table.take(pa.array(order))
        x = unit(table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(table), -1))
        graph = hnsw.build(x)
        own = graph.x[:: max(1, len(x) // AUDIT)]
        beam = hnsw.audited(graph, own, least, width, recall)
        whole = hnsw.dump(graph, unit=x, node=table.column("node").to_numpy(), n=table.column("n").to_numpy(), beam=np.array(beam))
        system, path = open_folder(folder)
        name = f"{uuid.uuid4().hex}.npz"
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{name}") as out:
            out.write(whole)
        head = table.slice(0, 1)
        return pa.table({"dim": head.column("dim"), "shard": head.column("shard"), "file": [name]})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("h1", F.lit(11)), F.lit(shards)).cast("int"))
    # More partitions than shards: few tasks get two of them.
    dealt = dealt.select("dim", "shard", "h1", "node", "n", "vector").repartition(3 * shards, "dim", "shard")
    return written(dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, file string"), "graphs")


def linked(a: dict, b: dict, graphs: tuple, least: float, recall: float) -> np.ndarray:
    """Which classes of two shards (the same one twice: of itself) link: what walks in either direction find, verified."""
    found = np.zeros((len(a["node"]), len(b["node"])), bool)
    same = a is b
    for query, held, graph, turned in ((a, b, graphs[1], False), (b, a, graphs[0], True))[: 1 if same else 2]:
        q = query["unit"].astype(np.float32)
        strangers = q[:: max(1, len(q) // AUDIT)]
        width = hnsw.audited(graph, strangers, least, int(held["beam"]), recall)
        rows, cols = hnsw.hits(graph, q, least, width)
        found[(cols, rows) if turned else (rows, cols)] = True
    if same:
        found |= found.T
        np.fill_diagonal(found, False)
    some = np.flatnonzero(found.any(axis=1))
    for part in np.array_split(some, max(1, len(some) // VERIFIED)):
        cols = np.flatnonzero(found[part].any(axis=0))
        if len(cols):
            found[np.ix_(part, cols)] &= a["unit"][part] @ b["unit"][cols].T >= least
    return found


def forest(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) over the links of two shards."""
    rows, cols = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
    sub = found[np.ix_(rows, cols)]
    mine, other = left[rows].copy(), right[cols].copy()
    top = np.iinfo(np.int64).max
    moved = len(rows) > 0
    while moved:
        before = (mine.sum(), other.sum())
        for at in range(0, len(rows), VERIFIED):
            part = slice(at, at + VERIFIED)
            np.minimum(mine[part], np.where(sub[part], other, top).min(axis=1), out=mine[part])
            np.minimum(other, np.where(sub[part], mine[part, None], top).min(axis=0), out=other)
        moved = (mine.sum(), other.sum()) != before
    nodes, roots = np.concatenate([left[rows], right[cols]]), np.concatenate([mine, other])
    return nodes[nodes != roots], roots[nodes != roots]


def pair_links(shards: DataFrame, n_shards: int, folder: str, least: float, recall: float) -> DataFrame:
    """(a, b, n): the number of links a class has in a shard (b null), and edges of forests (n 0)."""
    left = shards.withColumn("other", F.explode(F.sequence("shard", F.lit(n_shards - 1))))
    right = shards.select("dim", F.col("shard").alias("other"), F.col("file").alias("with"))
    # A row per pair of shards; one task each as far as a driver can plan.
    tasks = left.join(right, ["dim", "other"]).select("file", "with").repartition(min(10_000, n_shards * (n_shards + 1) // 2))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)

        def load(name: str):
            with system.open_input_stream(f"{path}/{name}") as source:
                return hnsw.load(source.read())

        for batch in batches:
            for name, other in zip(batch.column("file").to_pylist(), batch.column("with").to_pylist()):
                graph, a = load(name)
                against, b = (graph, a) if other == name else load(other)
                found = linked(a, b, (graph, against), least, recall)
                nodes, counts = [], []
                for side, weights, turn in ((a, b["n"], found), (b, a["n"], found.T))[: 1 if a is b else 2]:
                    some = np.flatnonzero(turn.any(axis=1))
                    nodes.append(side["node"][some])
                    counts.append(np.array([int(weights[turn[r]].sum()) for r in some], np.int64))
                u, v = forest(found, a["node"], b["node"])
                for x, y, n in ((np.concatenate(nodes), None, np.concatenate(counts)), (u, v, np.zeros(len(u), np.int64))):
                    second = pa.nulls(len(x), pa.int64()) if y is None else pa.array(y)
                    yield pa.RecordBatch.from_arrays([pa.array(x), second, pa.array(n)], ["a", "b", "n"])

    return written(tasks.mapInArrow(meet, "a long, b long, n long"), "links")


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", column: str = "embedding", similarity: float = SIMILARITY,
    shard_rows: int = SHARD_ROWS, beam: int = BEAM, recall: float = RECALL,
) -> DataFrame:
    """id, n_links, component_id and kept of each row; see the module."""
    spark = table.sparkSession
    rows = members(table, id_col, column)
    nodes = classes(rows)
    shards = max(spark.sparkContext.defaultParallelism, -(-nodes.count() // shard_rows))
    folder = shared_folder(spark, "hnsw")
    found = pair_links(graphs(nodes, shards, folder, similarity, recall, beam), shards, folder, similarity, recall)
    labels = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    heads = nodes.select(F.col("node").alias("component"), F.col("first_id").alias("component_id"))
    # One row per class, written, so that the rows of a frequent vector can be dealt over many tasks.
    known = written(
        nodes.drop("vector", "dim").join(counts, "node", "left").join(labels, "node", "left").join(heads, "component", "left").select(
            "h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        ),
        "known",
    )
    good = rows.where("vector IS NOT NULL").select("id", "h1", "h2")
    alone = rows.where("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = good.join(known, ["h1", "h2"]).select("id", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)
