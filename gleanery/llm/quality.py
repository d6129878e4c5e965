"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trained on a bounded sample of labelled rows (``sample_rows`` expected, drawn by hash of doc_id): the
statistics are computed in Spark and some 20 numbers per sampled document come to the driver. Values
are binned to at most 64 quantile bins, each level of a tree is grown from one histogram of
gradients, and the trees are kept as flat arrays (feature, threshold, leaf value) that score whole
batches by array look-ups in Spark tasks.

Defined results: null or empty text has all statistics 0 and gets the score the trees give that;
several labels of a document count as one, quality if half or more say so; null labels are left out;
without labels of both kinds every score is the share of quality labels (0.5 without any).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.scan import SPACE, Words, pieces, text_column
from gleanery.llm.textstats import FEATURES, features

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, MIN_WEIGHT, L2 = 60, 4, 64, 0.15, 3.0, 1.0
THRESHOLD = 0.3


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cut points of each column: midway between neighbouring distinct quantiles."""
    cuts = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="lower"))
        cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> dict:
    """Logistic boosting; a node that finds no split sends all rows left (threshold infinity)."""
    rows, width = x.shape
    share = float(y.mean()) if rows else 0.5
    model = {"feature": [], "threshold": [], "leaf": [], "depth": depth}
    if not rows or not 0 < share < 1:
        return model | {"start": None, "share": share}
    cuts = bin_edges(x)
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    start = math.log(share / (1 - share))
    raw = np.full(rows, start)
    offset = np.arange(width) * BINS
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(rows, np.int64)
        feature = np.zeros(2**depth - 1, np.int64)
        threshold = np.full(2**depth - 1, np.inf)
        for level in range(depth):
            n = 2**level
            cell = (node[:, None] * (width * BINS) + offset + binned).ravel()
            total = n * width * BINS
            g = np.bincount(cell, np.repeat(grad, width), total).reshape(n, width, BINS).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(hess, width), total).reshape(n, width, BINS).cumsum(axis=2)
            ga, ha = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + L2) + (ga - g) ** 2 / (ha - h + L2) - ga**2 / (ha + L2)
            gain[(h < MIN_WEIGHT) | (ha - h < MIN_WEIGHT)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c) :] = 0
            flat = gain.reshape(n, -1)
            best = flat.argmax(axis=1)
            good = flat[np.arange(n), best] > 1e-9
            first = 2**level - 1
            f, b = best // BINS, best % BINS
            feature[first : first + n] = np.where(good, f, 0)
            threshold[first : first + n] = [cuts[i][j] if k else np.inf for i, j, k in zip(f, b, good)]
            right = good[node] & (binned[np.arange(rows), f[node]] > b[node])
            node = 2 * node + right
        g = np.bincount(node, grad, 2**depth)
        h = np.bincount(node, hess, 2**depth)
        leaf = -RATE * g / (h + L2)
        raw += leaf[node]
        for key, value in (("feature", feature), ("threshold", threshold), ("leaf", leaf)):
            model[key].append(value)
    stacked = {k: np.stack(model[k]) for k in ("feature", "threshold", "leaf")}
    return stacked | {"depth": depth, "start": start, "share": share}


def score_trees(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of class 1: all rows walk down each tree together."""
    if model["start"] is None:
        return np.full(len(x), model["share"])
    raw, rows = np.full(len(x), model["start"]), np.arange(len(x))
    for feature, threshold, leaf in zip(model["feature"], model["threshold"], model["leaf"]):
        at = np.zeros(len(x), np.int64)
        for _ in range(model["depth"]):
            at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
        raw += leaf[at - (2 ** model["depth"] - 1)]
    return 1 / (1 + np.exp(-raw))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id's text is a multiple of 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(labels: DataFrame, name: str = "quality") -> DataFrame:
    """One row per labelled document that is not held out."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull()).groupBy("doc_id")
    return rows.agg((F.avg(name) >= 0.5).cast("double").alias("label")).where(~held_out(F.col("doc_id")))


def drawn(rows: DataFrame, sample_rows: int) -> DataFrame:
    """``sample_rows`` rows in expectation, the same ones in every run; all if there are fewer."""
    parts = 1 << 30
    share = min(1.0, sample_rows / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(parts)) < int(share * parts))


def measured(docs: DataFrame, extra: list[str]) -> DataFrame:
    """``extra`` columns and the array of statistics of each document."""
    given = docs.select(*extra, "text")

    def measure(batches):
        for piece in pieces(batches):
            x = features(Words(text_column(piece), SPACE), SPACE)
            bounds = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], lists], [*extra, "x"])

    x = T.StructField("x", T.ArrayType(T.DoubleType()))
    return given.mapInArrow(measure, T.StructType(given.schema.fields[:-1] + [x]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """The trees, from doc_id and text of ``docs`` and doc_id and quality of ``labels``; no other column is read."""
    # Ids and labels of the sample: at most a few bytes a row of a bounded number of rows.
    sample = F.broadcast(drawn(labelled(labels), sample_rows).withColumnRenamed("doc_id", "_id"))
    chosen = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_id"))
    table = measured(chosen, ["doc_id", "label"]).orderBy("doc_id", "x").toArrow()
    x = np.array(table["x"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit_trees(x, table["label"].to_numpy())


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` plus ``score``; a column of that name is replaced."""
    plain = docs.drop("score")

    def rate(batches):
        for piece in pieces(batches):
            x = features(Words(text_column(piece), SPACE), SPACE)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(score_trees(model, x))], [*piece.schema.names, "score"]
            )

    return plain.mapInArrow(rate, T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` plus score, from 0 to 1, by a model learned from the labels that are not held out."""
    return score(docs, fit(docs, labels))
