"""Toxicity categories by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over the words of a text;
each model after the first also sees the probabilities of the categories before it. For training
these are out-of-fold: each fold's rows are predicted by models that never saw them, so the later
models learn from inputs as uncertain as those at prediction time. Folds come from a hash of the id.

Words (A-Z lower-cased, runs of 0-9, a-z and non-ASCII) are hashed to ``BINS`` columns; a text has a
column or not, however often. Each model picks the ``KEPT`` columns that separate its training rows
best (by z-score of the difference in share). It learns from a bounded sample of labelled rows
(``sample_rows`` expected, all positives and negatives by the same draw), computed in Spark; columns are
counted and picked there, and the driver gets the picked ones only. Scoring runs over whole texts in Spark tasks.

Defined results: null or empty text has no words and scores the models' base rate; a null label leaves
its row out of that category only; several labels of a document count as 1 if half or more say so; a category without both
kinds of rows has its share as probability (0 without any rows); repeated documents each give a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.quality import drawn, held_out
from gleanery.llm.scan import NOT_ALNUM, Words, pieces, text_column
from gleanery.llm.stage import written

BINS = 1 << 20
KEPT = 256
FOLDS = 3
STEPS = 200
SAMPLE_ROWS = 20_000
L2 = 1e-4
THRESHOLD = 0.3

#: Category and its definition on the columns of ``labels``, in the order of the chain.
CATEGORIES = (
    ("low_quality", "quality = 0"),
    ("toxic", "toxic = 1"),
    ("toxic_prose", "toxic = 1 AND quality = 1"),
)


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (document, column) pairs of a batch, sorted, and the number of documents."""
    w = Words(column, NOT_ALNUM, lower=True)
    bins = (w.hashes() >> np.uint64(44)).astype(np.int64)
    pair = np.unique(w.doc * BINS + bins)
    return pair // BINS, pair % BINS, w.n_docs


def fit_linear(
    doc: np.ndarray, bin_: np.ndarray, extra: np.ndarray, y: np.ndarray, rows: np.ndarray, chosen: np.ndarray | None = None
) -> dict:
    """Logistic regression on ``rows`` (a mask) over the ``chosen`` hashed columns (else the best ones) and ``extra``."""
    n, target = int(rows.sum()), y[rows]
    share = float(target.mean()) if n else 0.0
    if not 0 < share < 1:
        return {"share": share}
    place = np.cumsum(rows) - 1
    inside = rows[doc]
    d, b = place[doc[inside]], bin_[inside]
    ids, code = np.unique(b, return_inverse=True)
    pos = np.bincount(code, target[d], len(ids))
    total = np.bincount(code, minlength=len(ids))
    p_all = total / n
    z = (pos / target.sum() - (total - pos) / (n - target.sum())) / np.sqrt(p_all * (1 - p_all) + 1.0 / n)
    best = np.sort(np.argsort(-np.abs(z), kind="stable")[:KEPT]) if chosen is None else np.flatnonzero(np.isin(ids, chosen))
    column = np.minimum(np.searchsorted(best, code), len(best) - 1)
    used = best[column] == code if len(best) else np.zeros(len(code), bool)
    d, column = d[used], column[used]
    dense = np.hstack([extra[rows], np.ones((n, 1))])
    width = len(best)

    def raw(w: np.ndarray) -> np.ndarray:
        return np.bincount(d, w[column], n) + dense @ w[width:]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(column, r[d], width), r @ dense])

    # Accelerated gradient steps; the largest curvature comes from a few power iterations.
    size, v = 1.0, np.ones(width + dense.shape[1])
    for _ in range(30):
        v = back(raw(v / size))
        size = np.linalg.norm(v)
    step = 1 / (1.1 * size / (4 * n) + L2)
    weights = ahead = np.zeros(len(v))
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(raw(ahead), -30, 30)))
        new = ahead - step * (back(p - target) / n + L2 * ahead)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - weights)
        weights, t = new, t_new
    return {"share": share, "ids": ids[best], "weights": weights}


def apply_linear(model: dict, doc: np.ndarray, bin_: np.ndarray, extra: np.ndarray) -> np.ndarray:
    n = len(extra)
    if "ids" not in model:
        return np.full(n, model["share"])
    ids, w = model["ids"], model["weights"]
    if not len(ids):
        return 1 / (1 + np.exp(-np.clip(extra @ w[:-1] + w[-1], -30, 30)))
    at = np.minimum(np.searchsorted(ids, bin_), len(ids) - 1)
    hit = ids[at] == bin_
    raw = np.bincount(doc[hit], w[at[hit]], n) + extra @ w[len(ids) : -1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit_chain(doc: np.ndarray, bin_: np.ndarray, y: np.ndarray, fold: np.ndarray, chosen: dict | None = None) -> list[dict]:
    """One model per column of ``y`` (NaN: not known, the row is left out there); later ones are trained on
    out-of-fold probabilities. ``chosen`` has the columns of (category, fold left out or None), see ``choose``."""
    n = len(y)
    columns = lambda k, f: None if chosen is None else chosen.get((k, f), np.zeros(0, np.int64))
    unseen, models = np.zeros((n, 0)), []
    for k in range(y.shape[1]):
        known = ~np.isnan(y[:, k])
        models.append(fit_linear(doc, bin_, unseen, y[:, k], known, columns(k, None)))
        if k + 1 < y.shape[1]:
            p = np.zeros(n)
            for f in range(FOLDS):
                part = fit_linear(doc, bin_, unseen, y[:, k], known & (fold != f), columns(k, f))
                p[fold == f] = apply_linear(part, doc, bin_, unseen)[fold == f]
            unseen = np.hstack([unseen, p[:, None]])
    return models


def apply_chain(models: list[dict], doc: np.ndarray, bin_: np.ndarray, n: int) -> np.ndarray:
    seen = np.zeros((n, 0))
    for model in models:
        seen = np.hstack([seen, apply_linear(model, doc, bin_, seen)[:, None]])
    return seen


def hashed_sample(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, fold, y (an entry per category, null where it is not known) and bins (the hashed columns of the
    text) of the sampled documents, staged."""
    names = [f"_y{k}" for k in range(len(categories))]
    known = labels.select("doc_id", *[F.expr(rule).cast("double").alias(n) for n, (_, rule) in zip(names, categories)])
    rows = known.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[(F.avg(n) >= 0.5).cast("double").alias(n) for n in names])
    rows = rows.where(F.coalesce(*names).isNotNull() & ~held_out(F.col("doc_id")))
    sample = drawn(rows, sample_rows).withColumnRenamed("doc_id", "_id")
    # Ids and labels of a bounded number of rows.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int")
    given = chosen.select("doc_id", fold.alias("fold"), F.array(*names).alias("y"), "text")

    def extract(batches):
        for piece in pieces(batches):
            doc, bins, n = hashed_words(text_column(piece))
            bounds = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(bins, pa.int32()))
            yield pa.RecordBatch.from_arrays([*piece.columns[:3], lists], ["doc_id", "fold", "y", "bins"])

    bins = T.StructField("bins", T.ArrayType(T.IntegerType()))
    return written(given.mapInArrow(extract, T.StructType([*given.schema.fields[:3], bins])))


def choose(sample: DataFrame, categories: int) -> dict[tuple[int, int | None], np.ndarray]:
    """The ``KEPT`` columns of each model of the chain, as (category, fold left out or None): those whose shares among its
    positive and negative rows differ most. Counted in Spark; ``KEPT`` numbers a model come to the driver."""
    cells = [(k, f) for k in range(categories) for f in range(FOLDS)]
    at = lambda k: F.get("y", F.lit(k))
    here = lambda k, f: (F.col("fold") == f) & at(k).isNotNull()
    sums = [
        x for k, f in cells for x in (
            F.sum(F.when(here(k, f), 1.0).otherwise(0.0)).alias(f"n_{k}_{f}"), F.sum(F.when(here(k, f), at(k)).otherwise(0.0)).alias(f"p_{k}_{f}")
        )
    ]
    whole = sample.agg(*sums).first().asDict()
    counts = sample.select("fold", "y", F.explode("bins").alias("bin")).groupBy("bin").agg(*sums)
    scores, models = [], []
    for k in range(categories):
        for left in (None, *(range(FOLDS) if k + 1 < categories else ())):
            folds = [f for f in range(FOLDS) if f != left]
            n, p = (sum(whole[f"{c}_{k}_{f}"] or 0.0 for f in folds) for c in "np")
            if not 0 < p < n:
                continue
            total, pos = (sum((F.col(f"{c}_{k}_{f}") for f in folds), F.lit(0.0)) for c in "np")
            share = total / n
            z = (pos / p - (total - pos) / (n - p)) / F.sqrt(share * (1 - share) + 1.0 / n)
            scores.append(F.struct(F.lit(len(models)).alias("model"), F.abs(z).alias("z"), (total > 0).alias("seen")))
            models.append((k, left))
    if not models:
        return {}
    ranked = counts.select("bin", F.explode(F.array(*scores)).alias("s")).select("bin", "s.*").where("seen")
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("z"), "bin"))
    best = ranked.withColumn("place", place).where(F.col("place") <= KEPT).select("model", "bin").collect()
    return {name: np.array(sorted(r["bin"] for r in best if r["model"] == i), np.int64) for i, name in enumerate(models)}


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The chain, learned from labelled documents that are not held out: doc_id and text of ``docs`` and
    what the categories name in ``labels``; no other column is read."""
    sample = hashed_sample(docs, labels, categories, sample_rows)
    chosen = choose(sample, len(categories))
    wanted = pa.array(np.unique(np.concatenate([*chosen.values(), np.zeros(0, np.int64)])).astype(np.int32))

    def keep(batches):
        for batch in batches:
            lists = batch.column("bins")
            inside = pc.is_in(lists.flatten(), value_set=wanted)
            sums = np.r_[0, np.cumsum(inside.to_numpy(zero_copy_only=False))]
            ends = sums[np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]]
            few = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists.flatten().filter(inside))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], few], batch.schema.names)

    # At most KEPT columns a model and row.
    table = sample.mapInArrow(keep, sample.schema).orderBy("doc_id", "bins").toArrow()
    y = np.array(table["y"].to_pylist(), np.float64).reshape(-1, len(categories))
    lists = table["bins"].combine_chunks()
    doc = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return fit_chain(doc, lists.flatten().to_numpy().astype(np.int64), y, table["fold"].to_numpy(), chosen)


def score(docs: DataFrame, models: list[dict], names: list[str]) -> DataFrame:
    """``docs`` plus a probability per category; columns of these names are replaced."""
    plain = docs.drop(*names)

    def rate(batches):
        for piece in pieces(batches):
            p = apply_chain(models, *hashed_words(text_column(piece)))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, *[pa.array(c) for c in p.T.copy()]], [*piece.schema.names, *names]
            )

    added = [T.StructField(n, T.DoubleType()) for n in names]
    return plain.mapInArrow(rate, T.StructType([*plain.schema.fields, *added]))


def rate_documents(docs: DataFrame, labels: DataFrame, categories=CATEGORIES) -> DataFrame:
    """``docs`` plus the probability of each category."""
    return score(docs, fit(docs, labels, categories), [name for name, _ in categories])
