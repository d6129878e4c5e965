"""Arrow block kernels of the K-means sweep: all cluster counts from one read of the rows.

A native expression for every k at once outgrows the generated-code limit, and one query
per k reads the rows once per k. Here a task computes all distances of a batch in numpy
and keeps sums or a bounded best list. The passes of the fits read the points packed in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.blocks import best_rows

CentersByK = dict[int, Sequence[Sequence[float]]]
#: Neighbours packed in one block; their distances to a dozen centres stay in a core's cache.
BLOCK_POINTS = 4096
#: Points dealt to blocks at once, which a task holds.
DEALT_POINTS = 256 * BLOCK_POINTS


def nearest_block(
    columns: Sequence[np.ndarray], centers: Sequence[Sequence[float]]
) -> tuple[np.ndarray, np.ndarray]:
    """(distance, cluster) of every row; the lower cluster wins ties."""
    best = np.full(len(columns[0]), np.inf)
    cluster = np.zeros(len(best), dtype=np.int32)
    for i, center in enumerate(centers):
        square = np.zeros(len(best))
        for column, x in zip(columns, center):
            gap = column - x
            square += gap * gap
        closer = square < best
        cluster[closer] = i
        np.minimum(best, square, out=best)
    return np.sqrt(best), cluster


def neighbour_runs(points: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of the points (one row per feature) in runs of at most ``BLOCK_POINTS``, halved along the widest feature."""
    open_runs = [np.arange(points.shape[1])]
    while open_runs:
        run = open_runs.pop()
        if len(run) <= BLOCK_POINTS:
            yield run
            continue
        values = points[:, run]
        half = -(-len(run) // (2 * BLOCK_POINTS)) * BLOCK_POINTS
        cut = np.argpartition(values[np.argmax(np.ptp(values, axis=1))], half)
        open_runs += [run[cut[half:]], run[cut[:half]]]


def packed_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(block): the different points with their counts, neighbours packed in one row as doubles: all counts, then
    all values of each feature."""
    names = [f"x{i}" for i in range(len(features))]
    folded = df.select(*[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    folded = folded.groupBy(*names).agg(F.count("*").cast("double").alias("held"))

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        points = np.concatenate(held, axis=1)
        blocks = [points[:, run].tobytes() for run in neighbour_runs(points[1:])]
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.array(_columns(batch, ["held", *names])))
            if np.isnan(held[-1]).any():
                raise ValueError(f"a point lacks one of {', '.join(features)}")
            if sum(h.shape[1] for h in held) >= DEALT_POINTS:
                yield dealt(held)
                held = []
        if held:
            yield dealt(held)

    return folded.mapInArrow(run, "block binary")


def possible_centers(low: np.ndarray, high: np.ndarray, centers: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For every fit the centres to which a point of the box can be nearest.

    Left out are those farther than one given centre from every point of the box, by more than rounding makes up: it
    is enough to look at the corner that lies most in their direction.
    """
    every = np.concatenate(centers)
    ends = np.cumsum([len(c) for c in centers])
    middle = np.square(every - (low + high) / 2).sum(axis=1)
    first = [end - len(c) + middle[end - len(c) : end].argmin() for c, end in zip(centers, ends)]
    rival = every[np.repeat(first, [len(c) for c in centers])]
    corner = np.where(every > rival, high, low)
    own, other = np.square(corner - every).sum(axis=1), np.square(corner - rival).sum(axis=1)
    slack = 1e-12 * (own + other + np.square(high - low).sum())
    return [np.flatnonzero(p) for p in np.split(~(own - other > slack), ends[:-1])]


def center_sums(block: np.ndarray, centers: Sequence[np.ndarray]) -> np.ndarray:
    """A row per centre of every fit, one after the other: number and sums of the features of the points nearest
    to it within its fit; the lower centre wins ties. ``block`` holds the counts, then the features.
    """
    held, columns = block[0], block[1:]
    weighted = np.concatenate([block[:1], held * columns]).T
    whole = weighted.sum(axis=0)
    sums = [np.zeros((len(c), len(block))) for c in centers]
    possible = possible_centers(columns.min(axis=1), columns.max(axis=1), centers)
    for fit, total, able in zip(centers, sums, possible):
        if len(able) == 1:
            total[able] = whole
            continue
        square = np.zeros((len(able), len(held)))
        gap = np.empty_like(square)
        for column, x in zip(columns, fit[able].T):
            np.subtract(column, x[:, None], out=gap)
            np.multiply(gap, gap, out=gap)
            square += gap
        near = square == square.min(axis=0)
        if np.count_nonzero(near) != len(held):
            near &= np.cumsum(near, axis=0) == 1
        total[able] = near.astype(float) @ weighted
    return np.concatenate(sums)


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def profile_rows(
    df: DataFrame, features: Sequence[str], centers_by_k: CentersByK
) -> DataFrame:
    """(k, cluster, size, total_distance, sum_<feature>...) of the points nearest to each
    centre; every task sends on one row per centre.
    """
    names = ["k", "cluster", "size", "total_distance", *[f"sum_{f}" for f in features]]
    doubles = ", ".join(f"{name} double" for name in names[3:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = {k: np.zeros(len(c), dtype=np.int64) for k, c in centers_by_k.items()}
        totals = {k: np.zeros((len(features) + 1, len(c))) for k, c in centers_by_k.items()}
        for batch in batches:
            columns = _columns(batch, features)
            for k, centers in centers_by_k.items():
                distance, cluster = nearest_block(columns, centers)
                sizes[k] += np.bincount(cluster, minlength=len(centers))
                for total, values in zip(totals[k], [distance, *columns]):
                    total += np.bincount(cluster, weights=values, minlength=len(centers))
        for k in centers_by_k:
            held = np.flatnonzero(sizes[k])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(held), k, dtype=np.int32)),
                    pa.array(held.astype(np.int32)),
                    pa.array(sizes[k][held]),
                    *[pa.array(total[held]) for total in totals[k]],
                ],
                names,
            )

    parts = df.select(*features).mapInArrow(run, f"k int, cluster int, size long, {doubles}")
    return parts.groupBy("k", "cluster").agg(*[F.sum(c).alias(c) for c in names[2:]])


def _marked_schema(df: DataFrame, keep: Sequence[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("k", T.IntegerType()),
            *[df.schema[c] for c in keep],
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _marked(
    batch: pa.RecordBatch, keep: Sequence[str], k: int, distance: np.ndarray, cluster: np.ndarray
) -> pa.Table:
    return pa.Table.from_arrays(
        [
            pa.array(np.full(len(distance), k, dtype=np.int32)),
            *[batch.column(c) for c in keep],
            pa.array(cluster),
            pa.array(distance),
        ],
        ["k", *keep, "cluster", "distance"],
    )


def assigned_rows(
    df: DataFrame, features: Sequence[str], centers_by_k: CentersByK, keep: Sequence[str]
) -> DataFrame:
    """(k, *keep, cluster, distance): every row under every k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _columns(batch, features)
            for k, centers in centers_by_k.items():
                distance, cluster = nearest_block(columns, centers)
                yield from _marked(batch, keep, k, distance, cluster).to_batches()

    return df.select(*dict.fromkeys([*keep, *features])).mapInArrow(run, _marked_schema(df, keep))


def farthest_rows(
    df: DataFrame, features: Sequence[str], centers_by_k: CentersByK, keep: Sequence[str], n: int
) -> DataFrame:
    """The ``n`` rows of largest distance for every k; equal distances by ``keep``."""
    order = [("distance", "descending"), *[(c, "ascending") for c in keep]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}
        cut = dict.fromkeys(centers_by_k, -np.inf)
        for batch in batches:
            columns = _columns(batch, features)
            for k, centers in centers_by_k.items():
                distance, cluster = nearest_block(columns, centers)
                floor = cut[k]
                if len(distance) > n:
                    floor = max(floor, np.partition(distance, len(distance) - n)[len(distance) - n])
                rows = np.flatnonzero(distance >= floor)
                if not len(rows):
                    continue
                found = _marked(
                    batch.take(pa.array(rows)), keep, k, distance[rows], cluster[rows]
                )
                held = pa.concat_tables([best[k], found]) if k in best else found
                best[k] = best_rows(held, n, "k", order)
                if best[k].num_rows == n:
                    cut[k] = pc.min(best[k].column("distance")).as_py()
        for table in best.values():
            yield from table.combine_chunks().to_batches()

    found = df.select(*dict.fromkeys([*keep, *features])).mapInArrow(run, _marked_schema(df, keep))
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("distance"), *keep))
    return found.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
