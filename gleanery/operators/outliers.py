"""Distance-based outliers: z-scores, K-means and nearest-centre distances."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.distances import assigned_rows, center_sums, farthest_rows, packed_rows, profile_rows
from gleanery.session import local_table

Centers = Sequence[Sequence[float]]
TOP_OUTLIERS = 25


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``mean_<col>`` and sample ``std_<col>``, in one pass."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in cols],
    )


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | None = None) -> DataFrame:
    """Adds ``z_<col>``; a column without spread becomes 0."""
    row = stats or column_stats(df, cols).first().asDict()

    def z(c: str) -> Column:
        std = row[f"std_{c}"]
        if not std or not std > 0:
            return F.lit(0.0)
        return (F.col(c) - F.lit(row[f"mean_{c}"])) / F.lit(std)

    return df.withColumns({f"z_{c}": z(c) for c in cols})


def nearest(features: Sequence[str], centers: Centers) -> Column:
    """struct(square, cluster) of the nearest centre; the lower cluster wins ties.

    The centres are literals, so the search is plain arithmetic inside the scan.
    """

    def square(center: Sequence[float]) -> Column:
        parts = [
            (F.col(f) - F.lit(float(x))) * (F.col(f) - F.lit(float(x)))
            for f, x in zip(features, center)
        ]
        return reduce(lambda a, b: a + b, parts)

    pairs = [
        F.struct(square(c).alias("square"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centers)
    ]
    return F.array_min(F.array(*pairs))


def assign(df: DataFrame, features: Sequence[str], centers: Centers) -> DataFrame:
    """Adds ``cluster`` and ``distance`` to the nearest centre."""
    marked = df.withColumn("_n", nearest(features, centers))
    return marked.select(
        *df.columns,
        F.col("_n.cluster").alias("cluster"),
        F.sqrt("_n.square").alias("distance"),
    )


def lloyd_step(df: DataFrame, features: Sequence[str], centers: Centers) -> DataFrame:
    """(cluster, size, <features>): means of the points nearest to each centre."""
    return (
        assign(df, features, centers)
        .groupBy("cluster")
        .agg(F.count("*").alias("size"), *[F.avg(f).alias(f) for f in features])
    )


def hashed_starts(
    df: DataFrame, features: Sequence[str], ks: Sequence[int], by: Column
) -> dict[int, Centers]:
    """For every k the k different points of smallest ``by``, a hash of the row: the same ones however the
    rows are dealt. Fewer if there are fewer points."""
    rows = df.select(by.alias("hash"), *features).orderBy("hash", *features).limit(8 * max(ks)).collect()
    points = list(dict.fromkeys(tuple(float(r[f]) for f in features) for r in rows))
    return {k: points[:k] for k in ks}


@contextmanager
def packed_points(df: DataFrame, features: Sequence[str]):
    """The different points with their counts as numpy blocks (counts, then features), kept on the executors until
    the block ends."""
    width = len(features) + 1
    rows = packed_rows(df, features).rdd.map(lambda row: np.frombuffer(row.block).reshape(width, -1))
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def _pass_sums(blocks: RDD, centers: Sequence[np.ndarray], width: int) -> np.ndarray:
    """``center_sums`` of all points; every task sends on one row per centre."""
    zero = np.zeros((sum(map(len, centers)), width))

    def run(held: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        yield sum((center_sums(block, centers) for block in held), zero)

    return blocks.mapPartitions(run).fold(zero, add)


def fit_sweep(
    df: DataFrame,
    features: Sequence[str],
    starts: dict[int, Centers],
    max_iter: int = 100,
    tol: float = 1e-6,
) -> dict[int, list[list[float]]]:
    """Centres of one K-means fit (Euclidean, Lloyd's passes) for each k from its ``starts``.

    Every pass is one job for all fits of which a centre still moves by more than ``tol``, over one packed copy of
    the different points; a pass of MLlib's is a job and a read of every point for each k. A centre without points
    stays. A start decides its fit whatever the partitions, but for the last digits of the sums. Centres
    keep the order of their starts.
    """
    with packed_points(df, features) as blocks:
        return _fits(blocks, len(features), starts, max_iter, tol)


def _fits(
    blocks: RDD, width: int, starts: dict[int, Centers], max_iter: int, tol: float
) -> dict[int, list[list[float]]]:
    fits = {k: np.array(c, dtype=float).reshape(-1, width) for k, c in starts.items()}
    moving = [k for k, c in fits.items() if len(c)]
    for _ in range(max_iter):
        if not moving:
            break
        sums = _pass_sums(blocks, [fits[k] for k in moving], width + 1)
        ends = np.cumsum([len(fits[k]) for k in moving])
        still = []
        for k, total in zip(moving, np.split(sums, ends[:-1])):
            old, held = fits[k], total[:, :1]
            fits[k] = np.where(held > 0, total[:, 1:] / np.maximum(held, 1), old)
            if np.square(fits[k] - old).sum(axis=1).max() > tol * tol:
                still.append(k)
        moving = still
    return {k: c.tolist() for k, c in fits.items()}


def checked_sweep(
    df: DataFrame,
    features: Sequence[str],
    starts: dict[int, Centers],
    max_iter: int = 100,
    tol: float = 1e-6,
) -> tuple[dict[int, list[list[float]]], DataFrame]:
    """``fit_sweep`` and the ``center_checks`` of its centres, which are one more pass over the packed points instead of a
    read of all rows."""
    with packed_points(df, features) as blocks:
        centers = _fits(blocks, len(features), starts, max_iter, tol)
        fits = [np.array(c) for c in centers.values() if len(c)]
        sums = _pass_sums(blocks, fits, len(features) + 1) if fits else np.zeros((0, len(features) + 1))
    places = [(k, i) for k, c in centers.items() for i in range(len(c))]
    held = np.flatnonzero(sums[:, 0])
    profile = local_table(
        df.sparkSession,
        k=pa.array([places[i][0] for i in held], pa.int32()),
        cluster=pa.array([places[i][1] for i in held], pa.int32()),
        size=pa.array(sums[held, 0].astype(np.int64)),
        **{f"sum_{f}": pa.array(sums[held, j]) for j, f in enumerate(features, 1)},
    )
    return centers, _gaps(profile, center_report(df, centers, [f"c_{f}" for f in features]), features)


def center_report(df: DataFrame, centers_by_k: dict[int, Centers], names: Sequence[str]) -> DataFrame:
    """(k, cluster, <names>) of all centres."""
    rows = [(k, i, c) for k, centers in centers_by_k.items() for i, c in enumerate(centers)]
    return local_table(
        df.sparkSession,
        k=pa.array([k for k, _, _ in rows], pa.int32()),
        cluster=pa.array([i for _, i, _ in rows], pa.int32()),
        **{n: pa.array([float(c[j]) for _, _, c in rows]) for j, n in enumerate(names)},
    )


def assign_sweep(
    df: DataFrame, features: Sequence[str], centers_by_k: dict[int, Centers], keep: Sequence[str]
) -> DataFrame:
    """(k, *keep, cluster, distance): every point under every k, from one read."""
    return assigned_rows(df, features, centers_by_k, keep)


def cluster_profile(
    df: DataFrame, features: Sequence[str], centers_by_k: dict[int, Centers]
) -> DataFrame:
    """(k, cluster, size, total_distance) for every k, from one read."""
    return profile_rows(df, features, centers_by_k).select("k", "cluster", "size", "total_distance")


def center_checks(
    df: DataFrame, features: Sequence[str], centers_by_k: dict[int, Centers]
) -> DataFrame:
    """(k, points, clusters, largest_gap): points covered, centres that have any, and the largest
    distance of a centre from the mean of the points nearest to it, for every k from one read."""
    centers = center_report(df, centers_by_k, [f"c_{f}" for f in features])
    return _gaps(profile_rows(df, features, centers_by_k), centers, features)


def _gaps(profile: DataFrame, centers: DataFrame, features: Sequence[str]) -> DataFrame:
    off = [F.pow(F.col(f"sum_{f}") / F.col("size") - F.col(f"c_{f}"), F.lit(2.0)) for f in features]
    gaps = profile.join(centers, ["k", "cluster"]).withColumn("gap", F.sqrt(reduce(lambda a, b: a + b, off)))
    return gaps.groupBy("k").agg(
        F.sum("size").cast("long").alias("points"),
        F.count("*").alias("clusters"),
        F.max("gap").alias("largest_gap"),
    )


def cluster_sizes(profile: DataFrame) -> DataFrame:
    return profile.select("k", "cluster", "size").orderBy("k", "cluster")


def elbow(profile: DataFrame) -> DataFrame:
    """(k, mean_distance) to the nearest centre."""
    return profile.groupBy("k").agg(
        (F.sum("total_distance") / F.sum("size")).alias("mean_distance")
    )


def top_outliers(
    df: DataFrame,
    features: Sequence[str],
    centers_by_k: dict[int, Centers],
    keep: Sequence[str],
    n: int = TOP_OUTLIERS,
) -> DataFrame:
    """(k, *keep, cluster, distance): the ``n`` farthest points for every k, from one read.

    Every task sends on at most ``n`` points per k. Points at one distance are ordered by
    their own columns.
    """
    return farthest_rows(df, features, centers_by_k, keep, n)
