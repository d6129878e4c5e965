"""Sensor outlier job: z-scores, a K-means sweep and its reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.outliers import (
    assign_sweep,
    center_report,
    cluster_profile,
    cluster_sizes,
    elbow,
    fit_sweep,
    hashed_starts,
    standardize,
    top_outliers,
)
from gleanery.session import job_scope, kept, persisted, staged
from gleanery.sinks.exports import export_samples
from gleanery.sources.sensors import SENSORS, complete_readings, read_checked_runs, reading_problems

# Cluster counts, share of exported points, readings shown.
CLUSTER_COUNTS = range(2, 13)
EXPORT_FRACTION = 0.01
SHOWN_ROWS = 5


@dataclass
class SensorReport:
    readings: int
    dropped: int
    sample: DataFrame
    centers: DataFrame
    outliers: DataFrame
    elbow: DataFrame
    sizes: DataFrame
    problems: DataFrame


def run_sensors(
    spark: SparkSession,
    glob: str,
    out: str | None = None,
    ks: Sequence[int] = CLUSTER_COUNTS,
    seed: int = 1,
) -> SensorReport:
    """Readings with a missing sensor are left out and counted as dropped; ``problems`` says why, by file.

    The starts of the fits are drawn by hash of the readings, so results do not depend on the partitions. What the
    job caches is freed at its end; the report's tables are staged.
    """
    with job_scope():
        return _run(spark, glob, out, ks, seed)


def _run(spark: SparkSession, glob: str, out: str | None, ks: Sequence[int], seed: int) -> SensorReport:
    raw = read_checked_runs(spark, glob)
    total = raw.count()
    features = [f"z_{s}" for s in SENSORS]
    points = persisted(standardize(complete_readings(raw.drop("file", "problem"), SENSORS), SENSORS))
    readings = points.count()
    by = F.xxhash64(F.lit(seed), "runId", *SENSORS)
    centers = fit_sweep(points, features, hashed_starts(points, features, ks, by)) if readings else {}
    profile = staged(cluster_profile(points, features, centers))
    keep = ["runId", *SENSORS]
    if out is not None:
        # By row: readings repeat values, so a draw by value would take or leave them together.
        sample = points.sample(False, EXPORT_FRACTION, seed)
        export_samples(assign_sweep(sample, features, centers, SENSORS), out, SENSORS)
    return SensorReport(
        readings=readings,
        dropped=total - readings,
        sample=raw.select("runId", *SENSORS).limit(SHOWN_ROWS),
        centers=center_report(points, centers, features),
        outliers=kept(top_outliers(points, features, centers, keep)),
        elbow=kept(elbow(profile)),
        sizes=kept(cluster_sizes(profile)),
        problems=kept(reading_problems(raw)),
    )
