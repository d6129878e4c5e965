import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.functions.distances import center_sums, neighbour_runs, possible_centers
from gleanery.functions.sampling import sample_by_key
from gleanery.operators import outliers
from gleanery.queries import FEATURES, FIXED, LLOYD_PASSES, QUERIES, SENSOR_COLUMNS
from gleanery.sinks.exports import cluster_rows, export_samples, sample_means, sample_outliers
from gleanery.sources.sensors import read_cluster_samples

COLS = ["x", "y", "w"]
Z = [f"z_{c}" for c in COLS]


@pytest.fixture(scope="module")
def four(spark):
    rows = [(1, 0.0, 0.0, 0.0), (2, 0.0, 2.0, 0.0), (3, 2.0, 0.0, 0.0), (4, 10.0, 10.0, 0.0)]
    return spark.createDataFrame(rows, "id long, x double, y double, w double")


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(3000, 3))
    rows = [(i, *map(float, p)) for i, p in enumerate(data)]
    return spark.createDataFrame(rows, "id long, x double, y double, w double").repartition(6)


def test_statistics_and_scores(four):
    stats = outliers.column_stats(four, COLS).first()
    assert (stats.mean_x, stats.mean_y, stats.mean_w) == (3, 3, 0)
    assert (stats.std_x, stats.std_w) == (pytest.approx(4.760952, abs=1e-6), 0)
    z = {r.id: (r.z_x, r.z_y, r.z_w) for r in outliers.standardize(four, COLS).collect()}
    assert z[1] == pytest.approx((-0.630126, -0.630126, 0), abs=1e-6)
    assert z[4] == pytest.approx((1.470294, 1.470294, 0), abs=1e-6)


def test_single_row_scores_zero(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    assert outliers.standardize(one, ["x"]).first().z_x == 0.0


def test_lloyd_steps(four):
    scored = outliers.standardize(four, COLS)
    z = {r.id: [r[c] for c in Z] for r in scored.collect()}
    centers = [z[1], z[4]]
    marked = {r.id: r for r in outliers.assign(scored, Z, centers).collect()}
    assert [marked[i].cluster for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [marked[i].distance for i in (1, 2, 3, 4)] == pytest.approx([0, 0.420084, 0.420084, 0], abs=1e-6)
    moved = {r.cluster: r for r in outliers.lloyd_step(scored, Z, centers).collect()}
    assert moved[0]["size"] == 3 and moved[0].z_x == pytest.approx(-0.490098, abs=1e-6)
    second = [[moved[i][c] for c in Z] for i in (0, 1)]
    again = {r.id: r.distance for r in outliers.assign(scored, Z, second).collect()}
    assert [again[i] for i in (1, 2, 3, 4)] == pytest.approx([0.198030, 0.313112, 0.313112, 0], abs=1e-6)


CENTERS = {2: [(0, 0, 0), (1, 1, 1)], 3: [(0, 0, 0), (1, 1, 1), (-2, 0.5, 0)]}


def test_sweep_kernels_match_brute_force(cloud):
    data = {r.id: np.array([r.x, r.y, r.w]) for r in cloud.collect()}
    rows = {
        (r.k, r.id): (r.cluster, r.distance)
        for r in outliers.assign_sweep(cloud, COLS, CENTERS, ["id"]).collect()
    }
    profile = outliers.cluster_profile(cloud, COLS, CENTERS)
    sizes = {(r.k, r.cluster): r["size"] for r in outliers.cluster_sizes(profile).collect()}
    means = {r.k: r.mean_distance for r in outliers.elbow(profile).collect()}
    top = outliers.top_outliers(cloud, COLS, CENTERS, ["id"], 25).collect()
    for k, centers in CENTERS.items():
        gaps = {i: np.sqrt(((np.array(centers) - p) ** 2).sum(axis=1)) for i, p in data.items()}
        assert all(rows[k, i][0] == g.argmin() for i, g in gaps.items())
        assert all(rows[k, i][1] == pytest.approx(g.min()) for i, g in gaps.items())
        assert sizes == {**sizes, **{(k, c): sum(g.argmin() == c for g in gaps.values()) for c in range(k)}}
        assert means[k] == pytest.approx(np.mean([g.min() for g in gaps.values()]))
        want = sorted(gaps, key=lambda i: (-gaps[i].min(), i))[:25]
        found = sorted((r for r in top if r.k == k), key=lambda r: (-r.distance, r.id))
        assert [r.id for r in found] == want
    native = {r.id: r.cluster for r in outliers.assign(cloud, COLS, CENTERS[3]).collect()}
    assert all(native[i] == rows[3, i][0] for i in native)


def test_all_points_equal(spark):
    same = spark.range(2000).select("id", *[F.lit(1.0).alias(c) for c in COLS])
    top = outliers.top_outliers(same, COLS, {2: [(0, 0, 0), (5, 5, 5)]}, ["id"], 25).collect()
    assert sorted(r.id for r in top) == list(range(25))


def by_row(*keys):
    return F.md5(F.concat_ws(":", *keys))


def lloyd(points, centers, passes):
    """Plain Lloyd iterations; a centre without points stays."""
    centers = np.array(centers, float)
    for _ in range(passes):
        near = ((points[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([points[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centers)])
        moved = np.linalg.norm(new - centers, axis=1).max()
        centers = new
        if moved <= 1e-6:
            break
    return centers


def test_kmeans_sweep(cloud):
    starts = outliers.hashed_starts(cloud, COLS, [2, 3, 5], by_row("id"))
    centers = outliers.fit_sweep(cloud, COLS, starts)
    assert [len(centers[k]) for k in (2, 3, 5)] == [2, 3, 5]
    profile = outliers.cluster_profile(cloud, COLS, centers).collect()
    for k in centers:
        assert sum(r["size"] for r in profile if r.k == k) == 3000
    points = np.array([[r[c] for c in COLS] for r in cloud.collect()])
    for k in centers:
        assert np.array(centers[k]) == pytest.approx(lloyd(points, starts[k], 100), abs=1e-9)
    for r in outliers.center_checks(cloud, COLS, centers).collect():
        assert (r.points, r.clusters) == (3000, r.k) and r.largest_gap < 1e-3
    report = outliers.center_report(cloud, centers, COLS)
    assert report.count() == 10 and report.columns == ["k", "cluster", *COLS]


def test_fits_do_not_depend_on_partitions(cloud):
    fits = []
    for parts in (1, 8):
        dealt = cloud.repartition(parts)
        starts = outliers.hashed_starts(dealt, COLS, [2, 4, 7], by_row("id"))
        fits.append((starts, outliers.fit_sweep(dealt, COLS, starts)))
    assert fits[0][0] == fits[1][0]
    for k in (2, 4, 7):
        assert np.array(fits[0][1][k]) == pytest.approx(np.array(fits[1][1][k]), abs=1e-9)


def test_starts_are_different_points(spark):
    rows = spark.range(50).select("id", *[(F.col("id") % 3).cast("double").alias(c) for c in COLS])
    starts = outliers.hashed_starts(rows, COLS, [2, 6], by_row("id"))
    assert len(set(starts[6])) == len(starts[6]) == 3 and len(starts[2]) == 2
    assert [len(c) for c in outliers.fit_sweep(rows, COLS, starts).values()] == [2, 3]


def test_empty_centres_stay(cloud):
    starts = {2: [(0, 0, 0), (99, 99, 99)], 3: [(-1, 0, 0), (1, 0, 0), (0, 2, 0)]}
    one = outliers.fit_sweep(cloud, COLS, starts, max_iter=4)
    assert one[2][1] == [99, 99, 99]
    many = outliers.fit_sweep(cloud.repartition(9), COLS, starts, max_iter=4)
    assert all(np.array(one[k]) == pytest.approx(np.array(many[k]), abs=1e-9) for k in starts)


def test_a_pass_is_one_job_for_all_fits(spark, cloud):
    tracker = spark.sparkContext.statusTracker()
    starts = outliers.hashed_starts(cloud, COLS, range(2, 8), by_row("id"))
    before = set(tracker.getJobIdsForGroup(None))
    outliers.fit_sweep(cloud, COLS, starts, max_iter=5)
    # The points are folded first.
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 5 + 3


def test_equal_points_are_kept_once(spark):
    rows = spark.range(0, 9000, 1, 6).select("id", *[(F.col("id") % 7 % m).cast("double").alias(c) for m, c in zip((7, 3, 2), COLS)])
    with outliers.packed_points(rows, COLS) as blocks:
        held = np.concatenate(blocks.collect(), axis=1)
    assert held.shape == (4, 7) and sorted(held[0]) == [1285, 1285, 1286, 1286, 1286, 1286, 1286]
    starts = {2: [(0, 0, 0), (6, 0, 0)], 3: [(0, 0, 0), (3, 0, 1), (9, 9, 9)]}
    points = np.array([[i % 7 % m for m in (7, 3, 2)] for i in range(9000)], float)
    for k, centers in outliers.fit_sweep(rows, COLS, starts, max_iter=4).items():
        assert np.array(centers) == pytest.approx(lloyd(points, starts[k], 4), abs=1e-9)


def test_ties_go_to_the_lower_centre(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0), (-1.0, 0.0, 0.0), (1.0, 0.0, 0.0)], "x double, y double, w double")
    one = outliers.fit_sweep(rows, COLS, {2: [(-1, 0, 0), (1, 0, 0)], 3: [(5, 0, 0), (1, 0, 0), (-1, 0, 0)]}, max_iter=1)
    assert one == {2: [[-0.5, 0, 0], [1, 0, 0]], 3: [[5, 0, 0], [0.5, 0, 0], [-1, 0, 0]]}


def test_points_without_a_feature_are_refused(spark):
    rows = spark.createDataFrame([(0.0, 0.0, None), (-1.0, 0.0, 0.0)], "x double, y double, w double")
    with pytest.raises(Exception, match="a point lacks one of x, y, w"):
        outliers.fit_sweep(rows, COLS, {2: [(-1, 0, 0), (1, 0, 0)]}, max_iter=1)


def test_blocks_hold_neighbours():
    points = np.random.default_rng(5).normal(size=(3, 30_000))
    runs = list(neighbour_runs(points))
    assert sorted(np.concatenate(runs)) == list(range(30_000)) and max(map(len, runs)) <= 4096
    assert np.mean([np.ptp(points[:, run], axis=1).min() for run in runs]) < 0.6 * np.ptp(points, axis=1).min()
    assert [len(run) for run in neighbour_runs(np.zeros((3, 5000)))] == [4096, 904]


def test_blocks_skip_no_centre():
    rng = np.random.default_rng(6)
    skipped = 0
    for width in (0, 0.01, 0.3, 3):
        points = rng.normal(size=(3, 1)) + width * rng.integers(-4, 5, size=(3, 500)) / 4
        block = np.concatenate([rng.integers(1, 9, size=(1, 500)), points])
        fits = [rng.normal(size=(k, 3)) for k in range(2, 13)] + [np.array([points[:, 0], points[:, 0], points[:, 1]])]
        skipped += sum(len(able) < len(c) for able, c in zip(possible_centers(points.min(axis=1), points.max(axis=1), fits), fits))
        want = []
        for c in fits:
            near = sum((points[i] - c[:, i : i + 1]) ** 2 for i in range(3)).argmin(axis=0)
            want += [[block[0][near == i].sum(), *(block[0] * points)[:, near == i].sum(axis=1)] for i in range(len(c))]
        assert center_sums(block, fits) == pytest.approx(np.array(want), abs=1e-9)
    assert skipped > 20


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """A folder with three copies of a small lineitem, and their number of rows."""
    folder = str(tmp_path_factory.mktemp("copies"))
    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    shifted = table.crossJoin(spark.range(3).withColumnRenamed("id", "copy"))
    shifted = shifted.withColumn("l_orderkey", F.col("l_orderkey") + 1_000_000 * F.col("copy")).drop("copy")
    shifted.write.parquet(f"{folder}/lineitem.parquet")
    return folder, 3 * table.count()


def test_partition_of_copies(spark, copies):
    folder, rows = copies
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    found = QUERIES["kmeans_partition"](spark, folder).collect()
    assert [(r.readings, r.clusters) for r in sorted(found)] == [(rows, k) for k in range(2, 13)]
    assert max(r.largest_gap for r in found) < 1e-3
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 100 + 12


def test_lloyd_sweep_of_copies(spark, copies):
    folder, _ = copies
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    found = QUERIES["lloyd_sweep"](spark, folder).collect()
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= LLOYD_PASSES + 8
    scored = outliers.standardize(spark.read.parquet(f"{folder}/lineitem.parquet"), SENSOR_COLUMNS)
    points = np.array(scored.select(*FEATURES).collect())
    for k, centers in FIXED.items():
        held = [r[2:] for r in sorted(found) if r.k == k]
        assert np.array(held) == pytest.approx(lloyd(points, centers, LLOYD_PASSES), abs=2e-6)


def test_checks_come_from_the_packed_points(spark, cloud):
    starts = outliers.hashed_starts(cloud, COLS, [2, 3, 5], by_row("id")) | {4: [(0, 0, 0), (1, 1, 1), (99, 99, 99), (-1, 0, 0)], 6: []}
    centers, checks = outliers.checked_sweep(cloud, COLS, starts, max_iter=4)
    again = outliers.fit_sweep(cloud, COLS, starts, max_iter=4)
    assert all(np.array(centers[k]) == pytest.approx(np.array(again[k]), abs=1e-9) for k in starts)
    want = {r.k: r for r in outliers.center_checks(cloud, COLS, centers).collect()}
    found = {r.k: r for r in checks.collect()}
    assert set(found) == set(want) == {2, 3, 4, 5} and want[4].clusters == 3
    for k, r in found.items():
        assert (r.points, r.clusters) == (3000, want[k].clusters)
        assert r.largest_gap == pytest.approx(want[k].largest_gap, abs=1e-9) and r.largest_gap > 1e-4


def test_partition_reads_rows_for_starts_and_packing_only(copies, spark, monkeypatch):
    def read(*_):
        raise AssertionError("the rows are read again")

    monkeypatch.setattr(outliers, "profile_rows", read)
    assert QUERIES["kmeans_partition"](spark, copies[0]).count() == 11


def test_nothing_stays_cached(spark, cloud):
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    outliers.fit_sweep(cloud, COLS, {2: [(0, 0, 0), (1, 1, 1)]})
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_export_and_rescan(spark, cloud, tmp_path):
    names = ["sensor1", "sensor2", "sensor3"]
    sample = sample_by_key(cloud, ["id"], 0.1, seed=2)
    drawn = sample.count()
    assert 200 < drawn < 400
    marked = outliers.assign_sweep(sample, COLS, CENTERS, COLS).withColumnsRenamed(dict(zip(COLS, names)))
    export_samples(marked, str(tmp_path / "out"), names)
    (tmp_path / "out" / "k=2" / "empty.csv").write_text("")
    back = read_cluster_samples(spark, str(tmp_path / "out"))
    assert back.count() == 2 * drawn
    want = {r.k: r.d for r in marked.groupBy("k").agg(F.avg("distance").alias("d")).collect()}
    assert {r.k: r.mean_distance for r in sample_means(back).collect()} == pytest.approx(want)
    top = sample_outliers(back, names, 25)
    assert top.count() == 50
    assert cluster_rows(back, 2).select("k").distinct().collect()[0].k == 3


def test_samples_do_not_depend_on_partitions(cloud):
    first = {r.id for r in sample_by_key(cloud, ["id"], 0.3).collect()}
    other = {r.id for r in sample_by_key(cloud.repartition(11), ["id"], 0.3).collect()}
    assert first == other and 700 < len(first) < 1100
    assert sample_by_key(cloud, ["id"], 1.0).count() == 3000
    assert sample_by_key(cloud, ["id"], 0.0).count() == 0
