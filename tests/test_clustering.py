from __future__ import annotations

import numpy as np
import pytest
from conftest import points_of, rows
from pyspark.mllib.clustering import KMeans, KMeansModel
from pyspark.sql import functions as F

from kindred.functions import kernels
from kindred.operators import centers
from kindred.operators.assign import nearest_centers
from kindred.operators.scale import feature_statistics, scaled_features, scaled_vectors
from kindred.plans import clustering
from kindred.plans.clustering import cluster, setups, sweep_k

BLOBS = [(0, 0), (0, 1), (1, 0), (1, 1), (10, 10), (10, 11), (11, 10), (11, 11)]
RANDOM = np.random.default_rng(8).normal(size=(50, 3)).tolist()


def reference_run(vectors, first, iterations, medoids=False):
    """Plain loops over all points and pairs: labels, centers, moves and errors."""
    x = np.array(vectors, dtype=float)
    places = {i: np.array(c, dtype=float) for i, c in enumerate(first)}
    log = []
    for _ in range(iterations):
        keys = sorted(places)
        labels = np.array([min(keys, key=lambda k: (((p - places[k]) ** 2).sum(), k)) for p in x])
        moved = {}
        for k in keys:
            members = x[labels == k]
            if len(members):
                totals = ((members[:, None] - members[None]) ** 2).sum(axis=(1, 2))
                moved[k] = members[np.round(totals, 9).argmin()] if medoids else members.mean(axis=0)
        delta = sum(((places[k] - moved[k]) ** 2).sum() for k in keys) if len(moved) == len(places) else float("inf")
        error = np.mean([((p - moved[k]) ** 2).sum() for p, k in zip(x, labels)])
        log.append((delta, error))
        places = moved
        if delta <= 0:
            break
    return labels, places, log


def first_of(points, k, seed):
    runs = setups(points.sparkSession, [(k, seed, 1, 0.0)]).collect()
    return [row["center"] for row in centers.initial_centers(points, runs).orderBy("cluster").collect()]


@pytest.mark.parametrize("algorithm", ["kmeans", "kmedoids"])
@pytest.mark.parametrize("model_bytes", [1 << 20, 64])
def test_matches_plain_loops(spark, algorithm, model_bytes):
    points = points_of(spark, RANDOM, 3)
    found = cluster(points, setups(spark, [(5, 4, 4, 0.0)]), algorithm, model_bytes)
    labels, places, log = reference_run(RANDOM, first_of(points, 5, 4), 4, algorithm == "kmedoids")
    assert rows(found.assignments, "id", "cluster") == sorted([(i, int(k)) for i, k in enumerate(labels)], key=repr)
    got = {row["cluster"]: row["center"] for row in found.centers.collect()}
    assert got.keys() == places.keys()
    for k in places:
        assert np.allclose(got[k], places[k])
    history = found.history.orderBy("iter").collect()
    assert np.allclose([(row["delta"], row["wsos"]) for row in history], log)
    run = found.runs.first()
    assert (run["iters"], run["wsos"]) == (len(log), pytest.approx(log[-1][1]))
    assert found.assignments.agg(F.avg("distance")).first()[0] == pytest.approx(log[-1][1])


def test_two_blobs_converge_and_the_error_falls(spark):
    found = cluster(points_of(spark, BLOBS), setups(spark, [(2, 1, 20, 0.0)]))
    errors = [row["wsos"] for row in found.history.orderBy("iter").collect()]
    assert errors == sorted(errors, reverse=True)
    assert found.runs.first()["delta"] == 0.0 and found.runs.first()["iters"] < 20
    groups = {}
    for point, label in rows(found.assignments, "id", "cluster"):
        groups.setdefault(label, set()).add(point)
    assert sorted(groups.values(), key=min) == [{0, 1, 2, 3}, {4, 5, 6, 7}]


def test_equal_centers_tie_to_the_lowest_and_lost_ones_make_the_move_infinite(spark):
    points = points_of(spark, [(1, 1), (1, 1), (1, 1), (5, 5)])
    found = cluster(points, setups(spark, [(4, 3, 5, 0.0)]))
    history = found.history.orderBy("iter").collect()
    assert history[0]["delta"] == float("inf") and history[0]["clusters"] == 2
    assert history[1]["delta"] == 0.0
    copies = {label for point, label in rows(found.assignments, "id", "cluster") if point < 3}
    order = [tuple(c) for c in first_of(points, 4, 3)]
    assert copies == {order.index((1.0, 1.0))}


@pytest.mark.parametrize("algorithm", ["kmeans", "kmedoids"])
def test_partitions_do_not_matter(spark, algorithm):
    results = []
    for partitions in (1, 17):
        found = cluster(points_of(spark, RANDOM, partitions), setups(spark, [(6, 2, 5, 0.0)]), algorithm)
        results.append((rows(found.assignments, "id", "cluster"), round(found.runs.first()["wsos"], 10)))
    assert results[0] == results[1]


def test_a_medoid_is_a_member_and_not_the_mean(spark):
    vectors = [(i % 3, i // 3) for i in range(9)] + [(100, 100)]
    found = cluster(points_of(spark, vectors), setups(spark, [(1, 1, 3, 0.0)]), "kmedoids")
    center = found.centers.first()["center"]
    assert tuple(center) in {tuple(map(float, v)) for v in vectors} and center != np.mean(vectors, axis=0).tolist()


def test_text_ids_and_carried_columns(spark):
    points = points_of(spark, BLOBS).select(F.concat(F.lit("s"), "id").alias("id"), F.lit("t").alias("title"), "features")
    for algorithm, model_bytes in (("kmeans", 1 << 20), ("kmedoids", 1 << 20), ("kmedoids", 16)):
        found = cluster(points, setups(spark, [(2, 1, 5, 0.0)]), algorithm, model_bytes)
        assert found.assignments.columns == ["id", "title", "run_id", "cluster", "distance"]
        assert found.assignments.count() == 8


def test_runs_together_equal_runs_alone(spark):
    grid = [(2, 1, 5, 0.0), (5, 4, 3, 0.0), (3, 4, 6, 1e9), (5, 9, 6, 0.01)]
    points = points_of(spark, RANDOM)
    expected, labels = [], []
    for run_id, run in enumerate(grid):
        alone = cluster(points, setups(spark, [run]))
        expected.append((run_id, alone.runs.first()["iters"], pytest.approx(alone.runs.first()["wsos"])))
        labels += [(run_id, *row) for row in rows(alone.assignments, "id", "cluster")]
    # One iteration is enough where the bound is high.
    assert expected[2][1] == 1
    for model_bytes in (1 << 20, 200):
        together = cluster(points, setups(spark, grid), model_bytes=model_bytes)
        assert rows(together.runs, "run_id", "iters", "wsos") == expected
        assert rows(together.assignments, "run_id", "id", "cluster") == sorted(labels, key=repr)


def test_agrees_with_the_library_clustering_from_the_same_start(spark):
    points = points_of(spark, RANDOM)
    start = first_of(points, 4, 6)
    model = KMeans.train(
        spark.sparkContext.parallelize(RANDOM), 4, maxIterations=3, initialModel=KMeansModel(start), epsilon=1e-300
    )
    found = cluster(points, setups(spark, [(4, 6, 3, 0.0)]))
    mine = [row["center"] for row in found.centers.orderBy("cluster").collect()]
    assert np.allclose(mine, model.clusterCenters)


@pytest.mark.parametrize("partitions,worth", [(1, 1), (60, 1_000_000)])
def test_partitions_are_made_to_suit(spark, monkeypatch, partitions, worth):
    monkeypatch.setattr(clustering, "_WORTH_SPREADING", worth)
    working, total, tasks = clustering._spread(points_of(spark, RANDOM, partitions).persist(), 5)
    assert total == 50 and tasks == working.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert rows(working, "id") == sorted([(i,) for i in range(50)], key=repr)
    with pytest.raises(ValueError):
        clustering._spread(working.limit(0), 5)


def test_more_clusters_than_points_takes_all(spark):
    found = cluster(points_of(spark, [(0,), (1,), (2,)]), setups(spark, [(9, 1, 2, 0.0)]))
    assert found.runs.first()["wsos"] == 0.0 and found.centers.count() == 3


def test_initial_centers_do_not_depend_on_the_guessed_limit(spark, monkeypatch):
    points = points_of(spark, RANDOM, 5)
    runs = setups(spark, [(7, 3, 1, 0.0), (4, 3, 1, 0.0), (5, 8, 1, 0.0)]).collect()
    expected = rows(centers.initial_centers(points, runs), "run_id", "cluster", "id")
    assert len(expected) == 16
    # The smaller of two runs with one seed starts from the first centers of the larger.
    assert [row[2] for row in expected if row[0] == 0][:4] == [row[2] for row in expected if row[0] == 1]
    monkeypatch.setattr(centers, "_limit", lambda k, total: format(1 << 120, "032x"))
    assert rows(centers.initial_centers(points, runs), "run_id", "cluster", "id") == expected


@pytest.mark.parametrize(
    "grid,algorithm", [([(2, 1, 0, 0.0)], "kmeans"), ([(0, 1, 1, 0.0)], "kmeans"), ([], "kmeans"), ([(2, 1, 1, 0.0)], "kmodes")]
)
def test_bad_settings_are_refused(spark, grid, algorithm):
    with pytest.raises(ValueError):
        cluster(points_of(spark, BLOBS), setups(spark, grid), algorithm)


def test_table_operators(spark):
    points = points_of(spark, RANDOM)
    first = spark.createDataFrame([(0, i, c) for i, c in enumerate(first_of(points, 4, 2))], "run_id int, cluster int, center array<double>")
    labels, places, log = reference_run(RANDOM, first_of(points, 4, 2), 1)
    assigned = nearest_centers(points, first).withColumn("run_id", F.lit(0))
    means = centers.cluster_means(assigned, 3)
    assert centers.center_shift(first, means).first()["delta"] == pytest.approx(log[0][0])
    assert centers.mean_error(assigned, means).first()["wsos"] == pytest.approx(log[0][1])
    assert rows(centers.cluster_sizes(assigned), "cluster", "size") == [(k, int((labels == k).sum())) for k in sorted(places)]
    apart = first.unionByName(spark.createDataFrame([(0, 9, [1e6] * 3)], first.schema))
    assert rows(centers.lost_clusters(apart, means)) == [(0, 9)]
    assert centers.center_shift(apart, means).first()["delta"] == float("inf")
    medoids = {row["cluster"]: row["id"] for row in centers.cluster_medoids(assigned, means, first).collect()}
    x = np.array(RANDOM)
    for k in places:
        members = np.flatnonzero(labels == k)
        totals = ((x[members][:, None] - x[members][None]) ** 2).sum(axis=(1, 2))
        assert medoids[k] == members[np.round(totals, 9).argmin()]


@pytest.mark.parametrize("scale", [1e-30, 1e-20, 1.0, 1e12, 1e25])
@pytest.mark.parametrize("dims", [1, 3, 20])
def test_nearest_is_exact_with_ties_to_the_first(scale, dims):
    random = np.random.default_rng(dims)
    points = np.round(random.normal(size=(2000, dims)) * 2) * scale
    places = np.round(random.normal(size=(30, dims)) * 2) * scale
    best, distance = kernels.nearest(points, places)
    every = np.array([kernels.squared_gaps(points, np.broadcast_to(c, points.shape)) for c in places]).T
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_scaling(spark):
    table = spark.createDataFrame([(i, float(v), 7.0) for i, v in enumerate([1, 2, 3, 6])], "id int, a double, b double")
    scaled = {row["id"]: row["features"] for row in scaled_features(table, ["a", "b"], ["id"]).collect()}
    expected = (np.array([1, 2, 3, 6]) - 3) / np.std([1, 2, 3, 6], ddof=1)
    assert np.allclose([scaled[i][0] for i in range(4)], expected)
    assert all(scaled[i][1] == 0.0 for i in range(4))
    vectors = table.select("id", F.array("a", "b").alias("v"))
    assert {r["id"]: pytest.approx(r["features"]) for r in scaled_vectors(vectors, "v", ["id"]).collect()} == scaled
    assert rows(feature_statistics(table, ["b"])) == [("b", 7.0, 0.0)]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_scaling_refuses_missing_numbers(spark, bad):
    table = spark.createDataFrame([(1.0,), (bad,)], "a double")
    with pytest.raises(Exception, match="not a number"):
        scaled_features(table, ["a"], []).collect()
    with pytest.raises(Exception, match="not a number"):
        scaled_vectors(table.select(F.array("a").alias("v")), "v", []).collect()


def test_sweep_has_a_run_for_each_k(spark):
    runs = sweep_k(points_of(spark, RANDOM), [3, 1, 2], seed=1, max_iters=2).runs
    assert rows(runs, "run_id", "k", "seed") == [(0, 3, 1), (1, 1, 1), (2, 2, 1)]
