"""Queries on scaling, clustering, choosing K and using the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import vectors
from kindred.operators import centers, lookup
from kindred.operators.assign import nearest_centers
from kindred.operators.scale import feature_statistics, scaled_vectors
from kindred.plans.choose_k import best_k, elbow
from kindred.plans.clustering import Clustering, cluster, setups, sweep_k
from kindred.plans.mixed import cluster_with_lists
from kindred.queries import tables
from kindred.queries.tables import LINE_FEATURES, embedding_points, line_points, long_form, read, song_points
from kindred.session import fresh_path, materialize
from kindred.sources import sinks

# (k, seed, max_iters, epsilon)
EMBEDDING_RUN = (5, 7, 3, 0.0)
LINE_RUN = (6, 11, 3, 0.0)
SONG_RUN = (6, 5, 3, 0.0)
GRID = [(4, 5, 3, 0.0), (6, 5, 2, 0.0), (5, 21, 4, 0.05), (3, 21, 4, 1e9)]
SWEEP = [2, 3, 4, 6, 8]
MIXED_RUN = (6, 5, 2, 0.0)
LIST_WEIGHT = 0.5


def _one(points: DataFrame, run: tuple, algorithm: str = "kmeans") -> Clustering:
    return cluster(points, setups(points.sparkSession, [run]), algorithm)


def _rounded(name: str, places: int = 4) -> Column:
    return F.round(name, places).alias(name)


def feature_means(spark: SparkSession, folder: str) -> DataFrame:
    found = feature_statistics(read(spark, folder, "lineitem"), LINE_FEATURES)
    return found.select("feature", _rounded("mean", 6), _rounded("sd", 6))


def scaled_lines(spark: SparkSession, folder: str) -> DataFrame:
    return long_form(line_points(spark, folder), ["id"], "features")


def scaled_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return long_form(embedding_points(spark, folder), ["id", "label"], "features")


def scaled_songs(spark: SparkSession, folder: str) -> DataFrame:
    return long_form(song_points(spark, folder), ["id", "title", "artist"], "features")


def assembled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbers by way of one vector column."""
    keyed = line_points(spark, folder, scale=False)
    return long_form(scaled_vectors(keyed, "features", ["id"]), ["id"], "features")


def vector_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.col("embedding").cast("array<double>")
    doubled = vectors.divide_by(vectors.scale_by(vectors.add(raw, raw), F.lit(3.0)), F.lit(2.0))
    through = vectors.from_ml_vector(vectors.to_ml_vector(doubled))
    table = read(spark, folder, "embeddings").select(
        "vec_id", through.alias("v"), F.round(vectors.squared_distance(raw, doubled), 6).alias("gap")
    )
    return long_form(table, ["vec_id", "gap"], "v")


def _first_centers(points: DataFrame, run: tuple) -> DataFrame:
    return centers.initial_centers(points, setups(points.sparkSession, [run]).collect())


def initial_centers(spark: SparkSession, folder: str) -> DataFrame:
    return _first_centers(embedding_points(spark, folder), (10, 7, 1, 0.0)).select("cluster", "id")


def nearest_center(spark: SparkSession, folder: str) -> DataFrame:
    points = line_points(spark, folder)
    best = nearest_centers(points, _first_centers(points, LINE_RUN))
    return best.select("id", "cluster", _rounded("distance", 6))


def nearest_center_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with room for two centers at a time."""
    points = line_points(spark, folder)
    best = nearest_centers(points, _first_centers(points, LINE_RUN), model_bytes=2 * 8 * len(LINE_FEATURES))
    return best.select("id", "cluster", _rounded("distance", 6))


def kmeans_centers(spark: SparkSession, folder: str) -> DataFrame:
    return long_form(_one(embedding_points(spark, folder), EMBEDDING_RUN).centers, ["cluster"], "center")


def kmeans_embeddings_assign(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(embedding_points(spark, folder), EMBEDDING_RUN).assignments
    return found.select("id", "label", "cluster", _rounded("distance"))


def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(line_points(spark, folder), LINE_RUN).assignments
    return found.select("id", "cluster", _rounded("distance"))


def kmeans_delta(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(line_points(spark, folder), LINE_RUN).history
    return found.select("iter", "clusters", _rounded("delta"), _rounded("wsos"))


def kmedoids_centers(spark: SparkSession, folder: str) -> DataFrame:
    return long_form(_one(song_points(spark, folder), SONG_RUN, "kmedoids").centers, ["cluster"], "center")


def kmedoids_assign(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(song_points(spark, folder), SONG_RUN, "kmedoids").assignments
    return found.select("id", "cluster", _rounded("distance"))


def kmedoids_delta(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(song_points(spark, folder), SONG_RUN, "kmedoids").history
    return found.select("iter", "clusters", _rounded("delta"), _rounded("wsos"))


def _in_tables(points: DataFrame, run: tuple, algorithm: str = "kmeans") -> Clustering:
    """The same with centers kept in tables, met in blocks of two."""
    room = 2 * 8 * len(points.first()["features"])
    return cluster(points, setups(points.sparkSession, [run]), algorithm, model_bytes=room)


def kmeans_assign_tables(spark: SparkSession, folder: str) -> DataFrame:
    found = _in_tables(line_points(spark, folder), LINE_RUN).assignments
    return found.select("id", "cluster", _rounded("distance"))


def kmeans_delta_tables(spark: SparkSession, folder: str) -> DataFrame:
    found = _in_tables(line_points(spark, folder), LINE_RUN).history
    return found.select("iter", "clusters", _rounded("delta"), _rounded("wsos"))


def kmedoids_assign_tables(spark: SparkSession, folder: str) -> DataFrame:
    found = _in_tables(song_points(spark, folder), SONG_RUN, "kmedoids").assignments
    return found.select("id", "cluster", _rounded("distance"))


def _written_grid(spark: SparkSession, folder: str) -> str:
    """A grid written over an older clustering."""
    path, points = fresh_path(spark, "clustering"), song_points(spark, folder)
    sinks.write_clustering(_one(points, GRID[1]), path)
    sinks.write_clustering(cluster(points, setups(spark, GRID)), path)
    return path


def written_assignments(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.parquet(f"{_written_grid(spark, folder)}/assignments")
    return found.select("k", "run_id", "id", "cluster")


def written_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.parquet(f"{_written_grid(spark, folder)}/runs")
    return found.select("run_id", "k", "seed", "iters", _rounded("wsos"))


def written_centers(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.parquet(f"{_written_grid(spark, folder)}/centers")
    return long_form(found, ["run_id", "cluster", "n"], "center")


def _assigned_once(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Songs at their nearest first centers, and those centers, as tables of one run."""
    points = song_points(spark, folder).select("id", "features")
    first = materialize(_first_centers(points, SONG_RUN).select("run_id", "cluster", "center"), "first")
    return materialize(nearest_centers(points, first).withColumn("run_id", F.lit(0)), "assigned"), first


def cluster_means(spark: SparkSession, folder: str) -> DataFrame:
    assigned, _ = _assigned_once(spark, folder)
    return long_form(centers.cluster_means(assigned, 13), ["cluster", "n"], "center")


def cluster_medoids(spark: SparkSession, folder: str) -> DataFrame:
    assigned, first = _assigned_once(spark, folder)
    return centers.cluster_medoids(assigned, centers.cluster_means(assigned, 13), first).select("cluster", "id")


def mean_error(spark: SparkSession, folder: str) -> DataFrame:
    assigned, _ = _assigned_once(spark, folder)
    return centers.mean_error(assigned, centers.cluster_means(assigned, 13)).select(_rounded("wsos"))


def error_after_move(spark: SparkSession, folder: str) -> DataFrame:
    assigned, first = _assigned_once(spark, folder)
    means = centers.cluster_means(assigned, 13)
    medoids = centers.cluster_medoids(assigned, means, first)
    return centers.error_after_move(first, means, medoids).select(_rounded("wsos"))


def center_shift(spark: SparkSession, folder: str) -> DataFrame:
    assigned, first = _assigned_once(spark, folder)
    return centers.center_shift(first, centers.cluster_means(assigned, 13)).select(_rounded("delta"))


def lost_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Every first center twice: ties go to the lower number, so the copies get no points."""
    points = song_points(spark, folder).select("id", "features")
    first = materialize(_first_centers(points, SONG_RUN).select("run_id", "cluster", "center"), "first")
    doubled = first.unionByName(first.withColumn("cluster", F.col("cluster") + SONG_RUN[0]))
    assigned = nearest_centers(points, doubled).withColumn("run_id", F.lit(0))
    return centers.lost_clusters(doubled, centers.cluster_means(assigned, 13)).select("cluster")


def wsos_by_k(spark: SparkSession, folder: str) -> DataFrame:
    found = sweep_k(song_points(spark, folder), SWEEP, seed=5, max_iters=3)
    return found.runs.select("k", _rounded("wsos"))


def elbow_table(spark: SparkSession, folder: str) -> DataFrame:
    found = sweep_k(song_points(spark, folder), SWEEP, seed=5, max_iters=3)
    return elbow(found.runs).select("k", _rounded("wsos"), _rounded("second_diff"), _rounded("chord_gap"))


def elbow_k(spark: SparkSession, folder: str) -> DataFrame:
    return best_k(elbow(sweep_k(song_points(spark, folder), SWEEP, seed=5, max_iters=3).runs)).select("k")


def grid_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = cluster(song_points(spark, folder), setups(spark, GRID)).runs
    return runs.select("run_id", "k", "seed", "iters", _rounded("wsos"))


def grid_medoid_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = cluster(song_points(spark, folder), setups(spark, GRID), "kmedoids").runs
    return runs.select("run_id", "k", "seed", "iters", _rounded("wsos"))


def grid_assignments(spark: SparkSession, folder: str) -> DataFrame:
    found = cluster(song_points(spark, folder), setups(spark, GRID)).assignments
    return found.select("run_id", "id", "title", "artist", "cluster")


def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """From the clustering itself, which has counted them, without a pass."""
    return _one(line_points(spark, folder), LINE_RUN).centers.select("cluster", F.col("n").alias("size"))


def cluster_sizes_of_assignments(spark: SparkSession, folder: str) -> DataFrame:
    found = centers.cluster_sizes(_one(line_points(spark, folder), LINE_RUN).assignments)
    return found.select("cluster", "size")


def sorted_assignments(spark: SparkSession, folder: str) -> DataFrame:
    found = lookup.sorted_assignments(_one(embedding_points(spark, folder), EMBEDDING_RUN).assignments)
    return found.select("cluster", "id")


def center_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of medoids, of means (not found), and of means that are not looked up."""
    points = song_points(spark, folder)
    medoids = centers.name_centers(_one(points, SONG_RUN, "kmedoids").centers, points)
    means = _one(points, SONG_RUN).centers
    named = [("medoid", medoids), ("mean", centers.name_centers(means, points)), ("off", centers.name_centers(means, None))]
    tagged = [table.select(F.lit(kind).alias("kind"), "cluster", "title", "artist") for kind, table in named]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def radio(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(embedding_points(spark, folder), EMBEDDING_RUN).assignments
    return lookup.radio(found, 17).select("cluster", "id")


def radio_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same from written assignments and their index by id."""
    path = fresh_path(spark, "clustering")
    sinks.write_clustering(_one(embedding_points(spark, folder), EMBEDDING_RUN), path)
    return lookup.radio_from_files(spark, f"{path}/assignments", 17).select("cluster", "id")


def _songs_on_lists(spark: SparkSession, folder: str) -> DataFrame:
    counts = tables.pairs(spark, folder).groupBy("id").agg(F.count(F.lit(1)).alias("playlists"))
    return tables.featured_songs(spark, folder).select("id", "title", "artist").join(counts, "id")


def cluster_playlists(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(song_points(spark, folder), SONG_RUN).assignments
    joined = lookup.cluster_playlists(_songs_on_lists(spark, folder), found)
    return joined.select("id", "title", "artist", "playlists", "cluster")


def clusters_by_name(spark: SparkSession, folder: str) -> DataFrame:
    found = _one(song_points(spark, folder), SONG_RUN).assignments
    return lookup.clusters_by_name(_songs_on_lists(spark, folder), found.select("title", "artist", "cluster"))


def _mixed(spark: SparkSession, folder: str, **options) -> Clustering:
    """Songs by their features and the playlists they are on."""
    # Grouped by the number of the part, which is shorter to shuffle and to sort by than its text.
    lists = tables.tracks(spark, folder).groupBy("l_partkey").agg(F.collect_list("pid").alias("items"))
    lists = lists.select(F.col("l_partkey").cast("string").alias("id"), "items")
    points = song_points(spark, folder).join(lists, "id", "left")
    return cluster_with_lists(points, *MIXED_RUN, weight=LIST_WEIGHT, **options)


def mixed_medoids(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder).centers.select("cluster", "id", "n", F.size("items").alias("playlists"))


def mixed_assign(spark: SparkSession, folder: str) -> DataFrame:
    found = _mixed(spark, folder).assignments
    return found.select("id", "title", "artist", "cluster", _rounded("distance"))


def mixed_history(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder).history.select("iter", "clusters", _rounded("delta"), _rounded("wsos"))


def mixed_medoids_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with little room for medoids and candidates, and few candidates at first."""
    found = _mixed(spark, folder, model_bytes=2_000, candidates=2).centers
    return found.select("cluster", "id", "n", F.size("items").alias("playlists"))


QUERIES = {
    query.__name__: query
    for query in (
        feature_means, scaled_lines, assembled_lines, scaled_embeddings, scaled_songs, vector_arithmetic, initial_centers,
        nearest_center, nearest_center_blocks, kmeans_centers, kmeans_embeddings_assign, kmeans_assign, kmeans_delta,
        kmedoids_centers, kmedoids_assign, kmedoids_delta, cluster_means, cluster_medoids, mean_error, error_after_move, center_shift,
        lost_clusters, wsos_by_k, elbow_table, elbow_k, grid_runs, grid_medoid_runs, grid_assignments, cluster_sizes,
        cluster_sizes_of_assignments, kmeans_assign_tables, kmeans_delta_tables, kmedoids_assign_tables,
        written_assignments, written_runs, written_centers,
        sorted_assignments, center_names, radio, radio_from_files, cluster_playlists, clusters_by_name,
        mixed_medoids, mixed_assign, mixed_history, mixed_medoids_blocks,
    )
}
