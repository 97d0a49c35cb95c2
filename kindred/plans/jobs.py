"""The whole programs, from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import lookup, prepare
from kindred.operators.centers import name_centers
from kindred.operators.scale import scaled_features
from kindred.plans import clustering
from kindred.plans.choose_k import elbow
from kindred.schema import FEATURES
from kindred.session import materialize
from kindred.sources import results, sinks, slices, songs


def create_data(
    spark: SparkSession, slices_path: str, features_path: str, output: str, max_items: int = prepare.MAX_ITEMS
) -> None:
    """Playlist slices and a feature table (Parquet: ``id`` and the features) to song tables.

    Writes under ``output``: ``playlists`` (text), ``songs`` (text), ``enriched`` (Parquet by
    status), ``features`` (feature lines, which :func:`sweep` and :func:`grid` read, as they do
    ``enriched/status=success``) and ``songs_with_playlists`` (text; one line per part of a song's list).
    The JSON is parsed once, and steps go from table to table; text is only for others to read.
    """
    playlists = materialize(slices.read_playlists(spark, slices_path), "playlists")
    sinks.write_adjacency(playlists.withColumn("part", F.lit(0)), f"{output}/playlists")
    tracks = slices.read_tracks(spark, slices_path)
    unique = materialize(prepare.unique_songs(tracks, ["slice", "pid", "pos"]), "songs")
    sinks.write_unique_songs(unique, f"{output}/songs")
    sinks.write_enriched(prepare.enrich(unique, spark.read.parquet(features_path), FEATURES), f"{output}/enriched")

    # Only songs with features go on; pairs on other songs are left out by the join.
    enriched = prepare.successes(spark.read.parquet(f"{output}/enriched"))
    sinks.write_features(enriched, f"{output}/features")
    pairs = prepare.adjacency_pairs(playlists)
    listed = prepare.songs_with_playlists(enriched, prepare.song_playlists(pairs, max_items))
    sinks.write_songs_with_playlists(listed, f"{output}/songs_with_playlists")


def sweep(
    spark: SparkSession,
    songs_path: str,
    output: str,
    errors_path: str,
    k_values: list[int],
    epsilon: float,
    max_iters: int,
    seed: int,
    algorithm: str = "kmeans",
    form: str = "text",
) -> clustering.Clustering:
    """Cluster a feature file for every K; writes assignments by run and the error of each K."""
    points = scaled_features(songs.read_songs(spark, songs_path, form), FEATURES, ["id", "title", "artist"])
    found = clustering.sweep_k(points, k_values, seed, max_iters, epsilon, algorithm)
    sinks.write_clustering(found, output)
    sinks.write_errors(found.runs, errors_path)
    return found


def grid(
    spark: SparkSession,
    songs_path: str,
    setups_path: str,
    output: str,
    algorithm: str = "kmeans",
    named: bool = False,
    form: str = "text",
) -> clustering.Clustering:
    """Cluster a feature file by every line of a setup file; centers carry song names."""
    points = scaled_features(songs.read_songs(spark, songs_path, form), FEATURES, ["id", "title", "artist"])
    found = clustering.cluster(points, results.read_setups(spark, setups_path), algorithm)
    found = found._replace(centers=name_centers(found.centers, points if named else None))
    sinks.write_clustering(found, output)
    return found


def radio(spark: SparkSession, assignments_path: str, song_id: str) -> DataFrame:
    """The other songs in the clusters of a song, from written assignments."""
    return lookup.radio_from_files(spark, assignments_path, song_id)


def choose_k(spark: SparkSession, errors_path: str, whole_results: bool = False) -> DataFrame:
    """The elbow table from written errors, of either text shape."""
    read = results.read_run_errors if whole_results else results.read_errors
    return elbow(read(spark, errors_path).select("k", "wsos"))
