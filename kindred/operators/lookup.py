"""Questions put to finished assignments."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import materialize, path_exists
from kindred.sources.sinks import id_index


def radio(assignments: DataFrame, song_id: object) -> DataFrame:
    """The other songs in the cluster of one song, for every run."""
    home = assignments.filter(F.col("id") == F.lit(song_id)).select("run_id", "cluster").distinct()
    # One row for each run.
    return assignments.join(F.broadcast(home), ["run_id", "cluster"]).filter(F.col("id") != F.lit(song_id))


def radio_from_files(spark: SparkSession, path: str, song_id: object) -> DataFrame:
    """The same from assignments written at ``path``: only the folders of the song's id and of its clusters are opened.

    Assignments without an index by id are searched as a whole.
    """
    assignments = spark.read.parquet(path)
    if not path_exists(spark, id_index(path)):
        return radio(assignments, song_id)
    index = spark.read.parquet(id_index(path))
    wanted = F.lit(song_id).cast(index.schema["id"].dataType)
    there = index.filter((F.col("bucket") == F.pmod(F.xxhash64(wanted), F.col("buckets"))) & (F.col("id") == wanted))
    # One row for each run.
    homes = there.select("run_id", "cluster").distinct().collect()
    in_home = [
        (F.col("run_id") == run_id) & (F.col("group") == F.pmod(F.lit(cluster), F.col("groups"))) & (F.col("cluster") == cluster)
        for run_id, cluster in homes
    ]
    others = assignments.filter(reduce(or_, in_home, F.lit(False)) & (F.col("id") != wanted))
    return others.drop("groups", "group")


def cluster_playlists(songs: DataFrame, assignments: DataFrame) -> DataFrame:
    """Songs with their clusters, joined by id."""
    return songs.join(assignments.select("id", "run_id", "cluster"), "id")


def clusters_by_name(songs: DataFrame, named: DataFrame) -> DataFrame:
    """Songs with the clusters of their title and artist, for assignments that carry no id.

    Names repeat, so the assignments are first counted per name and cluster: each song meets
    every cluster of its name once, with the number of ``copies`` there, rather than every
    song of the same name.
    """
    counted = named.groupBy("title", "artist", "cluster").agg(F.count(F.lit(1)).alias("copies"))
    return songs.join(counted, ["title", "artist"])


def sorted_assignments(assignments: DataFrame) -> DataFrame:
    """Assignments in order of run, cluster and id.

    They are written down first: a global sort reads its input twice, once for a sample.
    """
    return materialize(assignments, "assignments").orderBy("run_id", "cluster", "id")
