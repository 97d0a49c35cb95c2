"""Writers. Each replaces what an earlier run left at the same path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.text import encode_list, feature_line, one_field
from kindred.session import materialize

#: About how many rows a folder of clusters or of ids holds, and how many folders there are at most.
ROWS_PER_FOLDER = 1_000_000
MOST_FOLDERS = 1_000


def write_adjacency(playlists: DataFrame, path: str, in_order: bool = False) -> None:
    """``pid<TAB>part<TAB>id,id,...`` lines; ``playlists`` has ``(pid, part, track_ids)``.

    A list of several parts is several lines, and their numbers keep its order. ``in_order`` sorts the lines by pid
    and part, over all files in the order of their names; range partitioning samples its input, so that is written before.
    """
    if in_order:
        placed = materialize(playlists.select("pid", "part", "track_ids"), "adjacency")
        playlists = placed.repartitionByRange("pid", "part").sortWithinPartitions("pid", "part")
    numbers = [F.col(name).cast("string") for name in ("pid", "part")]
    _write_lines(playlists.select(F.concat_ws("\t", *numbers, F.array_join("track_ids", ",")).alias("value")), path)


def write_unique_songs(songs: DataFrame, path: str) -> None:
    """``id<TAB>title<TAB>artist`` lines; tabs and line ends in a name become blanks, null is empty."""
    pieces = [one_field(F.col(name)) for name in ("id", "title", "artist")]
    _write_lines(songs.select(F.concat_ws("\t", *pieces).alias("value")), path)


def write_enriched(enriched: DataFrame, path: str) -> None:
    """Songs with and without features as Parquet, one folder for each status, in one pass."""
    enriched.write.mode("overwrite").partitionBy("status").parquet(path)


def write_features(songs: DataFrame, path: str) -> None:
    """Feature lines of 16 fields."""
    _write_lines(songs.select(feature_line().alias("value")), path)


def write_songs_with_playlists(songs: DataFrame, path: str) -> None:
    """Feature lines with ``,part,[pid;pid]`` after them; ``songs`` has ``part`` and ``playlists``."""
    line = F.concat_ws(",", feature_line(), F.col("part").cast("string"), encode_list(F.col("playlists")))
    _write_lines(songs.select(line.alias("value")), path)


def write_setups(setups: DataFrame, path: str) -> None:
    """``K seed maxIters epsilon`` lines in run order, as one file (one line per run)."""
    line = F.concat_ws(" ", *[F.col(name).cast("string") for name in ("k", "seed", "max_iters", "epsilon")])
    _write_lines(setups.coalesce(1).sortWithinPartitions("run_id").select(line.alias("value")), path)


def write_assignments(assignments: DataFrame, runs: DataFrame, path: str) -> None:
    """Assignments as Parquet, a folder for each K, run and group of clusters, ordered by cluster within its files,
    and beside them an index by id (see :func:`write_id_index`).

    Range partitioning by run, cluster and a hash of the id spreads a big cluster over many files.
    It samples its input, so the assignments are worked out and written down before.
    """
    placed = materialize(assignments, "assignments")
    # The runs table has one row for each setup.
    sizes = placed.groupBy("run_id").agg(_folders(F.count(F.lit(1))).alias("groups")).join(F.broadcast(runs.select("run_id", "k")), "run_id")
    sizes = materialize(sizes, "run-sizes")
    ranged = placed.repartitionByRange("run_id", "cluster", F.xxhash64("id")).join(F.broadcast(sizes), "run_id")
    ranged = ranged.withColumn("group", F.pmod("cluster", "groups"))
    # Folder columns first, so that the writer keeps this order.
    ranged = ranged.sortWithinPartitions("k", "run_id", "groups", "group", "cluster", "id")
    ranged.write.mode("overwrite").partitionBy("k", "run_id", "groups", "group").parquet(path)
    write_id_index(placed, path)


def write_id_index(assignments: DataFrame, path: str) -> None:
    """``(id, run_id, cluster)`` beside the assignments at ``path``, a folder for each bucket of ids, ordered by id.

    A question about one id opens the folder of its bucket, and there only what Bloom filters and the order let through.
    """
    buckets = assignments.agg(_folders(F.count(F.lit(1)))).first()[0]
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    rows = assignments.select(F.lit(buckets).alias("buckets"), bucket.alias("bucket"), "id", "run_id", "cluster")
    rows = rows.repartition("bucket", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))).sortWithinPartitions("buckets", "bucket", "id")
    filters = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.expected.ndv#id": str(ROWS_PER_FOLDER)}
    rows.write.options(**filters).mode("overwrite").partitionBy("buckets", "bucket").parquet(id_index(path))


def id_index(path: str) -> str:
    """Where the index by id of the assignments at ``path`` is."""
    return path.rstrip("/") + "_by_id"


def _folders(rows: Column) -> Column:
    return F.least(F.greatest(F.ceil(rows / ROWS_PER_FOLDER), F.lit(1)), F.lit(MOST_FOLDERS)).cast("int")


def write_assignment_lines(assignments: DataFrame, path: str) -> None:
    """``(cluster,[title,artist])`` lines in cluster order, for one run."""
    line = F.format_string("(%d,[%s,%s])", "cluster", "title", F.translate("artist", ",", ""))
    ordered = assignments.repartitionByRange("cluster", F.xxhash64("id")).sortWithinPartitions("cluster", "id")
    _write_lines(ordered.select(line.alias("value")), path)


def write_errors(errors: DataFrame, path: str) -> None:
    """``Array(k, error)`` lines as one file (one line per K)."""
    line = F.format_string("Array(%s, %s)", F.col("k").cast("double").cast("string"), F.col("wsos").cast("string"))
    _write_lines(errors.coalesce(1).sortWithinPartitions("k").select(line.alias("value")), path)


def write_clustering(clustering, path: str) -> None:
    """The runs, centers and assignments of a clustering, each as a table under ``path``."""
    clustering.runs.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs")
    clustering.centers.write.mode("overwrite").parquet(f"{path}/centers")
    write_assignments(clustering.assignments, clustering.runs, f"{path}/assignments")


def _write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)
