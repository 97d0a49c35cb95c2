"""Headline timings: one JSON line.

Reads the tables in ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Every result is worked out in
full and thrown away. Every query runs twice, and the second run is the figure (``first`` has the other),
so that warming up does not set it. The clusterings run as many iterations as they are given, so seconds
follow points x clusters x iterations, the measure the published cluster runs scale by.
"""

from __future__ import annotations

import json
import os
import time

from kindred.plans.clustering import cluster, setups, sweep_k
from kindred.queries import preparing, tables
from kindred.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def finish(*frames) -> None:
    for frame in frames:
        frame.write.format("noop").mode("overwrite").save()


def kmeans_lines_k100(spark) -> int:
    """All lines, four features, K=100, 10 iterations."""
    found = cluster(tables.line_points(spark, FOLDER), setups(spark, [(100, 7, 10, 0.0)]))
    finish(found.assignments)
    return 100 * found.runs.first()["iters"] * tables.read(spark, FOLDER, "lineitem").count()


def kmeans_lines_k1000(spark) -> int:
    """All lines, four features, K=1000, 10 iterations."""
    found = cluster(tables.line_points(spark, FOLDER), setups(spark, [(1000, 7, 10, 0.0)]))
    finish(found.assignments)
    return 1000 * found.runs.first()["iters"] * tables.read(spark, FOLDER, "lineitem").count()


def kmeans_songs_k1000(spark) -> int:
    """All songs, thirteen features, K=1000, 10 iterations."""
    found = cluster(tables.song_points(spark, FOLDER), setups(spark, [(1000, 7, 10, 0.0)]))
    finish(found.assignments)
    return 1000 * found.runs.first()["iters"] * tables.read(spark, FOLDER, "part").count()


def kmeans_wide_lines_k5000(spark) -> int:
    """All lines, thirteen features, K=5000, 2 iterations."""
    found = cluster(tables.wide_line_points(spark, FOLDER), setups(spark, [(5000, 7, 2, 0.0)]))
    finish(found.assignments)
    return 5000 * found.runs.first()["iters"] * tables.read(spark, FOLDER, "lineitem").count()


def kmeans_tables_k200(spark) -> int:
    """All songs, thirteen features, K=200 with room for 100 centers: the centers stay in tables, 2 iterations."""
    points = tables.song_points(spark, FOLDER)
    found = cluster(points, setups(spark, [(200, 7, 2, 0.0)]), model_bytes=100 * 8 * 13)
    finish(found.assignments)
    return 200 * found.runs.first()["iters"] * tables.read(spark, FOLDER, "part").count()


def kmedoids_lines_k100(spark) -> int:
    found = cluster(tables.line_points(spark, FOLDER), setups(spark, [(100, 7, 10, 0.0)]), "kmedoids")
    finish(found.assignments)
    return 2 * 100 * found.runs.first()["iters"] * tables.read(spark, FOLDER, "lineitem").count()


def grid_songs_12_setups(spark) -> int:
    """K=100 to 2300 by 200, 20 iterations each, in one clustering."""
    grid = [(k, 123, 20, 0.0) for k in range(100, 2301, 200)]
    found = cluster(tables.song_points(spark, FOLDER), setups(spark, grid))
    finish(found.assignments)
    work = sum(row["k"] * row["iters"] for row in found.runs.collect())
    return work * tables.read(spark, FOLDER, "part").count()


def sweep_lines(spark) -> int:
    found = sweep_k(tables.line_points(spark, FOLDER), [2, 4, 8, 16, 32], seed=7, max_iters=10)
    finish(found.runs)
    work = sum(row["k"] * row["iters"] for row in found.runs.collect())
    return work * tables.read(spark, FOLDER, "lineitem").count()


def prepared(name: str):
    def run(spark) -> int:
        finish(preparing.QUERIES[name](spark, FOLDER))
        return 0

    return run


RUNS = {
    query.__name__: query
    for query in (
        kmeans_lines_k100, kmeans_lines_k1000, kmeans_songs_k1000, kmeans_wide_lines_k5000, kmeans_tables_k200,
        kmedoids_lines_k100, grid_songs_12_setups, sweep_lines,
    )
} | {
    name: prepared(name)
    for name in (
        "playlist_adjacency", "playlist_adjacency_parts", "nested_songs", "dedup_songs", "enrich_success",
        "song_playlists", "songs_with_playlists", "feature_lines", "balanced_buckets",
    )
}


def main() -> None:
    spark = build_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Workers and code paths are warm before the clock starts.
    finish(cluster(tables.song_points(spark, FOLDER), setups(spark, [(2, 1, 1, 0.0)])).assignments)
    first, seconds, rates = {}, {}, {}
    for name, query in RUNS.items():
        for taken in (first, seconds):
            start = time.perf_counter()
            distances = query(spark)
            taken[name] = round(time.perf_counter() - start, 3)
        if distances:
            rates[name] = round(distances / seconds[name] / 1e6, 1)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first": first,
                "million_distances_per_sec": rates,
                "sf": FOLDER.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
