"""K-means and k-medoids for any number of setups at once.

Points are packed, many to a row of bytes, and cached. One pass over them serves every run that is still moving:
tasks emit sums per run and cluster, never rows, and Spark adds them up. Where many tasks would emit sums of many
clusters, a task takes several partitions, so that sums meet before the shuffle. For medoids the pass keeps the
cluster that it found beside the points, so that the second one needs no search.

Only centers come to the driver, and only while they fit ``model_bytes``. Runs are taken in waves of that size, and a
single run beyond it keeps its centers in tables: blocks of them, as tiles, pass the points in one pass, or in a few
if there are very many.

Rules: a point goes to the nearest center, the lowest cluster number among equals. A cluster
without points goes out, which makes the move infinite for that iteration. A run stops once the
total squared move is at most ``epsilon`` or ``max_iters`` iterations are done. Its error is the
mean squared distance between points and the updated centers of the clusters they were in.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kindred.functions.kernels import (
    distinct, found_task, matrix, medoids_task, pack_task, squared_gaps, sums_of_found_task, sums_task, tile_gaps_task, tile_medoids_task,
    tile_sums_task, tiles_task,
)
from kindred.functions.vectors import squared_distance
from kindred.operators.assign import MODEL_BYTES, assign_points, center_tiles
from kindred.operators.centers import center_shift, error_after_move, initial_centers
from kindred.schema import ALGORITHMS, SETUP_SCHEMA
from kindred.session import materialize

# A partition this many times the mean is too big.
_UNEVEN = 4
# Distances of a pass: per core, enough to pay for a shuffle; per task, enough to pay for its start.
_WORTH_SPREADING = 1_000_000
_WORK_PER_TASK = 100_000_000
# Rows of sums that the tasks of a pass may emit together, beyond which a core's partitions are one task.
_SUM_ROWS = 1_000_000

_HISTORY = "run_id int, iter int, clusters long, delta double, wsos double"
_RUNS = "run_id int, k int, seed int, max_iters int, epsilon double, iters int, delta double, wsos double"
_CENTERS = "run_id int, cluster int, n long, center array<double>"


class Clustering(NamedTuple):
    """Results by ``run_id``: one row per run, center (with ``n``, its points), point and iteration."""

    runs: DataFrame
    centers: DataFrame
    assignments: DataFrame
    history: DataFrame


class _State:
    """A run between iterations: its cluster numbers, its centers and those before them."""

    def __init__(self, setup: Row, labels: np.ndarray, centers: np.ndarray):
        self.setup = setup
        self.labels = self.labels_before = labels
        self.centers = self.before = centers
        self.rows = np.zeros(len(labels), dtype=np.int64)
        self.log: list[tuple] = []

    def open(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and places of the centers that points can go to: equal ones count once."""
        first_of_equals = distinct(self.centers)
        return self.labels[first_of_equals], self.centers[first_of_equals]

    def step(self, labels: np.ndarray, centers: np.ndarray, rows: np.ndarray, error: float) -> None:
        kept = np.isin(self.labels, labels)
        delta = float(squared_gaps(self.centers[kept], centers).sum()) if kept.all() else float("inf")
        self.labels_before, self.before = self.labels, self.centers
        self.labels, self.centers, self.rows = labels, centers, rows
        self.log.append((self.setup["run_id"], len(self.log) + 1, len(labels), delta, error))

    @property
    def done(self) -> bool:
        return bool(self.log) and (
            self.log[-1][3] <= self.setup["epsilon"] or len(self.log) >= self.setup["max_iters"]
        )

    def last_move(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, deciding places and updated places of the centers that have points."""
        return self.labels, self.before[np.isin(self.labels_before, self.labels)], self.centers


def setups(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A setups table from ``(k, seed, max_iters, epsilon)`` tuples, numbered in order."""
    numbered = [(i, k, seed, iters, float(epsilon)) for i, (k, seed, iters, epsilon) in enumerate(rows)]
    return spark.createDataFrame(numbered, SETUP_SCHEMA)


def sweep_k(
    points: DataFrame, k_values: list[int], seed: int, max_iters: int, epsilon: float = 0.0, algorithm: str = "kmeans"
) -> Clustering:
    """One clustering for each K, all else equal."""
    grid = setups(points.sparkSession, [(k, seed, max_iters, epsilon) for k in k_values])
    return cluster(points, grid, algorithm)


def cluster(
    points: DataFrame, setups: DataFrame, algorithm: str = "kmeans", model_bytes: int = MODEL_BYTES
) -> Clustering:
    """Cluster ``points`` (a unique ``id``, ``features`` and columns to carry) by every setup."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"algorithm must be one of {ALGORITHMS}")
    asked = setups.orderBy("run_id").collect()
    _check_setups(asked)
    # The passes read these two columns again and again. A lost block is worked out anew from
    # the source; carried columns are read from there once, with the assignments.
    working = points.select("id", F.col("features").cast("array<double>").alias("features"))
    working = working.persist(StorageLevel.MEMORY_AND_DISK)
    packed = None
    try:
        working, total, tasks = _spread(working, sum(setup["k"] for setup in asked))
        dims = len(working.first()["features"])
        first = materialize(initial_centers(working, asked, total).select("run_id", "cluster", "center"), "first-centers")
        packed = _pack(working, dims, tasks)
        working.unpersist()
        results = []
        for wave in _waves(asked, total, dims, model_bytes):
            ids = [setup["run_id"] for setup in wave]
            starts = first.filter(F.col("run_id").isin(ids))
            if _bytes(wave[0], total, dims) > model_bytes:
                results.append(_in_tables(points, packed, starts, wave[0], algorithm, model_bytes))
            else:
                results.append(_in_memory(points, packed, starts, wave, algorithm))
    finally:
        working.unpersist()
        if packed is not None:
            packed.rows.unpersist()
    return Clustering(*[reduce(DataFrame.unionByName, tables) for tables in zip(*results)])


class _Packed(NamedTuple):
    """Cached ``rows`` of ``ids`` and ``packed`` features, of ``dims`` numbers each, in ``tasks`` partitions."""

    rows: DataFrame
    dims: int
    tasks: int
    id_type: str

    def few(self, rows: DataFrame, clusters: int) -> DataFrame:
        """``rows``, made of these, in partitions whose sums are not too many: a core's together if need be."""
        cores = rows.sparkSession.sparkContext.defaultParallelism
        return rows.coalesce(cores) if self.tasks > cores and self.tasks * clusters > _SUM_ROWS else rows


def _pack(working: DataFrame, dims: int, tasks: int) -> _Packed:
    id_type = working.schema["id"].dataType.simpleString()
    rows = working.select("features", "id").mapInArrow(pack_task(dims), f"ids array<{id_type}>, packed binary")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    rows.count()
    return _Packed(rows, dims, tasks, id_type)


def _spread(working: DataFrame, centers: int) -> tuple[DataFrame, int, int]:
    """Points in partitions that suit the passes, their number and that of the partitions.

    Every pass costs a task time in proportion to its points, so few or uneven partitions (one
    small file, a join on a hot key) are evened out once, by id, where the work is worth it.
    Many tiny ones, which cost more to start than to work through, are put together.
    """
    sizes = [row["count"] for row in working.groupBy(F.spark_partition_id()).count().collect()]
    total = sum(sizes)
    if not total:
        raise ValueError("there are no points")
    cores = working.sparkSession.sparkContext.defaultParallelism
    work = total * centers
    tasks = max(cores, min(len(sizes), work // _WORK_PER_TASK))
    uneven = len(sizes) < cores or max(sizes) > _UNEVEN * total / len(sizes)
    if uneven and work >= cores * _WORTH_SPREADING:
        better = working.repartition(tasks, "id")
    elif len(sizes) > 2 * tasks:
        better = working.coalesce(tasks)
    else:
        return working, total, len(sizes)
    better = better.persist(StorageLevel.MEMORY_AND_DISK)
    better.count()
    working.unpersist()
    return better, total, tasks


def _check_setups(asked: list[Row]) -> None:
    if not asked:
        raise ValueError("there are no setups")
    if len({setup["run_id"] for setup in asked}) < len(asked):
        raise ValueError("run_id must be unique")
    if any(setup["k"] < 1 or setup["max_iters"] < 1 for setup in asked):
        raise ValueError("k and max_iters must be at least 1")


def _bytes(setup: Row, total: int, dims: int) -> int:
    return 8 * dims * min(setup["k"], total)


def _waves(asked: list[Row], total: int, dims: int, model_bytes: int) -> list[list[Row]]:
    """Runs in order, as many together as fit ``model_bytes``; a bigger one is alone."""
    waves: list[list[Row]] = []
    room = 0
    for setup in asked:
        size = _bytes(setup, total, dims)
        if size > room:
            waves.append([])
            room = model_bytes
        waves[-1].append(setup)
        room -= size
    return waves


def _in_memory(points: DataFrame, packed: _Packed, starts: DataFrame, wave: list[Row], algorithm: str) -> Clustering:
    spark = points.sparkSession
    first = _by_run(starts)
    states = [_State(setup, first[setup["run_id"]]["cluster"], first[setup["run_id"]]["center"]) for setup in wave]
    while live := [state for state in states if not state.done]:
        _iterate(packed, live, algorithm)

    last = [state.log[-1] for state in states]
    runs = spark.createDataFrame(
        [(*state.setup[:5], log[1], log[3], log[4]) for state, log in zip(states, last)], _RUNS
    )
    history = spark.createDataFrame([row for state in states for row in state.log], _HISTORY)
    deciding = spark.sparkContext.broadcast(
        [(state.setup["run_id"], *state.last_move()) for state in states]
    )
    # Written once, so that no use of them repeats the distances.
    assignments = materialize(assign_points(points, deciding), "assignments")
    return Clustering(runs, _centers_table(spark, states), assignments, history)


def _sums_schema(dims: int) -> str:
    return ", ".join(["run_id int, cluster int, n long, sse double", *[f"s{i} double" for i in range(dims)]])


def _added_up(sums: DataFrame, dims: int) -> DataFrame:
    """Sums of all tasks: ``(run_id, cluster, n, sse, sums)``."""
    names = [f"s{i}" for i in range(dims)]
    totals = sums.groupBy("run_id", "cluster").agg(*[F.sum(name).alias(name) for name in ["n", "sse", *names]])
    return totals.select("run_id", "cluster", "n", "sse", F.array(*names).alias("sums"))


def _iterate(packed: _Packed, live: list[_State], algorithm: str) -> None:
    context, dims = packed.rows.sparkSession.sparkContext, packed.dims
    opened = [(s.setup["run_id"], *s.open()) for s in live]
    model = context.broadcast(opened)
    clusters = sum(len(labels) for _, labels, _ in opened)
    schema = _sums_schema(dims)
    beside = None
    if algorithm == "kmedoids":
        beside = _found_beside(packed, model, len(live))
        positions = [f"c{i}" for i in range(len(live))]
        sums = packed.few(beside, clusters).select("packed", *positions).mapInArrow(sums_of_found_task(model, dims), schema)
    else:
        sums = packed.few(packed.rows, clusters).select("packed").mapInArrow(sums_task(model, dims), schema)
    found = _by_run(_added_up(sums, dims))

    means, errors = {}, {}
    for state in live:
        run_id = state.setup["run_id"]
        part = found[run_id]
        means[run_id] = part["sums"] / part["n"][:, None]
        # Squared error about the mean, from the error about the center before it.
        shift = squared_gaps(means[run_id], state.centers[np.isin(state.labels, part["cluster"])])
        errors[run_id] = np.maximum(part["sse"] - part["n"] * shift, 0.0)

    if algorithm == "kmedoids":
        medoids = _medoids(packed, beside, opened, found, means, errors, clusters)
        beside.unpersist()
    model.unpersist()
    for state in live:
        run_id = state.setup["run_id"]
        rows, centers, error = found[run_id]["n"], means[run_id], errors[run_id]
        if algorithm == "kmedoids":
            centers = medoids[run_id]["center"]
            error = error + rows * squared_gaps(centers, means[run_id])
        state.step(found[run_id]["cluster"], centers, rows, float(error.sum() / rows.sum()))


def _found_beside(packed: _Packed, model, runs: int) -> DataFrame:
    """The packed points with the nearest center of each run beside them, cached for two passes."""
    positions = ", ".join(f"c{i} binary" for i in range(runs))
    schema = f"ids array<{packed.id_type}>, packed binary, {positions}"
    beside = packed.rows.select("ids", "packed").mapInArrow(found_task(model, packed.dims), schema)
    return beside.persist(StorageLevel.MEMORY_AND_DISK)


def _medoids(packed: _Packed, beside: DataFrame, opened: list, found: dict, means: dict, errors: dict, clusters: int) -> dict:
    """The member nearest to the mean of each cluster, from the clusters found in the pass before."""
    model = []
    for run_id, labels, _ in opened:
        part = found[run_id]
        # Where a position of that pass is among the clusters that got points; others have none.
        places = np.searchsorted(part["cluster"], labels)
        model.append((run_id, part["cluster"], places, means[run_id], errors[run_id] / part["n"]))
    shared = packed.rows.sparkSession.sparkContext.broadcast(model)
    positions = [f"c{i}" for i in range(len(opened))]
    schema = f"run_id int, cluster int, gap double, id {packed.id_type}, center array<double>"
    best = packed.few(beside, clusters).select("packed", "ids", *positions).mapInArrow(medoids_task(shared, packed.dims), schema)
    medoids = _by_run(_nearest_members(best).drop("id"))
    shared.unpersist()
    return medoids


def _nearest_members(best: DataFrame) -> DataFrame:
    """Of the members that tasks found nearest to a mean the one, the lowest id among equals."""
    first = F.min_by(F.struct("id", "center"), F.struct("gap", "id")).alias("best")
    return best.groupBy("run_id", "cluster").agg(first).select("run_id", "cluster", "best.id", "best.center")


def _by_run(table: DataFrame) -> dict[int, dict[str, np.ndarray]]:
    """A table of one row per run and cluster as arrays by run, in cluster order."""
    rows = table.toArrow().sort_by([("run_id", "ascending"), ("cluster", "ascending")])
    if not rows.num_rows:
        return {}
    runs = rows["run_id"].to_numpy()
    cuts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]).tolist() + [len(runs)]
    columns = {}
    for name in rows.column_names:
        column = rows[name].combine_chunks()
        columns[name] = matrix(column) if pa.types.is_nested(column.type) else column.to_numpy()
    return {
        int(runs[a]): {name: column[a:b] for name, column in columns.items()} for a, b in zip(cuts, cuts[1:])
    }


def _centers_table(spark: SparkSession, states: list[_State]) -> DataFrame:
    rows = pa.table(
        {
            "run_id": np.concatenate([np.full(len(s.labels), s.setup["run_id"], dtype=np.int32) for s in states]),
            "cluster": np.concatenate([s.labels for s in states]),
            "n": np.concatenate([s.rows for s in states]),
            "center": pa.FixedSizeListArray.from_arrays(
                np.concatenate([s.centers.ravel() for s in states]), states[0].centers.shape[1]
            ).cast(pa.list_(pa.float64())),
        }
    )
    return spark.createDataFrame(rows, _CENTERS)


def _in_tables(
    points: DataFrame, packed: _Packed, starts: DataFrame, setup: Row, algorithm: str, model_bytes: int
) -> Clustering:
    """One run whose centers are too many to broadcast: they stay in tables throughout."""
    spark = points.sparkSession
    run_id, dims = setup["run_id"], packed.dims
    centers, found = starts, None
    log: list[tuple] = []
    while not log or (log[-1][3] > setup["epsilon"] and len(log) < setup["max_iters"]):
        if found is not None:
            found.unpersist()
        found = _searched(packed, centers, model_bytes)
        # A task's own sums are added up before the shuffle: a row for each cluster that its points are in.
        near = packed.few(found, setup["k"]).select("packed", "cluster", "distance")
        sums = _added_up(near.mapInArrow(tile_sums_task(run_id, dims), _sums_schema(dims)), dims)
        mean = F.transform("sums", lambda total: total / F.col("n"))
        means = materialize(sums.select("run_id", "cluster", "n", "sse", mean.alias("center")), "centers")
        moved = means
        if algorithm == "kmedoids":
            moved = materialize(_medoids_in_tables(packed, found, centers, means, model_bytes, run_id), "centers")
        moved = moved.select("run_id", "cluster", "n", "center")
        delta = center_shift(centers, moved).first()["delta"]
        error = error_after_move(centers, means, moved).first()["wsos"]
        log.append((run_id, len(log) + 1, moved.count(), delta, error))
        centers = moved

    runs = spark.createDataFrame([(*setup[:5], log[-1][1], log[-1][3], log[-1][4])], _RUNS)
    schema = f"id {packed.id_type}, cluster int, distance double"
    placed = reduce(DataFrame.unionByName, [
        found.select("ids", "packed", "cluster").mapInArrow(tile_gaps_task(tiles, dims), schema) for tiles in center_tiles(centers, model_bytes)
    ]).withColumn("run_id", F.lit(run_id))
    kept = [name for name in points.columns if name != "features"]
    if kept != ["id"]:
        # Carried columns come back by id.
        placed = points.select(*kept).join(placed, "id")
    assignments = materialize(placed.select(*kept, "run_id", "cluster", "distance"), "assignments")
    found.unpersist()
    return Clustering(runs, centers, assignments, spark.createDataFrame(log, _HISTORY))


def _searched(packed: _Packed, centers: DataFrame, model_bytes: int) -> DataFrame:
    """The packed points with cluster and distance of the nearest center beside them, cached."""
    schema = f"ids array<{packed.id_type}>, packed binary, cluster binary, distance binary"
    found, before = packed.rows.select("ids", "packed"), None
    for tiles in center_tiles(centers, model_bytes):
        found = found.mapInArrow(tiles_task(tiles, packed.dims), schema).persist(StorageLevel.MEMORY_AND_DISK)
        if before is not None:
            # The next pass goes on from this one, which is then no longer needed.
            found.count()
            before.unpersist()
        before = found
    return found


def _medoids_in_tables(
    packed: _Packed, found: DataFrame, before: DataFrame, means: DataFrame, model_bytes: int, run_id: int
) -> DataFrame:
    """``(run_id, cluster, n, center)``: the members nearest to the means, which pass as tiles."""
    was = before.select("run_id", "cluster", F.col("center").alias("was"))
    about = F.greatest(F.col("sse") - F.col("n") * squared_distance(F.col("center"), F.col("was")), F.lit(0.0))
    targets = means.join(was, ["run_id", "cluster"]).select("cluster", "center", (about / F.col("n")).alias("spread"))
    targets = materialize(targets, "means")
    schema = f"run_id int, cluster int, gap double, id {packed.id_type}, center array<double>"
    best = reduce(DataFrame.unionByName, [
        found.select("ids", "packed", "cluster").mapInArrow(tile_medoids_task(tiles, run_id, packed.dims), schema)
        for tiles in center_tiles(targets, model_bytes, "spread")
    ])
    sizes = means.select("run_id", "cluster", "n")
    return _nearest_members(best).join(sizes, ["run_id", "cluster"]).select("run_id", "cluster", "n", "center")
