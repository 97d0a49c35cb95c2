"""Batch arithmetic for the passes over points: NumPy on Arrow batches, inside Spark tasks.

A *model* is a broadcast list of ``(run_id, labels, centers, ...)`` tuples of plain arrays, one
for each run. Labels ascend, so the first of equally near centers is the lowest cluster number.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# Distances and points taken at once, few enough to stay in a core's cache.
BLOCK = 1 << 19
BLOCK_ROWS = 4096
# Bytes of features in one packed row. A batch has ten thousand rows: 10 MB of features, whatever the size of a partition.
PACKED_BYTES = 1024
# Bytes of ids in one, which go through the passes too: 5 MB a batch.
PACKED_ID_BYTES = 512


def matrix(column) -> np.ndarray:
    """An Arrow list column as a matrix with one row per list."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or (lengths != lengths[0]).any():
        raise ValueError("feature vectors must all have the same length")
    return flat.reshape(len(column), -1)


def squared_gaps(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distance of each row of one matrix to the same row of the other."""
    gap = left - right
    return np.einsum("ij,ij->i", gap, gap)


def distinct(centers: np.ndarray) -> np.ndarray:
    """Positions of the first of every set of equal centers: the only ones a point can go to."""
    return np.sort(np.unique(centers, axis=0, return_index=True)[1])


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of the nearest center and the squared distance to it, for every point.

    A single-precision matrix product ranks the centers. Where its rounding could hide which is
    nearest, the few candidates are compared by plain differences in double precision, so the
    answer is exact and ties go to the first center.
    """
    size, dims = centers.shape
    best, distance = np.empty(len(points), dtype=np.int64), np.empty(len(points))
    norms = np.einsum("ij,ij->i", centers, centers)
    sizes = np.einsum("ij,ij->i", points, points) + norms.max()
    precision = np.float32 if sizes.max() < 1e30 else np.float64
    slack = (8 * (dims + 4) * np.finfo(precision).eps * sizes + 1e-37).astype(precision)

    # A point with a 1 after it, times the centers with their norms below: |c|^2 - 2 p.c.
    turned = np.vstack([-2.0 * centers.T, norms]).astype(precision)
    step = max(1, min(BLOCK // size, BLOCK_ROWS, len(points)))
    wide, gaps = np.ones((step, dims + 1), dtype=precision), np.empty((step, size), dtype=precision)
    for start in range(0, len(points), step):
        rows = slice(start, start + step)
        some = points[rows]
        wide[: len(some), :dims] = some
        np.matmul(wide[: len(some)], turned, out=gaps[: len(some)])
        chosen = _least(some, centers, gaps[: len(some)], slack[rows])
        best[rows], distance[rows] = chosen, squared_gaps(some, centers[chosen])
    return best, distance


def _least(points, centers, gaps, slack) -> np.ndarray:
    """The nearest center from ranks that are off by up to ``slack``; overwrites the ranks."""
    rows = np.arange(len(points))
    best = gaps.argmin(axis=1)
    limit = gaps[rows, best] + slack
    gaps[rows, best] = np.inf
    unsure = np.flatnonzero(gaps.min(axis=1) <= limit)
    gaps[rows, best] = -np.inf
    step = max(1, 2 * BLOCK // centers.size)
    for start in range(0, len(unsure), step):
        some = unsure[start : start + step]
        best[some] = _nearest_candidate(points[some], centers, gaps[some] <= limit[some, None])
    return best


def _nearest_candidate(points, centers, near) -> np.ndarray:
    """The first nearest center of each point among those marked ``near``."""
    row, candidate = np.nonzero(near)
    exact = squared_gaps(points[row], centers[candidate])
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(exact, starts)
    hits = np.flatnonzero(exact == least[row])
    first = hits[np.r_[True, row[hits][1:] != row[hits][:-1]]]
    return candidate[first]


def pack_task(dims: int):
    """Points as rows of many points each: ``ids`` and ``packed``, their features as bytes. Input: features and id."""
    most = PACKED_BYTES // (8 * dims)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.ascontiguousarray(matrix(batch.column(0)))
            if points.shape[1] != dims:
                raise ValueError("feature vectors must all have the same length")
            step = max(1, min(most, PACKED_ID_BYTES * len(points) // max(1, batch.column(1).nbytes)))
            starts = np.arange(0, len(points), step)
            ends = np.append(starts, len(points)).astype(np.int32)
            data = pa.py_buffer(points)
            packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends * np.int32(8 * dims)), data])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), batch.column(1)), packed], names=["ids", "packed"])

    return run


def unpacked(column, kind, width: int = 1) -> np.ndarray:
    """The numbers of all values of a binary column, one after the other, ``width`` to a row."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind)
    return values.reshape(-1, width) if width > 1 or kind == np.float64 else values


def like_packed(numbers: np.ndarray, column, width: int) -> pa.Array:
    """One number per point as bytes, in rows as those of a packed column of ``width`` features."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    ends = (offsets - offsets[0]) // (8 * width) * numbers.itemsize
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


class _Sums:
    """Rows, squared error and feature sums of the clusters of one run."""

    def __init__(self, run_id: int, labels: np.ndarray, dims: int):
        self.run_id, self.labels = run_id, labels
        self.rows, self.error, self.sums = np.zeros(len(labels)), np.zeros(len(labels)), np.zeros((dims, len(labels)))

    def add(self, points: np.ndarray, best: np.ndarray, distance: np.ndarray) -> None:
        size = len(self.labels)
        self.rows += np.bincount(best, minlength=size)
        self.error += np.bincount(best, weights=distance, minlength=size)
        for dim in range(points.shape[1]):
            self.sums[dim] += np.bincount(best, weights=points[:, dim], minlength=size)

    def batches(self):
        """``run_id, cluster, n, sse, s0, s1, ...``, one row per cluster that got points."""
        used = np.flatnonzero(self.rows)
        if len(used):
            columns = [
                pa.array(np.full(len(used), self.run_id, dtype=np.int32)), pa.array(self.labels[used]),
                pa.array(self.rows[used].astype(np.int64)), pa.array(self.error[used]), *[pa.array(dim[used]) for dim in self.sums],
            ]
            names = ["run_id", "cluster", "n", "sse", *[f"s{i}" for i in range(len(self.sums))]]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def sums_task(model, dims: int):
    """Per task: rows, squared error and feature sums of every cluster of every run, from packed points."""

    def run(batches):
        runs = model.value
        totals = [_Sums(run_id, labels, dims) for run_id, labels, _ in runs]
        for batch in batches:
            if batch.num_rows:
                points = unpacked(batch.column(0), np.float64, dims)
                for (_, _, centers), total in zip(runs, totals):
                    total.add(points, *nearest(points, centers))
        for total in totals:
            yield from total.batches()

    return run


def found_task(model, dims: int):
    """Packed points (``ids``, ``packed``) with the position of the nearest center in each run: ``c0, c1, ...``."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = unpacked(batch.column(1), np.float64, dims)
            best = [nearest(points, centers)[0].astype(np.int32) for _, _, centers in model.value]
            columns = [batch.column(0), batch.column(1), *[like_packed(one, batch.column(1), dims) for one in best]]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "packed", *[f"c{i}" for i in range(len(best))]])

    return run


def sums_of_found_task(model, dims: int):
    """The same sums as :func:`sums_task` from packed points and the positions found for them."""

    def run(batches):
        runs = model.value
        totals = [_Sums(run_id, labels, dims) for run_id, labels, _ in runs]
        for batch in batches:
            if batch.num_rows:
                points = unpacked(batch.column(0), np.float64, dims)
                for i, ((_, _, centers), total) in enumerate(zip(runs, totals), 1):
                    best = unpacked(batch.column(i), np.int32)
                    total.add(points, best, squared_gaps(points, centers[best]))
        for total in totals:
            yield from total.batches()

    return run


class _Medoids:
    """The members nearest to the means of the clusters of one run so far."""

    def __init__(self, run_id: int, labels: np.ndarray):
        self.run_id, self.labels, self.picked, self.id_type = run_id, labels, None, None

    def add(self, points: np.ndarray, ids: pa.Array, cluster: np.ndarray, gap: np.ndarray) -> None:
        self.id_type = ids.type
        frame = ids.to_pandas()
        chosen = _least_per_cluster(cluster, gap, frame)
        picked = pd.DataFrame({"c": cluster[chosen], "gap": gap[chosen], "id": frame.iloc[chosen].to_numpy(), "x": list(points[chosen])})
        if self.picked is not None:
            picked = pd.concat([self.picked, picked], ignore_index=True)
            picked = picked.iloc[_least_per_cluster(picked["c"].to_numpy(), picked["gap"].to_numpy(), picked["id"])]
        self.picked = picked

    def batches(self):
        """``run_id, cluster, gap, id, center``."""
        if self.picked is not None:
            picked = self.picked
            columns = [
                pa.array(np.full(len(picked), self.run_id, dtype=np.int32)), pa.array(self.labels[picked["c"].to_numpy()]),
                pa.array(picked["gap"].to_numpy()), pa.array(picked["id"].tolist(), type=self.id_type),
                pa.array(picked["x"].tolist(), type=pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["run_id", "cluster", "gap", "id", "center"])


def medoids_task(model, dims: int):
    """Per task: the member of each cluster nearest to the cluster's mean, without a search.

    Input columns are packed points, ids, and the positions found for them. The model has for each run the numbers of
    the updated clusters, the place among them of each position, their means and mean squared errors. Distances
    count in units of the cluster's mean squared error, to nine places, so that members equally near up to rounding
    tie and the lowest id is taken.
    """

    def run(batches):
        runs = model.value
        best = [_Medoids(run_id, labels) for run_id, labels, *_ in runs]
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids = unpacked(batch.column(0), np.float64, dims), batch.column(1).flatten()
            for i, ((_, _, places, means, spreads), one) in enumerate(zip(runs, best), 2):
                cluster = places[unpacked(batch.column(i), np.int32)]
                one.add(points, ids, cluster, relative_gap(squared_gaps(points, means[cluster]), spreads[cluster]))
        for one in best:
            yield from one.batches()

    return run


class Tiles:
    """Centers in blocks, each with its cluster numbers, ascending within blocks and from block to block."""

    def __init__(self, blocks: list):
        self.blocks = blocks

    def nearer(self, points: np.ndarray, cluster: np.ndarray, distance: np.ndarray) -> None:
        """Put in the nearer of the centers so far and those of all blocks; a tie leaves the lower cluster."""
        for block in self.blocks:
            labels, centers = block.value[:2]
            best, gap = nearest(points, centers)
            closer = gap < distance
            cluster[closer] = labels[best[closer]]
            distance[closer] = gap[closer]

    def places(self, cluster: np.ndarray):
        """For each block: the points whose cluster it has, the places of these clusters in it, and its arrays."""
        for block in self.blocks:
            labels = block.value[0]
            at = np.minimum(np.searchsorted(labels, cluster), len(labels) - 1)
            own = np.flatnonzero(labels[at] == cluster)
            if len(own):
                yield own, at[own], block.value


def tiles_task(tiles: Tiles, dims: int):
    """Packed points with the nearest of the centers so far and of those in tiles: ``ids, packed, cluster, distance``.

    Blocks of centers pass a batch of points that stays; what there is so far comes as two further columns, if at all.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = unpacked(batch.column(1), np.float64, dims)
            if batch.num_columns > 2:
                cluster, distance = unpacked(batch.column(2), np.int32).copy(), unpacked(batch.column(3), np.float64).ravel().copy()
            else:
                cluster, distance = np.full(len(points), -1, np.int32), np.full(len(points), np.inf)
            tiles.nearer(points, cluster, distance)
            added = [like_packed(one, batch.column(1), dims) for one in (cluster, distance)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *added], names=["ids", "packed", "cluster", "distance"])

    return run


def tile_sums_task(run_id: int, dims: int):
    """Sums of the clusters that a task's points are in, for any number of clusters: input ``packed, cluster, distance``.

    A batch's rows go out as soon as they are added up, so a task holds no array of all clusters.
    """

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                labels, best = np.unique(unpacked(batch.column(1), np.int32), return_inverse=True)
                total = _Sums(run_id, labels, dims)
                total.add(unpacked(batch.column(0), np.float64, dims), best.reshape(-1), unpacked(batch.column(2), np.float64).ravel())
                yield from total.batches()

    return run


def tile_medoids_task(tiles: Tiles, run_id: int, dims: int):
    """The members nearest to the means of their clusters; input ``ids, packed, cluster``, tiles of means and spreads."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids = unpacked(batch.column(1), np.float64, dims), batch.column(0).flatten()
            for own, at, (labels, means, spreads) in tiles.places(unpacked(batch.column(2), np.int32)):
                one = _Medoids(run_id, labels)
                some = points[own]
                one.add(some, ids.take(pa.array(own)), at, relative_gap(squared_gaps(some, means[at]), spreads[at]))
                yield from one.batches()

    return run


def tile_gaps_task(tiles: Tiles, dims: int):
    """``id, cluster, distance`` of the points in clusters that the tiles have: the distance to the center there."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids = unpacked(batch.column(1), np.float64, dims), batch.column(0).flatten()
            cluster = unpacked(batch.column(2), np.int32)
            for own, at, (_, centers, *_) in tiles.places(cluster):
                columns = [ids.take(pa.array(own)), pa.array(cluster[own]), pa.array(squared_gaps(points[own], centers[at]))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return run


def relative_gap(distance: np.ndarray, spread: np.ndarray) -> np.ndarray:
    unit = np.where(spread > 0, spread, 1.0)
    return np.rint(distance / unit * 1e9)


def _least_per_cluster(clusters: np.ndarray, gap: np.ndarray, ids: pd.Series) -> np.ndarray:
    """Positions of the rows with the least gap of each cluster, the lowest id among equals."""
    least = np.full(clusters.max() + 1, np.inf)
    np.minimum.at(least, clusters, gap)
    level = np.flatnonzero(gap == least[clusters])
    ties = pd.DataFrame({"c": clusters[level], "id": ids.iloc[level].to_numpy(), "at": level})
    return ties.sort_values(["c", "id"], kind="stable").drop_duplicates("c")["at"].to_numpy()


def assign_task(model, columns: int):
    """Every point with the cluster each run gives it.

    The first ``columns`` input columns are passed on, the last is the features. The model
    carries the updated centers beside the ones that decide. Adds ``run_id, cluster, distance``,
    with the squared distance to the updated center of the cluster.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column(columns))
            kept = [batch.column(i) for i in range(columns)]
            names = batch.schema.names[:columns] + ["run_id", "cluster", "distance"]
            for run_id, labels, centers, updated in model.value:
                best, _ = nearest(points, centers)
                distance = squared_gaps(points, updated[best])
                added = [
                    pa.array(np.full(len(best), run_id, dtype=np.int32)),
                    pa.array(labels[best]),
                    pa.array(distance),
                ]
                yield pa.RecordBatch.from_arrays(kept + added, names=names)

    return run


def nearer_task(tiles: Tiles, columns: int):
    """Keep, for every point, the nearer of its center so far and the centers in tiles.

    Input: ``columns`` columns passed on, then features, cluster and distance so far. Blocks come in cluster order,
    so a tie leaves the earlier, lower cluster.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster, distance = (batch.column(columns + i).to_numpy(zero_copy_only=False).copy() for i in (1, 2))
            tiles.nearer(matrix(batch.column(columns)), cluster, distance)
            arrays = [batch.column(i) for i in range(columns + 1)] + [pa.array(cluster), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return run


# The tasks travel to the executors whole, so these need no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
