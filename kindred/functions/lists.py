"""Batch arithmetic on points that have a list of items beside their features: NumPy on Arrow batches, inside tasks.

The distance of two points mixes their features and their lists. With a weight ``w`` it is ``(1 - w)`` times the mean
squared difference of their features plus ``w`` times the Jaccard distance of their lists as sets (0 between two empty
ones). Lists are sorted and without repeats.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from kindred.functions.kernels import matrix

# Cells of a table of distances, and meetings of items with lists, worked out at once.
CELLS = 1 << 20
MEETINGS = 1 << 22


class Targets(NamedTuple):
    """Places that points are compared with: features, sizes of lists, and the lists inverted: the owners of item
    ``values[i]`` are ``owners[first[i]:first[i + 1]]``."""

    centers: np.ndarray
    sizes: np.ndarray
    values: np.ndarray
    first: np.ndarray
    owners: np.ndarray


def list_column(column) -> tuple[np.ndarray, np.ndarray]:
    """The items of an Arrow list column, and where the list of each row begins."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def targets(centers: np.ndarray, items: np.ndarray, offsets: np.ndarray) -> Targets:
    sizes = np.diff(offsets)
    owners = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(items, kind="stable")
    values, first = np.unique(items[order], return_index=True)
    return Targets(centers, sizes, values, np.append(first, len(items)), owners[order])


def common(items: np.ndarray, offsets: np.ndarray, there: Targets) -> np.ndarray:
    """How many items each list has in common with that of each target."""
    rows, places = len(offsets) - 1, len(there.sizes)
    found = np.zeros(rows * places, dtype=np.int64)
    if not len(items) or not len(there.values):
        return found.reshape(rows, places)
    at = np.minimum(np.searchsorted(there.values, items), len(there.values) - 1)
    known = there.values[at] == items
    at, row = at[known], np.repeat(np.arange(rows), np.diff(offsets))[known]
    spans = there.first[at + 1] - there.first[at]
    ends = np.cumsum(spans)
    begin = 0
    while begin < len(at):
        # As many items as keep their meetings below the bound, one at least.
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + MEETINGS, side="right")))
        own = spans[begin:end]
        steps = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        owner = there.owners[np.repeat(there.first[at[begin:end]], own) + steps]
        cells, times = np.unique(np.repeat(row[begin:end], own) * places + owner, return_counts=True)
        found[cells] += times
        begin = end
    return found.reshape(rows, places)


def mixed_gaps(points: np.ndarray, items: np.ndarray, offsets: np.ndarray, there: Targets, weight: float) -> np.ndarray:
    """The mixed distance of every point to every target."""
    gaps = np.zeros((len(points), len(there.sizes)))
    for dim in range(points.shape[1]):
        step = points[:, dim, None] - there.centers[None, :, dim]
        gaps += step * step
    both = common(items, offsets, there)
    union = np.diff(offsets)[:, None] + there.sizes[None, :] - both
    apart = np.where(union > 0, 1 - both / np.maximum(union, 1), 0.0)
    return (1 - weight) * (gaps / points.shape[1]) + weight * apart


def _blocks(rows: int, places: int):
    step = max(1, CELLS // max(1, places))
    return [(at, min(at + step, rows)) for at in range(0, rows, step)]


def nearer_list_task(block, columns: int, weight: float):
    """Keep, for every point, the nearer of its center so far and the targets of one block.

    Input: ``columns`` columns passed on, then features, items, cluster and distance so far. Blocks come in
    cluster order and labels ascend, so a tie goes to the lowest cluster.
    """

    def run(batches):
        labels, there = block.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column(columns))
            items, offsets = list_column(batch.column(columns + 1))
            cluster = batch.column(columns + 2).to_numpy(zero_copy_only=False).copy()
            so_far = batch.column(columns + 3).to_numpy(zero_copy_only=False).copy()
            for begin, end in _blocks(len(points), len(labels)):
                own = items[offsets[begin] : offsets[end]]
                gaps = mixed_gaps(points[begin:end], own, offsets[begin : end + 1] - offsets[begin], there, weight)
                best = gaps.argmin(axis=1)
                distance = gaps[np.arange(end - begin), best]
                closer = distance < so_far[begin:end]
                cluster[begin:end][closer] = labels[best[closer]]
                so_far[begin:end][closer] = distance[closer]
            arrays = [batch.column(i) for i in range(columns + 2)] + [pa.array(cluster.astype(np.int32)), pa.array(so_far)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return run


def totals_task(block, weight: float):
    """The total mixed distance of candidates to the members of their clusters, by task: ``candidate, total``.

    Input: cluster, features and items of the members. The model has, by cluster, the numbers of its candidates
    and these as targets; members of other clusters are passed over.
    """

    def run(batches):
        model = block.value
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            clusters = batch.column(0).to_numpy()
            for cluster in np.unique(clusters):
                if cluster not in model:
                    continue
                some = batch.take(pa.array(np.flatnonzero(clusters == cluster)))
                _, there = model[cluster]
                points = matrix(some.column(1))
                items, offsets = list_column(some.column(2))
                total = totals.setdefault(int(cluster), np.zeros(len(there.sizes)))
                for begin, end in _blocks(len(points), len(there.sizes)):
                    own = items[offsets[begin] : offsets[end]]
                    total += mixed_gaps(points[begin:end], own, offsets[begin : end + 1] - offsets[begin], there, weight).sum(axis=0)
        for cluster, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array(model[cluster][0]), pa.array(total)], names=["candidate", "total"])

    return run


# The tasks travel to the executors whole, so these need no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
