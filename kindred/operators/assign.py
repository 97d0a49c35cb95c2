"""Nearest centers for every point."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.kernels import Tiles, assign_task, distinct, matrix, nearer_task
from kindred.operators.ordering import with_start
from kindred.session import materialize

# Most bytes of centers to broadcast at once. A Python worker holds about three times as much.
MODEL_BYTES = 64 << 20
# Blocks of that size that a pass takes, one after the other: what a Python worker holds of the centers.
WAVE_BLOCKS = 4


def assign_points(points: DataFrame, model: Broadcast) -> DataFrame:
    """Every point once for each run of a broadcast model, with its cluster and distance."""
    kept = [name for name in points.columns if name != "features"]
    passed = ", ".join(f"`{name}` {points.schema[name].dataType.simpleString()}" for name in kept)
    schema = f"{passed}, run_id int, cluster int, distance double"
    return points.select(*kept, "features").mapInArrow(assign_task(model, len(kept)), schema)


def center_tiles(centers: DataFrame, model_bytes: int = MODEL_BYTES, extra: str | None = None) -> Iterator[Tiles]:
    """``(cluster, center)`` as blocks of up to ``model_bytes``, ``WAVE_BLOCKS`` of them at a time, in cluster order.

    Equal centers of a block count once unless there is an ``extra`` column to go with each. The driver holds one block.
    """
    spark = centers.sparkSession
    size = centers.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("center")).alias("dims")).first()
    if not size["n"]:
        raise ValueError("there are no centers")
    per_block = max(1, model_bytes // (8 * size["dims"]))
    columns = ["cluster", "center", *([extra] if extra else [])]
    rows = centers.select(*columns)
    # Blocks are of centers in cluster order, whatever their numbers.
    placed = with_start(rows, ["cluster"], "_place") if size["n"] > per_block else rows.withColumn("_place", F.lit(0))
    wave: list = []
    for first in range(0, size["n"], per_block):
        in_block = F.col("_place").between(first, first + per_block - 1)
        block = placed.filter(in_block).select(*columns).orderBy("cluster").toArrow()
        labels, places = block["cluster"].to_numpy().astype(np.int32), matrix(block["center"].combine_chunks())
        kept = slice(None) if extra else distinct(places)
        arrays = (labels[kept], places[kept], *([block[extra].to_numpy()] if extra else []))
        wave.append(spark.sparkContext.broadcast(arrays))
        if len(wave) == WAVE_BLOCKS:
            yield Tiles(wave)
            wave = []
    if wave:
        yield Tiles(wave)


def nearest_centers(
    points: DataFrame, centers: DataFrame, model_bytes: int = MODEL_BYTES, write: bool = False
) -> DataFrame:
    """Nearest center for every point: its columns, the features, ``cluster`` and ``distance``.

    ``centers`` is a table of one run, ``(cluster, center)``. Blocks of up to ``model_bytes`` pass every batch of points,
    ``WAVE_BLOCKS`` of them in one pass; a pass that is not the only one is written to the shared folder. With ``write``
    a single pass is written too, for a result that will be read many times.
    """
    kept = [name for name in points.columns if name != "features"]
    passed = ", ".join(f"`{name}` {points.schema[name].dataType.simpleString()}" for name in kept)
    schema = ", ".join(filter(None, [passed, "features array<double>, cluster int, distance double"]))
    best = points.select(
        *kept, "features", F.lit(-1).alias("cluster"), F.lit(float("inf")).alias("distance")
    )
    waves = 0
    for tiles in center_tiles(centers, model_bytes):
        best = materialize(best, "nearest") if waves else best
        best = best.mapInArrow(nearer_task(tiles, len(kept)), schema)
        waves += 1
    return materialize(best, "nearest") if write or waves > 1 else best
