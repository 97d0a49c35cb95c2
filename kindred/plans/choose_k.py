"""Choosing the number of clusters from the error of each K."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def elbow(errors: DataFrame, sweep: str = "sweep") -> DataFrame:
    """Per K: the second difference of the error, and how far it lies below the end-to-end chord.

    ``errors`` has ``k`` and ``wsos``, and may name several sweeps in the ``sweep`` column. Both
    measures peak at the bend; the ends of a sweep have no second difference. A sweep has a row
    per K, so a window over it is small.
    """
    if sweep not in errors.columns:
        errors = errors.withColumn(sweep, F.lit(0))
    along = Window.partitionBy(sweep).orderBy("k")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_k, last_k = F.first("k").over(whole), F.last("k").over(whole)
    first_error, last_error = F.first("wsos").over(whole), F.last("wsos").over(whole)
    share = F.when(last_k == first_k, 0.0).otherwise((F.col("k") - first_k) / F.nullif(last_k - first_k, F.lit(0)))
    chord = first_error + (last_error - first_error) * share
    return errors.select(
        sweep,
        "k",
        "wsos",
        (F.lag("wsos").over(along) - 2 * F.col("wsos") + F.lead("wsos").over(along)).alias("second_diff"),
        (chord - F.col("wsos")).alias("chord_gap"),
    ).orderBy(sweep, "k")


def best_k(elbows: DataFrame, sweep: str = "sweep") -> DataFrame:
    """The K of each sweep that lies furthest below the chord, the lowest among equals."""
    key = F.struct(F.col("chord_gap"), (-F.col("k")).alias("low"))
    return elbows.groupBy(sweep).agg(F.max_by("k", key).alias("k"))
