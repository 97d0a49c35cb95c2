"""Standardising features to mean 0 and standard deviation 1.

One aggregate finds the means and sample standard deviations; they are one row, and go into the
projection as constants.
"""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.vectors import checked, to_ml_vector


def feature_statistics(table: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, mean, sd)`` for each column, from one pass."""
    statistics = _column_statistics(table, columns)
    return table.sparkSession.createDataFrame(
        [(name, mean, deviation) for name, (mean, deviation) in statistics.items()],
        "feature string, mean double, sd double",
    )


def scaled_features(table: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns and ``features``: the standardised columns as one vector.

    A column that does not vary gives 0; a null or NaN fails the job.
    """
    statistics = _column_statistics(table, columns)
    scaled = [_standardise(checked(F.col(name), name), *statistics[name]) for name in columns]
    return table.select(*keep, F.array(*scaled).alias("features"))


def scaled_vectors(table: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """The same for features that are already one array column; all rows must have one length."""
    values = F.transform(column, lambda value: checked(value, column))
    summary = table.select(Summarizer.metrics("mean", "std").summary(to_ml_vector(values)).alias("s"))
    row = summary.select("s.mean", "s.std").first()
    means, deviations = row["mean"].toArray().tolist(), row["std"].toArray().tolist()
    if not means:
        return table.select(*keep, values.alias("features"))
    factors = F.lit([1.0 / deviation if deviation else 0.0 for deviation in deviations])
    centered = F.zip_with(values, F.lit(means), lambda value, mean: value - mean)
    scaled = F.zip_with(centered, factors, lambda value, factor: value * factor)
    return table.select(*keep, scaled.alias("features"))


def _column_statistics(table: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    aggregates = []
    for i, name in enumerate(columns):
        value = checked(F.col(name), name)
        aggregates += [F.avg(value).alias(f"mean{i}"), F.stddev_samp(value).alias(f"sd{i}")]
    row = table.agg(*aggregates).first()
    return {name: (row[f"mean{i}"], row[f"sd{i}"]) for i, name in enumerate(columns)}


def _standardise(value: Column, mean: float | None, deviation: float | None) -> Column:
    # There is no deviation for fewer than two rows.
    if not deviation:
        return value * 0.0
    return (value - F.lit(mean)) / F.lit(deviation)
