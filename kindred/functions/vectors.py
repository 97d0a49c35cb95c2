"""Column expressions on feature vectors held as ``ARRAY<DOUBLE>``."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def assemble(columns: list[str]) -> Column:
    """Numeric columns as one vector, in the given order; a null or NaN fails the job."""
    return F.array(*[checked(F.col(name), name) for name in columns])


def checked(value: Column, name: str) -> Column:
    """``value`` as a double that is neither null nor NaN; anything else fails the job."""
    number = value.cast("double")
    message = F.lit(f"feature {name} is null or not a number")
    return F.when(number.isNull() | F.isnan(number), F.raise_error(message)).otherwise(number)


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two vectors of equal length."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)


def add(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a + b)


def scale_by(vector: Column, factor: Column) -> Column:
    return F.transform(vector, lambda value: value * factor)


def divide_by(vector: Column, divisor: Column) -> Column:
    return F.transform(vector, lambda value: value / divisor)


def to_ml_vector(vector: Column) -> Column:
    """The vector as the machine-learning library's own type."""
    return array_to_vector(vector)


def from_ml_vector(vector: Column) -> Column:
    """A machine-learning vector as a plain array, for output."""
    return vector_to_array(vector)
