from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kindred.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(table, *columns: str) -> list[tuple]:
    """The rows of a table as sorted tuples."""
    chosen = table.select(*columns) if columns else table
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def points_of(spark, vectors, partitions: int | None = None):
    """A points table with ids 0, 1, ... from a list of vectors."""
    table = spark.createDataFrame(
        [(i, [float(v) for v in vector]) for i, vector in enumerate(vectors)], "id long, features array<double>"
    )
    return table.repartition(partitions) if partitions else table
