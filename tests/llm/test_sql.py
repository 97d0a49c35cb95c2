"""Those operators that SQL can express against their SQL."""

from __future__ import annotations

import check_queries
import pytest

from kindred.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_queries.connect(FOLDER)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, connection, name):
    assert check_queries.mismatch(spark, connection, FOLDER, name) is None
