"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import check_queries
import pytest

import __spark_entry__ as contract
from kindred.queries import clustering, preparing

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return check_queries.connect(FOLDER)


OWN = {**preparing.QUERIES, **clustering.QUERIES}


def test_every_query_has_sql():
    assert OWN.keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["run_id", "cluster", "count"]
    assert sum(row["count"] for row in found.collect()) == 500


@pytest.mark.parametrize("name", list(OWN))
def test_query(spark, connection, name):
    assert check_queries.mismatch(spark, connection, FOLDER, name) is None
