"""Run every query and its SQL on one scale and compare rows, names and values.

``python tests/check_queries.py [folder] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from kindred.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if isinstance(value, float) and value == 0.0:
            return 0.0
        return value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=lambda row: tuple(map(repr, row)))


def mismatch(spark, connection, folder: str, name: str) -> str | None:
    """What differs between a query and its SQL, or ``None``."""
    table = contract.queries()[name](spark, folder)
    mine = canonical(table.columns, [tuple(row) for row in table.collect()])
    result = connection.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(table.columns) != sorted(names):
        return f"columns {sorted(table.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for left, right in zip(mine, theirs):
        if left != right and not all(a == b or (a != a and b != b) for a, b in zip(left, right)):
            return f"{left} against {right}"
        for a, b in zip(left, right):
            if type(a) is not type(b) and not (isinstance(a, float) and math.isclose(a, b)):
                return f"types {left} against {right}"
    return None if mine else "no rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.oracle_sql())
    spark = build_session(
        spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = mismatch(spark, connection, folder, name)
        except Exception as error:  # report every query, whatever one does
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
