"""Joins whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import materialize

#: Keys with more rows than this, and than this share of all rows, are hot.
HOT_ROWS = 100_000
HOT_SHARE = 10_000


def join_counted(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` joined with ``facts``, one row per key, whose column ``count`` says how many rows the key has.

    Hot keys have one ``HOT_SHARE``-th of all rows each, so there are at most that many of them: their facts are
    broadcast and their rows stay where they are. All other keys have few rows in one task.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    limit = max(hot_rows, total // HOT_SHARE)
    # At most HOT_SHARE rows.
    hot = F.broadcast(materialize(facts.filter(F.col(count) > limit), "hot-facts"))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(facts.filter(F.col(count) <= limit), keys)
    return rows.join(hot, keys).unionByName(rest)
