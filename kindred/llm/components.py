"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import materialize


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is a node of the component.

    Each round joins every root to its least neighbour and draws the edges between the roots anew, so
    the number of edges left falls by a large part each time; no neighbourhood is ever listed. Rounds are
    written tables, so a lost executor costs at most a round, and the driver only learns whether edges are left.
    """
    open_edges = materialize(_distinct(edges.select("a", "b")), label)
    ends = F.explode(F.array("a", "b")).alias("node")
    labels = materialize(open_edges.select(ends).distinct().select("node", F.col("node").alias("root")), label)
    while not open_edges.isEmpty():
        both = open_edges.unionByName(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("to")).filter(F.col("to") < F.col("a"))
        moves = materialize(least.select(F.col("a").alias("root"), "to"), label)
        labels = materialize(_moved(labels, moves, "root"), label)
        open_edges = materialize(_distinct(_moved(_moved(open_edges, moves, "a"), moves, "b")), label)
    return labels


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _moved(table: DataFrame, moves: DataFrame, column: str) -> DataFrame:
    """``table`` with the roots in a column replaced where they move."""
    joined = table.join(moves.select(F.col("root").alias(column), "to"), column, "left")
    return joined.withColumn(column, F.coalesce("to", column)).select(*table.columns)
