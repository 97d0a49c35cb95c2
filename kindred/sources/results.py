"""Setup files and the text results of earlier runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The three text shapes of results.
ERROR_LINE = r"^\s*Array\(([^,]+), ([^)]+)\)\s*$"
RUN_LINE = r"^\(Setup\((\d+),(-?\d+),(\d+),([^)]+)\),ReadableClustering\((\d+),([^,]+),"
# What is between two entries of a list in a whole-result line; names hold no commas, so a head never has it.
ENTRY_SEPARATOR = ",("
ASSIGNMENT_LINE = r"^\((\d+),\[(.*),([^,]*)\]\)$"


def read_setups(spark: SparkSession, path: str) -> DataFrame:
    """``K seed maxIters epsilon`` lines, numbered in file order as ``run_id``.

    A setups table has one row per clustering asked for, so one window over it is small.
    """
    lines = (
        spark.read.option("wholetext", True)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
        .filter(F.trim("text") != "")
    )
    parts = F.split(F.trim("text"), " +")
    return lines.select(
        (F.row_number().over(Window.orderBy("file", "line")) - 1).alias("run_id"),
        F.element_at(parts, 1).cast("int").alias("k"),
        F.element_at(parts, 2).cast("int").alias("seed"),
        F.element_at(parts, 3).cast("int").alias("max_iters"),
        F.element_at(parts, 4).cast("double").alias("epsilon"),
    )


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """``Array(k, error)`` lines as ``(k, wsos)``; files and lines without them are passed over."""
    return _matching(spark, path, ERROR_LINE).select(
        F.regexp_extract("value", ERROR_LINE, 1).cast("double").cast("int").alias("k"),
        F.regexp_extract("value", ERROR_LINE, 2).cast("double").alias("wsos"),
    )


def read_run_errors(spark: SparkSession, path: str) -> DataFrame:
    """The setup, iterations and error at the head of each whole-result line.

    Such a line holds a whole clustering, so it is never read as one row: files are cut wherever one entry of a list
    follows another, and a head lies whole in the piece that begins its line.
    """
    return _run_pieces(spark, path).filter(F.col("value").rlike(RUN_LINE)).select(
        F.regexp_extract("value", RUN_LINE, 1).cast("int").alias("k"),
        F.regexp_extract("value", RUN_LINE, 2).cast("int").alias("seed"),
        F.regexp_extract("value", RUN_LINE, 3).cast("int").alias("max_iters"),
        F.regexp_extract("value", RUN_LINE, 4).cast("double").alias("epsilon"),
        F.regexp_extract("value", RUN_LINE, 5).cast("int").alias("iters"),
        F.regexp_extract("value", RUN_LINE, 6).cast("double").alias("wsos"),
    )


def _run_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of whole-result lines, about an entry of a list each; a piece that spans a line end is cut there too."""
    pieces = spark.read.option("lineSep", ENTRY_SEPARATOR).text(path)
    return pieces.select(F.explode(F.split("value", "\r?\n")).alias("value"))


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster,[title,artist])`` lines; brackets inside names are kept."""
    return _matching(spark, path, ASSIGNMENT_LINE).select(
        F.regexp_extract("value", ASSIGNMENT_LINE, 1).cast("int").alias("cluster"),
        F.regexp_extract("value", ASSIGNMENT_LINE, 2).alias("title"),
        F.regexp_extract("value", ASSIGNMENT_LINE, 3).alias("artist"),
    )


def _matching(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.text(path).filter(F.col("value").rlike(pattern))
