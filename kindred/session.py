"""Session settings, and tables written between steps.

Steps that must not be computed twice (a global order, a pass over center blocks) are written to
the shared folder named by ``spark.checkpoint.dir`` and read back, which also cuts their lineage.
A lost executor then costs a re-read, never a re-run with different row numbers.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "kindred", **settings: str) -> SparkSession:
    """A session with adaptive execution and UTC time; further settings as keyword arguments
    with dots written as double underscores (``spark__sql__shuffle__partitions="2000"``)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables written between steps.

    Taken from the session. Only a local session that names none gets a temporary folder; on a
    cluster that would be a different disk on every machine, so it is an error.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="kindred-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


# For every open scratch, the paths given out since.
_SCRATCHES: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _SCRATCHES:
        paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written for steps inside are removed at the end: read or write what is wanted before."""
    paths: list[str] = []
    _SCRATCHES.append(paths)
    try:
        yield
    finally:
        _SCRATCHES.remove(paths)
        remove(spark, *paths)


def remove(spark: SparkSession, *paths: str) -> None:
    """Remove written tables that nothing reads any more."""
    hadoop, configuration = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for path in map(hadoop.Path, paths):
        path.getFileSystem(configuration).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def written(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` and return it as a table read back from there.

    With ``by`` each value of that column has a folder, so a filter on it reads only its rows.
    """
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as a table read back from there.

    Inside ``scratch`` it goes with the rest: what is to outlast it is ``written`` to a path taken before.
    """
    return written(df, fresh_path(df.sparkSession, label), by)
