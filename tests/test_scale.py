"""What must hold at scale: rows shuffled, passes, files opened, and draws without a task for a whole seed."""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import points_of, rows
from pyspark.sql import functions as F

from kindred.functions import kernels
from kindred.operators import assign, centers, lookup
from kindred.plans import clustering
from kindred.plans.clustering import cluster, setups
from kindred.sources import sinks

RANDOM = np.random.default_rng(8).normal(size=(400, 3)).tolist()


def test_sums_shuffle_at_most_cores_times_clusters(spark, monkeypatch):
    points = points_of(spark, RANDOM, 40).persist()
    packed = clustering._pack(points, 3, 40)
    model = spark.sparkContext.broadcast([(0, np.arange(6, dtype=np.int32), np.array(RANDOM[:6]))])

    def emitted():
        near = packed.few(packed.rows, 6).select("packed")
        return near.mapInArrow(kernels.sums_task(model, 3), clustering._sums_schema(3)).cache()

    assert emitted().count() > 8 * 6
    monkeypatch.setattr(clustering, "_SUM_ROWS", 100)
    sums = emitted()
    assert sums.count() <= spark.sparkContext.defaultParallelism * 6
    assert sums.agg(F.sum("n")).first()[0] == 400


@pytest.mark.parametrize("algorithm", ["kmeans", "kmedoids"])
def test_waves_of_tiles_change_nothing(spark, monkeypatch, algorithm):
    points = points_of(spark, RANDOM, 3).withColumn("title", F.concat(F.lit("t"), "id"))
    grid = setups(spark, [(7, 4, 3, 0.0)])
    expected = cluster(points, grid, algorithm)
    # One center to a block, two blocks to a pass.
    monkeypatch.setattr(assign, "WAVE_BLOCKS", 2)
    found = cluster(points, grid, algorithm, model_bytes=24)
    columns = ["id", "title", "run_id", "cluster"]
    assert rows(found.assignments, *columns) == rows(expected.assignments, *columns)
    places = lambda result: [np.array(r["center"]) for r in result.centers.orderBy("cluster").collect()]
    assert np.allclose(places(found), places(expected))
    assert np.allclose([r["wsos"] for r in found.history.orderBy("iter").collect()], [r["wsos"] for r in expected.history.orderBy("iter").collect()])


@pytest.mark.parametrize("kind", ["long", "string"])
def test_packed_points(spark, monkeypatch, kind):
    points = points_of(spark, RANDOM, 5).withColumn("id", F.col("id").cast(kind))
    monkeypatch.setattr(kernels, "PACKED_BYTES", 24 * 7)
    packed = clustering._pack(points, 3, 5)
    assert packed.rows.agg(F.max(F.size("ids"))).first()[0] == 7
    found = {}
    for row in packed.rows.collect():
        found.update(zip(row["ids"], np.frombuffer(row["packed"]).reshape(-1, 3).tolist()))
    assert found == {(str(i) if kind == "string" else i): list(map(float, x)) for i, x in enumerate(RANDOM)}


def test_draws_of_the_order_of_the_rows(spark, monkeypatch):
    points = points_of(spark, RANDOM, 5)
    runs = setups(spark, [(350, 3, 1, 0.0), (399, 3, 1, 0.0), (5, 8, 1, 0.0)]).collect()
    expected = rows(centers.initial_centers(points, runs), "run_id", "cluster", "id")
    monkeypatch.setattr(centers, "_WINDOW_ROWS", 10)
    found = centers.initial_centers(points, runs)
    assert rows(found, "run_id", "cluster", "id") == expected and len(expected) == 754
    plan = found._jdf.queryExecution().toString()
    assert "Window" not in plan.split("== Physical Plan ==")[-1]


@pytest.fixture
def written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FOLDER", 40)
    points = points_of(spark, RANDOM, 5).withColumn("title", F.concat(F.lit("t"), "id"))
    found = cluster(points, setups(spark, [(9, 4, 3, 0.0), (4, 4, 3, 0.0)]))
    path = str(tmp_path / "found")
    sinks.write_clustering(found, path)
    return found, Path(path)


def test_radio_opens_only_the_folders_of_its_song(spark, written):
    found, path = written
    assignments = path / "assignments"
    want = rows(lookup.radio(found.assignments, 17), "run_id", "cluster", "id", "title")
    homes = {r.run_id: r.cluster for r in found.assignments.filter("id = 17").collect()}
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(17).cast("long")), F.lit(20))).first()[0]
    kept = {f"buckets=20/bucket={bucket}"} | {f"run_id={run}/groups=10/group={c % 10}" for run, c in homes.items()}
    files = [f for folder in (assignments, path / "assignments_by_id") for f in folder.rglob("*.parquet")]
    spoiled = [f for f in files if not any(part in str(f) for part in kept)]
    assert len(files) - len(spoiled) <= 8 < len(spoiled)
    # The data of every other file is wiped (only the footers stay, one of which tells the schema), and nothing notices.
    for file in spoiled:
        content = file.read_bytes()
        footer = 8 + int.from_bytes(content[-8:-4], "little")
        file.write_bytes(content[:4] + bytes(len(content) - 4 - footer) + content[-footer:])
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    with_files = lookup.radio_from_files(spark, str(assignments), 17)
    assert rows(with_files, "run_id", "cluster", "id", "title") == want
    filters = re.search(r"PartitionFilters: (.*)", with_files._jdf.queryExecution().toString())[1]
    assert "group#" in filters and "run_id#" in filters
    with pytest.raises(Exception, match="(?i)read|corrupt|decod|page|parquet"):
        spark.read.parquet(str(assignments)).agg(F.sum("id")).collect()


def test_radio_of_unknown_songs_and_without_an_index(spark, written, tmp_path):
    found, path = written
    assert lookup.radio_from_files(spark, str(path / "assignments"), 10**6).count() == 0
    plain = str(tmp_path / "plain")
    found.assignments.write.parquet(plain)
    assert rows(lookup.radio_from_files(spark, plain, 3), "id") == rows(lookup.radio(found.assignments, 3), "id")


def test_a_batch_of_packed_points_is_small_whatever_the_partition(spark):
    """All points in one partition: a Python worker gets them ten megabytes of features at a time."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).nbytes])], names=["bytes"])

    x = F.col("id").cast("double")
    points = spark.range(0, 400_000, 1, 1).select(F.array(x, x + 1, x * 2, x - 1).alias("features"), "id")
    packed = points.mapInArrow(kernels.pack_task(4), "ids array<bigint>, packed binary")
    found = [row.bytes for row in packed.select("packed").mapInArrow(sizes, "bytes long").collect()]
    # Four bytes of each row are its place.
    assert sum(found) >= 400_000 * 32 and max(found) <= 10_000 * (1024 + 4) + 4


def test_a_batch_of_packed_points_is_small_with_long_ids(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).nbytes]), pa.array([len(batch.column(0).flatten())])], names=["bytes", "n"])

    x = F.col("id").cast("double")
    points = spark.range(0, 100_000, 1, 1).select(F.array(x, x + 1, x * 2, x - 1).alias("features"), F.lpad("id", 100, "0").alias("id"))
    packed = points.mapInArrow(kernels.pack_task(4), "ids array<string>, packed binary")
    found = packed.select("ids").mapInArrow(sizes, "bytes long, n long").collect()
    # Four bytes of each row are its place.
    assert sum(row.n for row in found) == 100_000 and max(row.bytes for row in found) <= 10_000 * (512 + 4) + 8
