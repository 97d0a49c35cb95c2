from __future__ import annotations

import json
from types import SimpleNamespace

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import points_of, rows
from pyspark.sql import functions as F

from kindred.__main__ import main
from kindred.operators import lookup
from kindred.operators.centers import name_centers
from kindred.plans import jobs
from kindred.plans.choose_k import best_k, elbow
from kindred.schema import FEATURES
from kindred.session import fresh_path, materialize, scratch, shared_folder
from kindred.sources import results, sinks, songs


def test_elbow(spark):
    errors = spark.createDataFrame([(4, 12.0), (1, 100.0), (3, 20.0), (2, 40.0), (5, 10.0)], "k int, wsos double")
    found = elbow(errors.repartition(3))
    assert [tuple(row)[1:4] for row in found.collect()] == [
        (1, 100.0, None), (2, 40.0, 40.0), (3, 20.0, 12.0), (4, 12.0, 6.0), (5, 10.0, None),
    ]
    assert [row["chord_gap"] for row in found.collect()] == [0.0, 37.5, 35.0, 20.5, 0.0]
    assert rows(best_k(found), "k") == [(2,)]


def test_elbow_of_one_k(spark):
    errors = spark.createDataFrame([(4, 12.0)], "k int, wsos double")
    assert rows(elbow(errors), "k", "second_diff", "chord_gap") == [(4, None, 0.0)]


def test_names_of_centers(spark):
    points = points_of(spark, [(1, 2), (3, 4), (1, 2)]).select(
        "id", F.concat(F.lit("t"), "id").alias("title"), F.lit("a").alias("artist"), "features"
    )
    found = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 1, [2.0, 3.0])], "run_id int, cluster int, center array<double>")
    assert rows(name_centers(found, points), "cluster", "title", "artist") == [(0, "t0", "a"), (1, "<Not Found>", "<Not Found>")]
    assert rows(name_centers(found, None), "title").count(("<Synthetic>",)) == 2


ASSIGNED = [(0, 0, 1), (0, 0, 2), (0, 1, 3), (1, 5, 1), (1, 5, 3), (1, 6, 2)]


def test_radio_gives_the_other_songs_of_the_cluster(spark):
    table = spark.createDataFrame(ASSIGNED, "run_id int, cluster int, id long")
    assert rows(lookup.radio(table, 1), "run_id", "cluster", "id") == [(0, 0, 2), (1, 5, 3)]


def test_songs_meet_their_clusters(spark):
    placed = spark.createDataFrame([("1", 0, 3, "t", "a"), ("2", 0, 3, "t", "a"), ("3", 0, 4, "t", "a")], "id string, run_id int, cluster int, title string, artist string")
    catalog = spark.createDataFrame([("1", "t", "a"), ("2", "t", "a"), ("9", "u", "a")], "id string, title string, artist string")
    assert rows(lookup.cluster_playlists(catalog, placed), "id", "cluster") == [("1", 3), ("2", 3)]
    by_name = lookup.clusters_by_name(catalog, placed.select("title", "artist", "cluster"))
    assert rows(by_name, "id", "cluster", "copies") == [("1", 3, 2), ("1", 4, 1), ("2", 3, 2), ("2", 4, 1)]


def test_a_cluster_session_must_name_the_shared_folder():
    unset = SimpleNamespace(get=lambda name, default: default)
    session = SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
    session.conf = SimpleNamespace(get=lambda name, default: "hdfs:///shared/")
    assert shared_folder(session) == "hdfs:///shared"


def test_written_tables_are_worked_out_once(spark):
    table = materialize(spark.range(5).withColumn("r", F.rand()), "once")
    assert rows(table) == rows(table) and table.columns == ["id", "r"]
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_what_steps_wrote_is_removed_at_the_end(spark):
    kept = materialize(spark.range(3), "kept")
    with scratch(spark):
        inner = materialize(spark.range(4), "gone")
        assert inner.count() == 4
        files = inner.inputFiles()
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(files[0]).count()


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    """Playlist slices, a feature table with one song missing, and the song tables made of them."""
    folder = tmp_path_factory.mktemp("catalog")
    random = np.random.default_rng(2)
    ids = [f"song{i:018d}" for i in range(40)]
    (folder / "slices").mkdir()
    for part in range(2):
        playlists = []
        for pid in range(part * 10, part * 10 + 10):
            tracks = [
                {"track_uri": f"item:track:{ids[i]}", "track_name": f"T, {i}", "artist_name": f"A{i % 3}"}
                for i in random.integers(0, 40, 12).tolist()
            ]
            playlists.append({"pid": pid, "tracks": tracks})
        (folder / "slices" / f"{part}.json").write_text(json.dumps({"playlists": playlists}, indent=1))
    features = [(song, *[float(v) for v in random.normal(size=13)]) for song in ids[:-1]]
    schema = ", ".join(["id string", *[f"`{name}` double" for name in FEATURES]])
    spark.createDataFrame(features, schema).write.parquet(str(folder / "features"))
    main(["create", str(folder / "slices"), str(folder / "features"), str(folder / "out")])
    return folder


def test_data_creation_from_files_to_files(spark, catalog):
    expected = {}
    for file in (catalog / "slices").iterdir():
        for playlist in json.loads(file.read_text())["playlists"]:
            for track in playlist["tracks"]:
                expected.setdefault(track["track_uri"].split(":")[2], []).append(playlist["pid"])
    found = songs.read_songs_with_playlists(spark, str(catalog / "out" / "songs_with_playlists"))
    missing = f"song{39:018d}"
    assert {row["id"]: row["playlists"] for row in found.collect()} == {
        song: sorted(pids) for song, pids in expected.items() if song != missing
    }
    assert found.filter(F.col("title").contains(",")).count() == 0
    assert songs.read_unique_songs(spark, str(catalog / "out" / "songs")).count() == len(expected)
    failed = spark.read.parquet(str(catalog / "out" / "enriched" / "status=failure"))
    assert {row["id"] for row in failed.collect()} == ({missing} & set(expected))


@pytest.fixture(scope="module")
def feature_file(spark, catalog):
    enriched = spark.read.parquet(str(catalog / "out" / "enriched" / "status=success"))
    sinks.write_features(enriched, str(catalog / "feature_lines"))
    return str(catalog / "feature_lines")


def test_sweep_from_files_to_files(spark, catalog, feature_file):
    out, errors = str(catalog / "sweep"), str(catalog / "sweep_errors")
    main(["sweep", feature_file, out, errors, "2,4,3", "0.0", "5", "7", "kmeans"])
    read = results.read_errors(spark, errors)
    assert [row[0] for row in rows(read)] == [2, 3, 4]
    assert len(list((catalog / "sweep_errors").glob("part-*"))) == 1
    placed = spark.read.parquet(f"{out}/assignments")
    assert rows(placed.select("run_id", "k").distinct()) == [(0, 2), (1, 4), (2, 3)]
    assert placed.count() == 3 * spark.read.text(feature_file).count()
    assert [row["k"] for row in jobs.choose_k(spark, errors).collect()] == [2, 3, 4]
    for file in (catalog / "sweep" / "assignments").rglob("*.parquet"):
        written = pq.ParquetFile(file).read(columns=["cluster"])["cluster"].to_pylist()
        assert written == sorted(written)
    sinks.write_assignment_lines(placed.filter("run_id = 0"), str(catalog / "lines"))
    back = results.read_assignments(spark, str(catalog / "lines"))
    assert rows(back) == rows(placed.filter("run_id = 0"), "cluster", "title", "artist")
    clusters = [row["cluster"] for row in back.collect()]
    assert clusters == sorted(clusters)


def test_programs_run_on_what_the_ones_before_wrote(spark, catalog, capsys):
    for form, source in (("text", "features"), ("parquet", "enriched/status=success")):
        out, errors = str(catalog / f"chain-{form}"), str(catalog / f"chain-errors-{form}")
        main(["sweep", str(catalog / "out" / source), out, errors, "2,3", "0.0", "4", "7", "kmeans", "--form", form])
        main(["elbow", errors])
        song = spark.read.parquet(f"{out}/assignments").first()["id"]
        capsys.readouterr()
        main(["radio", f"{out}/assignments", song])
        assert song not in capsys.readouterr().out
    same = [rows(spark.read.parquet(str(catalog / f"chain-{form}" / "assignments")), "run_id", "id", "cluster") for form in ("text", "parquet")]
    assert same[0] == same[1] and same[0]


def test_radio_program_writes_all_rows(spark, tmp_path, capsys):
    cluster = spark.range(1_503).select("id", lookup.F.lit(0).alias("run_id"), lookup.F.lit(0).alias("cluster"))
    cluster.write.parquet(str(tmp_path / "assignments"))
    main(["radio", str(tmp_path / "assignments"), "7", "--output", str(tmp_path / "all")])
    assert rows(spark.read.parquet(str(tmp_path / "all")), "id") == sorted(((i,) for i in range(1_503) if i != 7), key=repr)
    assert "only the first 1000 rows" in capsys.readouterr().out


@pytest.mark.parametrize("named", [True, False])
def test_grid_from_files_to_files(spark, catalog, feature_file, named):
    setups = spark.createDataFrame([(0, 2, 1, 3, 0.0), (1, 3, 1, 3, 0.0)], "run_id int, k int, seed int, max_iters int, epsilon double")
    sinks.write_setups(setups, str(catalog / "setups"))
    out = str(catalog / f"grid-{named}")
    main(["grid", feature_file, str(catalog / "setups"), out, "kmedoids", *(["--name-centers"] if named else [])])
    assert rows(spark.read.parquet(f"{out}/runs"), "run_id", "k") == [(0, 2), (1, 3)]
    titles = {row["title"] for row in spark.read.parquet(f"{out}/centers").collect()}
    assert ("<Synthetic>" in titles) != named and "<Not Found>" not in titles
