from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kindred.operators import ordering, prepare

TRACKS = "pid long, pos int, id string"


def expected_parts(table: dict[int, list[str]], size: int) -> list[tuple]:
    parts = [(pid, i // size, ids[i : i + size]) for pid, ids in table.items() for i in range(0, len(ids), size)]
    return sorted(parts, key=repr)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_lists_are_whole_and_in_order_whatever_their_parts(spark, size):
    random.seed(3)
    table = {pid: [f"s{random.randrange(9)}" for _ in range(length)] for pid, length in enumerate([1, 2, 3, 40, 5])}
    tracks = [(pid, pos, song) for pid, ids in table.items() for pos, song in enumerate(ids)]
    random.shuffle(tracks)
    found = prepare.playlist_adjacency(spark.createDataFrame(tracks, TRACKS).repartition(5), max_items=size)
    assert rows(found, "pid", "part", "track_ids") == expected_parts(table, size)


def test_a_hot_group_of_equal_rows_is_cut_into_parts(spark):
    pairs = spark.createDataFrame([("hot", 7)] * 25 + [("hot", 3), ("cold", 7), ("cold", 7)], "id string, pid long")
    lists = prepare.song_playlists(pairs, max_items=10)
    assert rows(lists.long_keys) == [("hot",)]
    assert rows(lists.all()) == [
        ("cold", 0, [7, 7]), ("hot", 0, [3] + [7] * 9), ("hot", 1, [7] * 10), ("hot", 2, [7] * 6),
    ]


def test_pairs_undo_lists(spark):
    lists = spark.createDataFrame([(1, ["a", "b", "a"]), (2, [])], "pid long, track_ids array<string>")
    assert rows(prepare.adjacency_pairs(lists)) == [("a", 1), ("a", 1), ("b", 1)]


def test_unique_songs_take_the_first_names(spark):
    tracks = spark.createDataFrame(
        [("x", "late", "B", 2), ("x", "early", "A", 1), ("y", None, "C", 5)], "id string, title string, artist string, at int"
    )
    assert rows(prepare.unique_songs(tracks.repartition(3), ["at"])) == [("x", "early", "A"), ("y", None, "C")]


def test_enriching_splits_songs_and_copies_do_not_multiply(spark):
    songs = spark.createDataFrame([("1", "a", "A"), ("2", "b", "B")], "id string, title string, artist string")
    features = spark.createDataFrame([("1", 5.0), ("1", 4.0), ("9", 1.0)], "id string, tempo double")
    found = prepare.enrich(songs, features, ["tempo"])
    assert rows(prepare.successes(found)) == [("1", "a", "A", 4.0)]
    assert rows(prepare.failures(found)) == rows(prepare.missing(songs, features)) == [("2", "b", "B")]


def test_null_features_are_no_features(spark):
    songs = spark.createDataFrame([(i, "t", "a") for i in "1234"], "id string, title string, artist string")
    rows_ = [("1", None, None), ("2", 1.0, None), ("3", None, None), ("3", 1.0, 2.0), ("3", None, 0.0), ("4", 5.0, 6.0)]
    found = prepare.enrich(songs, spark.createDataFrame(rows_, "id string, key double, tempo double"), ["key", "tempo"])
    assert rows(prepare.successes(found), "id", "key", "tempo") == [("3", 1.0, 2.0), ("4", 5.0, 6.0)]
    assert rows(prepare.failures(found), "id") == [("1",), ("2",)]


def test_parts_of_one_key_are_built_in_several_tasks(spark):
    tracks = spark.range(4_000).select(
        F.lit(7).cast("long").alias("pid"), F.col("id").cast("int").alias("pos"), F.col("id").cast("string").alias("id")
    )
    kept = {name: spark.conf.get(name) for name in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = prepare.playlist_adjacency(tracks, max_items=100).withColumn("task", F.spark_partition_id())
        built = found.select("part", "task", F.size("track_ids").alias("n")).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len(built) == 40 and {row["n"] for row in built} == {100}
    assert len({row["task"] for row in built}) > 1


def test_lists_of_no_key(spark):
    table = spark.createDataFrame([(None, i, str(i)) for i in range(5)] + [(1, 0, "x")], TRACKS)
    assert rows(prepare.playlist_adjacency(table, max_items=2), "pid", "part", "track_ids") == [
        (1, 0, ["x"]), (None, 0, ["0", "1"]), (None, 1, ["2", "3"]), (None, 2, ["4"]),
    ]


@pytest.mark.parametrize("size", [2, 1000])
@pytest.mark.parametrize("how", ["left", "full"])
def test_playlists_go_to_their_songs(spark, how, size):
    songs = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, title string")
    pairs = spark.createDataFrame([("1", 4), ("1", 4), ("1", 2), ("3", 1), ("8", 6), ("9", 6), ("9", 5), ("9", 4)], "id string, pid long")
    found = prepare.songs_with_playlists(songs, prepare.song_playlists(pairs, size), how)
    lists = {("1", "a"): [2, 4, 4], ("2", "b"): [], ("3", "c"): [1]}
    if how == "full":
        lists |= {("8", None): [6], ("9", None): [4, 5, 6]}
    expected = [(*key, i // size, ids[i : i + size]) for key, ids in lists.items() for i in range(0, max(len(ids), 1), size)]
    assert rows(found) == sorted(expected, key=repr)


def test_an_unknown_join_is_refused(spark):
    with pytest.raises(ValueError):
        prepare.songs_with_playlists(None, None, "cross")


@pytest.mark.parametrize("partitions", [1, 6])
def test_row_numbers(spark, partitions):
    values = list(range(300))
    random.seed(1)
    random.shuffle(values)
    table = spark.createDataFrame([(v,) for v in values], "v int").repartition(partitions)
    assert rows(ordering.row_numbers(table, ["v"])) == sorted([(v, v) for v in values], key=repr)


def test_start_adds_up_weights(spark):
    table = spark.createDataFrame([(i, i % 4) for i in range(100)], "v int, w long").repartition(7)
    found = {row["v"]: row["start"] for row in ordering.with_start(table, ["v"], "start", weight="w").collect()}
    assert found == {v: sum(i % 4 for i in range(v)) for v in range(100)}


def test_buckets_are_dealt_in_turn_and_even(spark):
    setups = spark.createDataFrame([(i, 100 * (i + 1)) for i in range(12)], "run_id int, work long").repartition(5)
    dealt = ordering.balanced_buckets(setups, "work", 4, "run_id")
    assert rows(dealt, "run_id", "bucket") == sorted([(i, i % 4) for i in range(12)], key=repr)
    loads = ordering.bucket_loads(dealt, "work")
    assert rows(loads) == [(0, 3, 1500), (1, 3, 1800), (2, 3, 2100), (3, 3, 2400)]
    assert ordering.load_spread(loads).first()["spread"] == 900
    with pytest.raises(ValueError):
        ordering.balanced_buckets(setups, "work", 0, "run_id")


def test_setups_by_work(spark):
    setups = spark.createDataFrame([(0, 9, 9), (1, 2, 3), (2, 3, 2)], "run_id int, k int, max_iters int")
    assert [tuple(row) for row in ordering.by_work(setups).collect()] == [(1, 2, 3, 6), (2, 3, 2, 6), (0, 9, 9, 81)]
