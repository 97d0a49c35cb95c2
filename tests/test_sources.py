from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.operators.prepare import playlist_adjacency, unique_songs
from kindred.schema import FEATURES
from kindred.sources import results, sinks, slices, songs

A, B, C = ("AAAAAAAAAAAAAAAAAAAAA1", "AAAAAAAAAAAAAAAAAAAAA2", "AAAAAAAAAAAAAAAAAAAAA3")
NUMBERS = "201000,5,1,4,0.11,0.62,0.71,0.0,0.09,-6.2,0.04,0.55,118.0"


def track(song_id: str, title: str, artist: str) -> dict:
    return {"track_uri": f"item:track:{song_id}", "track_name": title, "artist_name": artist, "extra": 1}


@pytest.fixture
def slice_folder(tmp_path):
    one = {
        "info": {"version": "v1"},
        "playlists": [
            {"pid": 0, "name": "x", "tracks": [track(A, "One, Two", "Ann"), track(B, "Three", "Bo"), track(A, "One, Two", "Ann")]},
            {"pid": 1, "tracks": []},
            {"pid": 2, "tracks": [track(C, "First", "Cy")]},
            {"pid": 2, "tracks": [track(B, "Three", "Bo")]},
        ],
    }
    two = {"playlists": [{"pid": 3, "tracks": [track(B, "Three (Live)", "Bo")]}]}
    (tmp_path / "a.json").write_text(json.dumps(one, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(two, indent=2))
    return str(tmp_path)


def test_playlists_keep_order_and_repeats_and_the_last_of_a_pid(spark, slice_folder):
    found = slices.playlists_of(slices.read_slices(spark, slice_folder))
    assert rows(found, "pid", "track_ids") == [(0, [A, B, A]), (1, []), (2, [B]), (3, [B])]


def test_tracks_of_every_playlist(spark, slice_folder):
    found = slices.tracks_of(slices.read_slices(spark, slice_folder))
    assert rows(found.filter("pid = 0"), "pos", "id", "title") == [(0, A, "One, Two"), (1, B, "Three"), (2, A, "One, Two")]
    # Both playlists numbered 2 give songs.
    assert found.filter("pid = 2").count() == 2


def test_one_row_per_song_over_all_files(spark, slice_folder):
    found = unique_songs(slices.tracks_of(slices.read_slices(spark, slice_folder)), ["slice", "pid", "pos"])
    assert rows(found) == [(A, "One, Two", "Ann"), (B, "Three", "Bo"), (C, "First", "Cy")]


def test_a_broken_slice_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"playlists": [{"pid": ')
    with pytest.raises(Exception):
        slices.read_slices(spark, str(tmp_path)).collect()


def test_song_lines(spark, tmp_path):
    (tmp_path / "s").write_text(f'{A}\tOne "Two,Ann,{NUMBERS}\n{B}\tThree,Bo,{NUMBERS}\n')
    found = songs.read_songs(spark, str(tmp_path))
    assert found.columns == ["id", "title", "artist", *FEATURES]
    first = found.orderBy("id").first()
    assert (first["title"], first["duration"], first["loudness"], first["tempo"]) == ('One "Two', 201000.0, -6.2, 118.0)


@pytest.mark.parametrize("line", [f"{A}\tOne,Ann,1,2", f"{A}\tOne,Ann,{NUMBERS},9", f"{A}\tOne,Ann,{NUMBERS[:-5]}high"])
def test_a_bad_song_line_fails(spark, tmp_path, line):
    (tmp_path / "s").write_text(line + "\n")
    with pytest.raises(Exception, match="expected 16 fields|not a number"):
        songs.read_songs(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("tail,expected", [("[0;7;12]", [0, 7, 12]), ("]", []), ("[]", []), ("[4]", [4])])
def test_song_lines_with_playlists(spark, tmp_path, tail, expected):
    (tmp_path / "s").write_text(f"{A}\tOne,Ann,{NUMBERS},{tail}\n")
    assert songs.read_songs_with_playlists(spark, str(tmp_path)).first()["playlists"] == expected


def test_song_lines_round_trip(spark, tmp_path):
    (tmp_path / "s").write_text(f"{A}\tOne,Ann,{NUMBERS}\n")
    found = songs.read_songs(spark, str(tmp_path / "s"))
    sinks.write_features(found, str(tmp_path / "out"))
    assert rows(songs.read_songs(spark, str(tmp_path / "out"))) == rows(found)
    with_lists = found.withColumns({"part": F.lit(2), "playlists": F.array(F.lit(3), F.lit(3_000_000_000))})
    sinks.write_songs_with_playlists(with_lists, str(tmp_path / "lists"))
    assert rows(songs.read_songs_with_playlists(spark, str(tmp_path / "lists"))) == rows(with_lists)


def test_adjacency_lines_round_trip_with_an_empty_playlist(spark, tmp_path):
    lists = spark.createDataFrame(
        [(0, 0, ["a", "b", "a"]), (0, 1, ["c"]), (1, 0, [])], "pid long, part int, track_ids array<string>"
    )
    sinks.write_adjacency(lists, str(tmp_path / "out"))
    assert rows(songs.read_adjacency(spark, str(tmp_path / "out"))) == rows(lists)


def test_adjacency_lines_without_a_part(spark, tmp_path):
    (tmp_path / "s").write_text("7\ta,b\n8\t\n")
    assert rows(songs.read_adjacency(spark, str(tmp_path))) == [(7, 0, ["a", "b"]), (8, 0, [])]
    (tmp_path / "s").write_text("7\t0\ta\tb\n")
    with pytest.raises(Exception, match="expected 2 or 3 fields"):
        songs.read_adjacency(spark, str(tmp_path)).collect()


def test_parts_of_lists_keep_their_order_as_text(spark, tmp_path):
    tracks = spark.createDataFrame([(1, i, f"s{9 - i}") for i in range(7)], "pid long, pos int, id string")
    sinks.write_adjacency(playlist_adjacency(tracks, max_items=3), str(tmp_path / "out"))
    found = songs.read_adjacency(spark, str(tmp_path / "out")).orderBy("pid", "part").collect()
    assert [song for row in found for song in row["track_ids"]] == [f"s{9 - i}" for i in range(7)]


def test_adjacency_lines_in_order_of_pid(spark, tmp_path):
    tracks = spark.createDataFrame([((pid * 37) % 101, i, f"s{i}") for pid in range(101) for i in range(5)], "pid long, pos int, id string")
    sinks.write_adjacency(playlist_adjacency(tracks.repartition(6), max_items=2), str(tmp_path / "out"), in_order=True)
    files = sorted((tmp_path / "out").glob("part-*"))
    keys = [tuple(map(int, line.split("\t")[:2])) for file in files for line in file.read_text().splitlines()]
    assert keys == [(pid, part) for pid in range(101) for part in range(3)]


def test_names_cannot_corrupt_song_lines(spark, tmp_path):
    names = [("1", None, "A"), ("2", "a\tb", "c\nd"), ("3", 'say "x"', None)]
    sinks.write_unique_songs(spark.createDataFrame(names, "id string, title string, artist string"), str(tmp_path / "out"))
    assert rows(songs.read_unique_songs(spark, str(tmp_path / "out"))) == [
        ("1", "", "A"), ("2", "a b", "c d"), ("3", 'say "x"', ""),
    ]
    (tmp_path / "bad").write_text("1\ttitle\n")
    with pytest.raises(Exception, match="expected 3 fields"):
        songs.read_unique_songs(spark, str(tmp_path / "bad")).collect()


def test_a_song_without_a_feature_is_not_written(spark, tmp_path):
    (tmp_path / "s").write_text(f"{A}\tOne,Ann,{NUMBERS}\n")
    found = songs.read_songs(spark, str(tmp_path / "s"))
    with pytest.raises(Exception, match="no tempo"):
        sinks.write_features(found.withColumn("tempo", F.lit(None).cast("double")), str(tmp_path / "out"))
    sinks.write_features(found.withColumn("title", F.lit(None).cast("string")), str(tmp_path / "untitled"))
    assert songs.read_songs(spark, str(tmp_path / "untitled")).first()["title"] == ""


def test_a_playlist_without_a_number_is_kept(spark, tmp_path):
    lists = [{"tracks": [track(A, "x", "y")]}, {"pid": 1, "tracks": []}, {"tracks": [track(B, "x", "y")]}]
    (tmp_path / "a.json").write_text(json.dumps({"playlists": lists}))
    found = slices.playlists_of(slices.read_slices(spark, str(tmp_path)))
    assert sorted((str(row["pid"]), row["track_ids"]) for row in found.collect()) == [("1", []), ("None", [B])]


def test_sinks_replace_what_was_there(spark, tmp_path):
    for title in ("old", "new"):
        table = spark.createDataFrame([("1", title, "x")], "id string, title string, artist string")
        sinks.write_unique_songs(table, str(tmp_path / "out"))
    assert rows(songs.read_unique_songs(spark, str(tmp_path / "out"))) == [("1", "new", "x")]


def test_mixed_lines_are_told_apart(spark):
    lines = [f"12\t{A},{B}", f"{A}\tOne,Ann,1.0", f"{B}\tThree\tBo", "9999999999999999999999\tlong,number", "blank"]
    playlists, found = songs.split_tagged(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert rows(playlists) == [(12, [A, B])]
    # A number of 22 digits is a song id.
    assert rows(found) == [("9999999999999999999999", "long,number"), (A, "One,Ann,1.0")]


def test_setups_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "s").write_text("300 123 20 0.0\n100 7 5 0.5\n\n200 1 1 1.5\n")
    assert rows(results.read_setups(spark, str(tmp_path))) == [
        (0, 300, 123, 20, 0.0), (1, 100, 7, 5, 0.5), (2, 200, 1, 1, 1.5),
    ]


def test_error_lines_pass_over_other_files(spark, tmp_path):
    (tmp_path / "part-0").write_text("Array(8500.0, 1.1898)\nArray(5.0, 2.0E-4)\n\n")
    (tmp_path / "other").write_text("nothing here\n")
    assert rows(results.read_errors(spark, str(tmp_path))) == [(5, 2.0e-4), (8500, 1.1898)]


def test_run_lines(spark, tmp_path):
    line = "(Setup(100,123,20,0.0),ReadableClustering(18,3.5,ListBuffer((0,A [b],C)),ListBuffer(),ListBuffer()))"
    (tmp_path / "part-0").write_text(line + "\n\n")
    assert rows(results.read_run_errors(spark, str(tmp_path))) == [(100, 123, 20, 0.0, 18, 3.5)]


def test_assignment_lines_keep_brackets_and_commas_in_titles(spark, tmp_path):
    (tmp_path / "part-0").write_text("(0,[Night,Kay])\n(12,[Go (Mix) [feat. X],[Y]])\n(3,[a, b,Z])\n\n")
    assert rows(results.read_assignments(spark, str(tmp_path))) == [
        (0, "Night", "Kay"), (12, "Go (Mix) [feat. X]", "[Y]"), (3, "a, b", "Z"),
    ]


def test_text_functions(spark):
    table = spark.createDataFrame([("item:track:x1", "a,b", "MAJOR", "1, 2,3"), ("k:t:y:2", "c", "MINOR", "4")], "u string, t string, m string, n string")
    found = table.select(
        text.track_id(F.col("u")), text.without_commas(F.col("t")), text.mode_code(F.col("m")), text.integer_list(F.col("n"))
    )
    assert rows(found) == [("x1", "ab", 1, [1, 2, 3]), ("y:2", "c", 0, [4])]
    assert text.parse_integers("5,10") == [5, 10]


def test_heads_of_lines_too_long_for_a_row(spark, tmp_path):
    entries = ",".join(f"({i % 7},Title {i} [live] (x),Ann)" for i in range(400_000))
    heads = [(5, 9.25), (6, 8.5), (7, 7.75)]
    lines = [f"(Setup({k},-3,20,1.0E-4),ReadableClustering({k + 1},{e},ListBuffer({entries}),ListBuffer(),ListBuffer((0,ListBuffer(1.0)))))" for k, e in heads]
    # Runs without entries follow each other in one piece.
    lines += [f"(Setup({k},1,2,0.0),ReadableClustering(1,0.5,ListBuffer(),ListBuffer(),ListBuffer()))" for k in (8, 9)]
    (tmp_path / "runs").write_text("\n".join(lines) + "\r\n")
    want = [(k, -3, 20, 0.0001, k + 1, e) for k, e in heads] + [(k, 1, 2, 0.0, 1, 0.5) for k in (8, 9)]
    assert rows(results.read_run_errors(spark, str(tmp_path / "runs"))) == sorted(want, key=repr)
    assert results._run_pieces(spark, str(tmp_path / "runs")).agg(F.max(F.length("value"))).first()[0] < 200


def test_streamed_playlists_are_those_of_whole_files(spark, slice_folder):
    whole = slices.playlists_of(slices.read_slices(spark, slice_folder))
    assert rows(slices.read_playlists(spark, slice_folder, 0), "pid", "track_ids") == rows(whole, "pid", "track_ids")
    tracks = slices.tracks_of(slices.read_slices(spark, slice_folder))
    assert rows(slices.read_tracks(spark, slice_folder, 0)) == rows(tracks)
    # Whole files up to the size of the smaller one, the other streamed.
    size = min(path.stat().st_size for path in Path(slice_folder).iterdir())
    assert rows(slices.read_playlists(spark, slice_folder, size), "pid", "track_ids") == rows(whole, "pid", "track_ids")


@pytest.mark.parametrize("step", [1, 2, 7, 10**6])
@pytest.mark.parametrize("indent", [None, 2])
def test_playlists_are_cut_wherever_pieces_end(step, indent):
    playlists = [
        {"pid": 0, "name": 'a } " { [ \\ "playlists": [', "tracks": [{"track_uri": "x}{", "more": [[{"a": {}}], []]}]},
        {"pid": 1, "tracks": []}, {}, {"name": "\\\\", "pid": 2},
    ]
    text = json.dumps({"before": [{"pid": 9}], "info": {"playlists": [{"pid": 8}]}, "playlists": playlists, "after": [{"pid": 7}], "z": "playlists"}, indent=indent)
    cutter, found = slices.PlaylistCutter(), []
    # Pieces end behind a brace in the files; here they end anywhere but inside an escape.
    at = 0
    while at < len(text):
        end = at + step
        while end < len(text) and text[at:end].endswith("\\"):
            end += 1
        found += cutter.feed(text[at:end])
        at = end
    cutter.end("this")
    assert [json.loads(one) for one in found] == playlists
    cutter = slices.PlaylistCutter()
    list(cutter.feed(text[: text.index('"after"')].rstrip()[:-2]))
    with pytest.raises(ValueError):
        cutter.end("this")


def test_a_file_of_many_times_the_usual_size(spark, tmp_path):
    usual, n = 40, 4_000
    one = [{"pid": i // 2 if i < 20 else i, "tracks": [track(f"{i:021d}{j}", f"T}} {j}", "Ann") for j in range(5)]} for i in range(n)]
    (tmp_path / "big.json").write_text(json.dumps({"info": {}, "playlists": one}, indent=1))
    (tmp_path / "usual.json").write_text(json.dumps({"playlists": [{**p, "pid": n + p["pid"]} for p in one[:usual]]}))
    limit = 200_000
    found = slices.read_playlists(spark, str(tmp_path), limit)
    assert (tmp_path / "big.json").stat().st_size > 10 * limit > 0
    whole = slices.playlists_of(slices.read_slices(spark, str(tmp_path)))
    assert rows(found, "pid", "track_ids") == rows(whole, "pid", "track_ids")
    places = slices.stream_playlists(spark, str(tmp_path), limit)
    assert rows(places, "place") == sorted([(i,) for i in range(n)], key=repr)
    # No row that is shuffled or reaches a worker holds more than a track.
    pieces = spark.read.option("lineSep", slices.PIECE_END).text(str(tmp_path))
    assert pieces.agg(F.max(F.length("value"))).first()[0] < 400


def test_large_files_are_not_read_whole_and_broken_ones_fail(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"playlists": [{"pid": 1, "tracks": []}]}')
    (tmp_path / "b.json").write_text('{"playlists": [{"pid": 2, "tracks": []}, ' + " " * 500)
    # The broken file is beyond the size, so the reader of whole files never sees it.
    assert slices.read_slices(spark, str(tmp_path), 300).count() == 1
    with pytest.raises(Exception, match="ends inside"):
        slices.read_playlists(spark, str(tmp_path), 300).collect()
