"""Playlist slices: pretty-printed JSON files, each one object with a list of playlists.

A file of the usual size is one row, whose nested rows are opened in place with ``inline`` and ``posexplode`` without a
shuffle. A larger file is never in memory as a whole: its text comes in small pieces, in order, and playlists are cut
out of it one by one with their places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.functions.text import track_id
from kindred.schema import PLAYLIST_TYPE, SLICE_SCHEMA

#: Files beyond this size are streamed.
STREAMED_BYTES = 256 << 20
#: What files are cut at to be streamed; the cutter puts it back, so it may also stand in a string.
PIECE_END = "}"

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(")?|[{}\[\]]', re.DOTALL)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*(")?', re.DOTALL)


def read_slices(spark: SparkSession, path: str, most_bytes: int | None = None) -> DataFrame:
    """One row per file, ``(slice, playlists)``; other keys in the files are ignored.

    With ``most_bytes`` larger files are left out, unread.
    """
    files = (
        spark.read.schema(SLICE_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    if most_bytes is not None:
        files = files.filter(F.col("_metadata.file_size") <= most_bytes)
    return files.select(F.col("_metadata.file_path").alias("slice"), "playlists")


class PlaylistCutter:
    """Cuts the objects of the top-level list ``playlists`` out of a JSON text that comes in pieces.

    It holds what there is of one playlist, no more.
    """

    def __init__(self):
        self.depth, self.in_string, self.name, self.key = 0, False, "", ""
        self.taken: list[str] | None = None

    def feed(self, text: str) -> Iterator[str]:
        """The playlists that end in this piece, as JSON."""
        at = begin = 0
        if self.in_string:
            rest = _REST_OF_STRING.match(text)
            at, self.in_string = rest.end(), rest[1] is None
            if self.depth == 1:
                self.name += rest[0]
        for token in _TOKEN.finditer(text, at):
            kind = token[0][0]
            if kind == '"':
                self.in_string = token[1] is None
                if self.depth == 1:
                    # The last string before a list or object at this depth is its key.
                    self.name = token[0]
            elif kind in "{[":
                if self.depth == 1:
                    self.key = self.name
                if kind == "{" and self.depth == 2 and self.key == '"playlists"':
                    self.taken, begin = [], token.start()
                self.depth += 1
            else:
                self.depth -= 1
                if self.taken is not None and self.depth == 2:
                    yield "".join(self.taken) + text[begin : token.end()]
                    self.taken = None
        if self.taken is not None:
            self.taken.append(text[begin:])

    def end(self, slice_: str | None) -> None:
        """Checks that the text is complete, but for a last brace that ended a piece and was not put back."""
        if self.depth > 1 or self.in_string:
            raise ValueError(f"{slice_} ends inside an object")


def _cut(batches):
    """``slice, place, playlist`` from ``slice`` and ``value``, the pieces of whole files in order."""
    slice_, cutter, place = None, PlaylistCutter(), 0
    for batch in batches:
        found = []
        for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != slice_:
                cutter.end(slice_)
                slice_, cutter, place = name, PlaylistCutter(), 0
            else:
                piece = PIECE_END + piece
            for playlist in cutter.feed(piece):
                found.append((name, place, playlist))
                place += 1
        columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["slice", "place", "playlist"])
    cutter.end(slice_)


def stream_playlists(spark: SparkSession, path: str, least_bytes: int = 0) -> DataFrame:
    """Playlists of files larger than ``least_bytes`` one by one: ``(slice, place, pid, tracks)``.

    A file's pieces are sorted by their place in it, which spills to disk if it has to, and pass one task in order.
    """
    pieces = (
        spark.read.option("lineSep", PIECE_END)
        .option("recursiveFileLookup", True)
        .text(path)
        .filter(F.col("_metadata.file_size") > least_bytes)
        .select(
            F.col("_metadata.file_path").alias("slice"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("piece"), "value",
        )
    )
    in_order = pieces.repartition("slice").sortWithinPartitions("slice", "block", "piece").select("slice", "value")
    cut = in_order.mapInArrow(_cut, "slice string, place bigint, playlist string")
    parsed = F.from_json("playlist", PLAYLIST_TYPE, {"mode": "FAILFAST"})
    return cut.select("slice", "place", parsed.alias("playlist")).select("slice", "place", "playlist.pid", "playlist.tracks")


def read_playlists(spark: SparkSession, path: str, streamed_bytes: int = STREAMED_BYTES) -> DataFrame:
    """:func:`playlists_of` all files, those beyond ``streamed_bytes`` streamed."""
    last = Window.partitionBy("slice", "pid").orderBy(F.desc("place"))
    streamed = stream_playlists(spark, path, streamed_bytes).withColumn("_turn", F.row_number().over(last)).filter("_turn = 1")
    whole = playlists_of(read_slices(spark, path, streamed_bytes))
    return whole.unionByName(streamed.select("slice", "pid", _ids_of(F.col("tracks")).alias("track_ids")))


def read_tracks(spark: SparkSession, path: str, streamed_bytes: int = STREAMED_BYTES) -> DataFrame:
    """:func:`tracks_of` all files, those beyond ``streamed_bytes`` streamed."""
    whole = tracks_of(read_slices(spark, path, streamed_bytes))
    return whole.unionByName(_opened(stream_playlists(spark, path, streamed_bytes)))


def playlists_of(slices: DataFrame) -> DataFrame:
    """Track ids of every playlist in playlist order, repeats kept: ``(slice, pid, track_ids)``.

    A playlist without tracks has an empty array. Where a slice repeats a ``pid``, the last one
    in the file stands.
    """
    return slices.select("slice", F.inline(_last_per_pid(F.col("playlists")))).select(
        "slice", "pid", _ids_of(F.col("tracks")).alias("track_ids")
    )


def _ids_of(tracks: Column) -> Column:
    return F.transform(F.coalesce(tracks, F.array()), lambda track: track_id(track["track_uri"]))


def _last_per_pid(playlists: Column) -> Column:
    """Keep the last playlist for each ``pid``, by sorting positions rather than comparing pairs."""
    keyed = F.array_sort(
        F.transform(playlists, lambda playlist, i: F.struct(playlist["pid"].alias("pid"), i.alias("i")))
    )
    last = F.filter(
        F.zip_with(
            keyed,
            F.slice(keyed, F.lit(2), F.greatest(F.size(keyed) - 1, F.lit(0))),
            lambda here, after: F.struct(
                here["i"].alias("i"),
                (after.isNull() | ~after["pid"].eqNullSafe(here["pid"])).alias("is_last"),
            ),
        ),
        lambda entry: entry["is_last"],
    )
    return F.transform(last, lambda entry: F.get(playlists, entry["i"]))


def tracks_of(slices: DataFrame) -> DataFrame:
    """One row per track of every playlist: ``(slice, pid, pos, id, title, artist)``."""
    return _opened(slices.select("slice", F.inline("playlists")))


def _opened(playlists: DataFrame) -> DataFrame:
    return playlists.select("slice", "pid", F.posexplode("tracks").alias("pos", "track")).select(
        "slice",
        "pid",
        "pos",
        track_id(F.col("track.track_uri")).alias("id"),
        F.col("track.track_name").alias("title"),
        F.col("track.artist_name").alias("artist"),
    )


def json_field(column: str, path: str, kind: str) -> Column:
    """One field of a JSON text column, cast to ``kind``."""
    return F.get_json_object(F.col(column), path).cast(kind)
