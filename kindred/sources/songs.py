"""Song text files: features, features with playlists, and the lines that mix both.

Lines are split by hand rather than by a CSV reader because titles may hold quote marks. A line
with the wrong number of pieces or a bad number fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.text import decode_list, fields, is_playlist_key
from kindred.schema import FEATURES, SONG_ID_LENGTH, SONG_TEXT_COLUMNS

_SONG_FIELDS = SONG_TEXT_COLUMNS + FEATURES


def parse_songs(lines: DataFrame) -> DataFrame:
    """Lines of 16 pieces, in a column ``value``, as the columns of a song."""
    pieces = lines.select(_pieces(len(_SONG_FIELDS)))
    return pieces.select(*_song_columns())


def parse_songs_with_playlists(lines: DataFrame) -> DataFrame:
    """Lines of a song, the part its list is, and its bracketed playlists.

    Lines of 17 pieces have no part and are part 0. A song whose list has several parts has a line for
    each; those of part 0 are the songs.
    """
    pieces = lines.select(_pieces(len(_SONG_FIELDS) + 1, len(_SONG_FIELDS) + 2))
    parted = F.size("pieces") > len(_SONG_FIELDS) + 1
    part = F.when(parted, F.get("pieces", F.lit(len(_SONG_FIELDS))).cast("int")).otherwise(F.lit(0))
    playlists = decode_list(F.get("pieces", F.size("pieces") - 1))
    return pieces.select(*_song_columns(), part.alias("part"), playlists.alias("playlists"))


def read_songs(spark: SparkSession, path: str, form: str = "text") -> DataFrame:
    """Songs with their features, from feature lines or from Parquet with the same columns."""
    if form == "parquet":
        columns = [F.col(name) for name in SONG_TEXT_COLUMNS] + [F.col(name).cast("double") for name in FEATURES]
        return spark.read.parquet(path).select(*columns)
    return parse_songs(spark.read.text(path))


def read_songs_with_playlists(spark: SparkSession, path: str) -> DataFrame:
    return parse_songs_with_playlists(spark.read.text(path))


def _pieces(*expected: int) -> Column:
    return _counted(fields(F.col("value")), *expected).alias("pieces")


def _counted(pieces: Column, *expected: int) -> Column:
    """Pieces of a line, whose number must be one of those expected."""
    message = F.concat(F.lit(f"expected {' or '.join(map(str, expected))} fields: "), F.col("value"))
    return F.when(F.size(pieces).isin(*expected), pieces).otherwise(F.raise_error(message))


def _song_columns() -> list[Column]:
    texts = [F.get("pieces", F.lit(i)).alias(name) for i, name in enumerate(SONG_TEXT_COLUMNS)]
    first = len(SONG_TEXT_COLUMNS)
    return texts + [_number(first + i).alias(name) for i, name in enumerate(FEATURES)]


def _number(position: int) -> Column:
    text = F.get("pieces", F.lit(position))
    number = text.try_cast("double")
    return F.when(number.isNotNull(), number).otherwise(
        F.raise_error(F.concat(F.lit("not a number: "), text))
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``pid<TAB>part<TAB>id,id,...`` as ``(pid, part, track_ids)``.

    Lines without a part are part 0; a line without ids is an empty list.
    """
    lines = spark.read.text(path).select(_counted(F.split("value", "\t"), 2, 3).alias("pieces"))
    ids = F.get("pieces", F.size("pieces") - 1)
    part = F.when(F.size("pieces") == 3, F.get("pieces", F.lit(1)).cast("int")).otherwise(F.lit(0))
    return lines.select(
        F.get("pieces", F.lit(0)).cast("long").alias("pid"),
        part.alias("part"),
        F.when(ids == "", F.array().cast("array<string>")).otherwise(F.split(ids, ",")).alias("track_ids"),
    )


def read_unique_songs(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id<TAB>title<TAB>artist``."""
    lines = spark.read.text(path).select(_counted(F.split("value", "\t"), 3).alias("pieces"))
    return lines.select(*[F.get("pieces", F.lit(i)).alias(name) for i, name in enumerate(SONG_TEXT_COLUMNS)])


def split_tagged(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tell playlist lines from song lines in one bag of text lines.

    Only lines of exactly two tab-separated fields count. Returns ``(pid, track_ids)`` and
    ``(id, song)``, where ``song`` is the rest of the line.
    """
    parts = F.split("value", "\t")
    pairs = lines.filter(F.size(parts) == 2).select(
        F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("rest")
    )
    is_playlist = is_playlist_key(F.col("key"), SONG_ID_LENGTH)
    playlists = pairs.filter(is_playlist).select(
        F.col("key").cast("long").alias("pid"), F.split("rest", ",").alias("track_ids")
    )
    songs = pairs.filter(~is_playlist).select(F.col("key").alias("id"), F.col("rest").alias("song"))
    return playlists, songs
