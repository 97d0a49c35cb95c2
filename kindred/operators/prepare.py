"""Building the song table: lists per key, one row per song, features and playlists attached.

Lists have a row for each part of at most ``max_items`` values, numbered, in order and complete; the text
forms carry the number too. A key may hold a large share of all rows, so keys of several parts
take a path of their own that never brings their rows together in one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.ordering import with_start
from kindred.session import materialize

MAX_ITEMS = 1_000_000


class Lists(NamedTuple):
    """Lists by key: ``short`` has one row per key, ``long`` one per part of a long list.

    ``long`` and ``long_keys`` are ``None`` where no list is long.
    """

    short: DataFrame
    long: DataFrame | None
    long_keys: DataFrame | None

    def all(self) -> DataFrame:
        return self.short if self.long is None else self.short.unionByName(self.long)


def ordered_lists(
    rows: DataFrame, key: str, order: list[str], value: str, name: str, max_items: int = MAX_ITEMS
) -> Lists:
    """The values of each key as a list in the given order, repeats kept.

    Gives ``(key, part, name)`` with parts of at most ``max_items`` values, numbered from zero.
    """
    columns = list(dict.fromkeys([key, *order, value]))
    rows = rows.select(*columns)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_items)
    # At most (rows / max_items) keys; whether it is broadcast is Spark's choice from its written size.
    long_keys = materialize(counts.select(key), "long-keys")
    if long_keys.isEmpty():
        return Lists(_short_lists(rows, key, order, value, name), None, None)
    # One more scan tells the rows of both kinds apart. They are read back without a partitioning by
    # key, so the groups below are spread by what they group by.
    marks = long_keys.select(F.col(key).alias("_key"), F.lit(True).alias("_marked"))
    marked = rows.join(marks, F.col(key).eqNullSafe(F.col("_key")), "left")
    marked = materialize(marked.select(*columns, F.coalesce("_marked", F.lit(False)).alias("_long")), "marked-rows", by="_long")
    short = _short_lists(marked.filter("NOT _long"), key, order, value, name)
    long = _long_lists(marked.filter("_long").drop("_long"), key, order, value, name, max_items)
    return Lists(short, long, long_keys)


def _short_lists(rows: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    if order == [value]:
        listed = F.array_sort(F.collect_list(value))
    else:
        entry = F.struct(*dict.fromkeys([*order, value]))
        listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e[value])
    return rows.groupBy(key).agg(listed.alias(name)).select(key, F.lit(0).alias("part"), name)


def _long_lists(
    rows: DataFrame, key: str, order: list[str], value: str, name: str, max_items: int
) -> DataFrame:
    """Parts of long lists: count equal rows first, place them all in one global order, and cut
    each key's stretch of that order into parts."""
    columns = list(dict.fromkeys([key, *order, value]))
    copies = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    placed = with_start(copies, columns, "_start", weight="_copies")
    first = materialize(placed.groupBy(key).agg(F.min("_start").alias("_first")), "list-starts")
    begin = F.col("_start") - F.col("_first")
    end = begin + F.col("_copies")
    first = first.withColumnRenamed(key, "_key")
    pieces = (
        placed.join(first, F.col(key).eqNullSafe(F.col("_key")))
        .withColumn("_begin", begin)
        .withColumn("_end", end)
        # A run of equal rows may span several parts.
        .withColumn(
            "part",
            F.explode(F.sequence(F.floor(F.col("_begin") / max_items), F.floor((F.col("_end") - 1) / max_items))),
        )
        .withColumn("_from", F.greatest("_begin", F.col("part") * max_items))
        .withColumn("_take", F.least("_end", (F.col("part") + 1) * max_items) - F.col("_from"))
    )
    entry = F.struct("_from", "_take", F.col(value).alias("v"))
    repeated = F.transform(
        F.array_sort("_entries"), lambda e: F.array_repeat(e["v"], e["_take"].cast("int"))
    )
    # An exchange of its own: the join leaves all parts of a key in one place.
    return (
        pieces.repartition(F.col(key), F.col("part"))
        .groupBy(key, "part")
        .agg(F.collect_list(entry).alias("_entries"))
        .select(key, F.col("part").cast("int").alias("part"), F.flatten(repeated).alias(name))
    )


def playlist_adjacency(tracks: DataFrame, order: list[str] | None = None, max_items: int = MAX_ITEMS) -> DataFrame:
    """Track ids of each playlist in order: ``(pid, part, track_ids)`` from rows of ``(pid, pos, id)``."""
    return ordered_lists(tracks, "pid", order or ["pos"], "id", "track_ids", max_items).all()


def adjacency_pairs(playlists: DataFrame) -> DataFrame:
    """Turn playlists back into ``(id, pid)``, one row for each time a track is on one."""
    return playlists.select(F.explode("track_ids").alias("id"), "pid")


def unique_songs(tracks: DataFrame, order: list[str]) -> DataFrame:
    """One row per song id, with the title and artist of its first track in ``order``."""
    first = F.min_by(F.struct("title", "artist"), F.struct(*order))
    return tracks.groupBy("id").agg(first.alias("_first")).select("id", "_first.title", "_first.artist")


def song_playlists(pairs: DataFrame, max_items: int = MAX_ITEMS) -> Lists:
    """The playlists each song is on, sorted, repeats kept: ``(id, part, playlists)``."""
    return ordered_lists(pairs, "id", ["pid"], "pid", "playlists", max_items)


def enrich(songs: DataFrame, features: DataFrame, feature_columns: list[str]) -> DataFrame:
    """Attach features by id and mark each song ``success`` or ``failure``.

    A row with a null feature is no features. Of the others one per id counts, the least, so
    copies in the feature table cannot multiply songs. The join runs on the shuffle that picks it.
    """
    values = F.min(F.struct(*feature_columns)).alias("_features")
    found = features.dropna(subset=feature_columns).groupBy("id").agg(values)
    status = F.when(F.col("_features").isNotNull(), "success").otherwise("failure")
    return songs.join(found, "id", "left").select(
        *songs.columns, *[F.col(f"_features.{name}").alias(name) for name in feature_columns], status.alias("status")
    )


def successes(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("status") == "success").drop("status")


def failures(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("status") == "failure").select("id", "title", "artist")


def missing(songs: DataFrame, features: DataFrame) -> DataFrame:
    """Songs that the feature table does not have."""
    return songs.join(features.select("id"), "id", "left_anti")


def songs_with_playlists(songs: DataFrame, lists: Lists, how: str = "left") -> DataFrame:
    """Attach to each song its playlists: ``songs`` columns, ``part`` and ``playlists``.

    A song on no playlist has an empty list. ``how="full"`` also keeps ids that only playlists
    have. A song with a long list has one row for each part; those are joined from the parts'
    side, so that the parts of one song stay spread out.
    """
    if how not in ("left", "full"):
        raise ValueError("how must be 'left' or 'full'")
    if lists.long is None:
        return _attach(songs, lists.short, how)
    brief = songs.join(lists.long_keys, "id", "left_anti")
    busy = songs.join(lists.long_keys, "id", "left_semi")
    # For the parts the song side is the small one, so it may be the broadcast one.
    parts = lists.long.join(busy, "id", "inner" if how == "left" else "left")
    return _attach(brief, lists.short, how).unionByName(parts.select(*songs.columns, "part", "playlists"))


def _attach(songs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    empty = F.array().cast(lists.schema["playlists"].dataType)
    return songs.join(lists, "id", how).select(
        *songs.columns,
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("playlists", empty).alias("playlists"),
    )
