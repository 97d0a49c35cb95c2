"""Queries on building the song table, the text formats and the global orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.text import decode_list, encode_list, feature_text, integer_list
from kindred.operators import ordering, prepare
from kindred.queries import tables
from kindred.queries.tables import TRACK_ORDER, read
from kindred.schema import FEATURES
from kindred.session import fresh_path
from kindred.sources import results, sinks, slices, songs


def joined(column: str) -> Column:
    return F.array_join(F.transform(column, lambda v: v.cast("string")), ",").alias(column)


def playlist_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    lists = prepare.playlist_adjacency(tables.tracks(spark, folder), TRACK_ORDER)
    return lists.select("pid", "part", joined("track_ids"))


def playlist_adjacency_parts(spark: SparkSession, folder: str) -> DataFrame:
    lists = prepare.playlist_adjacency(tables.tracks(spark, folder), TRACK_ORDER, max_items=3)
    return lists.select("pid", "part", joined("track_ids"))


def adjacency_pairs(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "adjacency")
    sinks.write_adjacency(prepare.playlist_adjacency(tables.tracks(spark, folder), TRACK_ORDER), path)
    return prepare.adjacency_pairs(songs.read_adjacency(spark, path))


def nested_playlists(spark: SparkSession, folder: str) -> DataFrame:
    found = slices.read_playlists(spark, tables.written_slices(spark, folder))
    return found.select("pid", joined("track_ids"))


def nested_playlists_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every file streamed."""
    found = slices.read_playlists(spark, tables.written_slices(spark, folder), streamed_bytes=0)
    return found.select("pid", joined("track_ids"))


def nested_tracks(spark: SparkSession, folder: str) -> DataFrame:
    return slices.read_tracks(spark, tables.written_slices(spark, folder)).drop("slice")


def nested_tracks_streamed(spark: SparkSession, folder: str) -> DataFrame:
    return slices.read_tracks(spark, tables.written_slices(spark, folder), streamed_bytes=0).drop("slice")


def nested_songs(spark: SparkSession, folder: str) -> DataFrame:
    tracks = slices.read_tracks(spark, tables.written_slices(spark, folder))
    return prepare.unique_songs(tracks, ["slice", "pid", "pos"])


def dedup_songs(spark: SparkSession, folder: str) -> DataFrame:
    named = read(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("id"),
        F.concat("l_returnflag", "l_linestatus").alias("title"),
        F.col("l_suppkey").cast("string").alias("artist"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
    )
    return prepare.unique_songs(named, ["l_orderkey", "l_linenumber", "l_suppkey"])


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as songs; many have no labels, and many no orders of their number."""
    return read(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("title"), F.col("source").alias("artist")
    )


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality", "toxic")


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "enriched")
    found = prepare.enrich(_texts(spark, folder), _labels(spark, folder), ["quality", "toxic"])
    sinks.write_enriched(found, path)
    return spark.read.parquet(path)


def enrich_success(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.successes(_enriched(spark, folder))


def enrich_failure(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.failures(_enriched(spark, folder))


def missing_songs(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.missing(_texts(spark, folder), _labels(spark, folder))


def song_playlists(spark: SparkSession, folder: str) -> DataFrame:
    lists = prepare.song_playlists(tables.pairs(spark, folder)).all()
    return lists.select("id", "part", joined("playlists"))


def song_playlists_parts(spark: SparkSession, folder: str) -> DataFrame:
    lists = prepare.song_playlists(tables.pairs(spark, folder), max_items=30).all()
    return lists.select("id", "part", joined("playlists"))


def _order_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by customer: some customers have the number of no document or part, and the other way round."""
    return read(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").alias("pid")
    )


def _with_playlists(spark: SparkSession, folder: str, how: str, **limits: int) -> DataFrame:
    lists = prepare.song_playlists(_order_pairs(spark, folder), **limits)
    attached = prepare.songs_with_playlists(_texts(spark, folder), lists, how)
    return attached.select("id", "title", "artist", "part", encode_list(F.col("playlists")).alias("playlists"))


def songs_with_playlists(spark: SparkSession, folder: str) -> DataFrame:
    return _with_playlists(spark, folder, "left")


def songs_with_playlists_full(spark: SparkSession, folder: str) -> DataFrame:
    return _with_playlists(spark, folder, "full")


def songs_with_playlists_parts(spark: SparkSession, folder: str) -> DataFrame:
    return _with_playlists(spark, folder, "full", max_items=4)


def list_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Lists as text and back, of numbers beyond 32 bits."""
    far = _order_pairs(spark, folder).withColumn("pid", F.col("pid") + F.lit(2**40))
    attached = prepare.songs_with_playlists(_texts(spark, folder), prepare.song_playlists(far))
    decoded = attached.select("id", decode_list(encode_list(F.col("playlists"))).alias("pids"))
    total = F.aggregate("pids", F.lit(0).cast("long"), lambda t, v: t + v)
    return decoded.select("id", F.size("pids").alias("n"), total.alias("total"))


def mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Playlist, song and three-field lines read from one place and told apart again."""
    path = fresh_path(spark, "mixed")
    parts = read(spark, folder, "part")
    song_id = F.lpad(F.concat(F.lit("s"), F.col("p_partkey").cast("string")), 22, "0")
    song_lines = parts.select(F.concat_ws("\t", song_id, F.concat_ws(",", "p_name", "p_brand")).alias("value"))
    three_fields = parts.select(F.concat_ws("\t", song_id, "p_name", "p_brand").alias("value"))
    lists = prepare.playlist_adjacency(tables.tracks(spark, folder), TRACK_ORDER)
    playlist_lines = lists.select(
        F.concat_ws("\t", F.col("pid").cast("string"), F.array_join("track_ids", ",")).alias("value")
    )
    playlist_lines.unionByName(song_lines).unionByName(three_fields).write.text(path)
    playlists, found = songs.split_tagged(spark.read.text(path))
    return playlists.select(
        F.lit("P").alias("kind"), F.col("pid").cast("string").alias("key"), F.array_join("track_ids", ",").alias("rest")
    ).unionByName(found.select(F.lit("A").alias("kind"), F.col("id").alias("key"), F.col("song").alias("rest")))


def song_count(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.unique_songs(
        tables.tracks(spark, folder).select("id", "pid", "pos", F.col("id").alias("title"), F.col("id").alias("artist")),
        ["pid", "pos"],
    ).agg(F.count(F.lit(1)).alias("songs"))


def json_props(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select("event_id", slices.json_field("props", "$.k", "int").alias("k"))


def feature_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The text of a feature line; whole-number features only, which all engines print alike."""
    whole = tables.featured_songs(spark, folder)
    for name in FEATURES:
        whole = whole.withColumn(name, F.floor(name).cast("int"))
    return whole.select("id", feature_text().alias("line"))


def feature_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "features")
    sinks.write_features(tables.featured_songs(spark, folder), path)
    return songs.read_songs(spark, path)


def feature_lines_with_playlists(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "features-playlists")
    lists = prepare.song_playlists(_order_pairs(spark, folder), max_items=4)
    listed = prepare.songs_with_playlists(tables.featured_songs(spark, folder), lists)
    sinks.write_songs_with_playlists(listed, path)
    found = songs.read_songs_with_playlists(spark, path)
    return found.select("id", "title", "duration", "tempo", "part", joined("playlists"))


def adjacency_part_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of lists as text and back, still in order."""
    path = fresh_path(spark, "adjacency")
    sinks.write_adjacency(prepare.playlist_adjacency(tables.tracks(spark, folder), TRACK_ORDER, max_items=3), path)
    return songs.read_adjacency(spark, path).select("pid", "part", joined("track_ids"))


def unique_song_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Names with tabs, line ends and quotes, as text and back."""
    path = fresh_path(spark, "songs")
    odd = tables.songs(spark, folder).withColumns({
        "title": F.concat("title", F.lit('\t"'), "artist", F.lit("\n")), "artist": F.nullif("artist", F.lit("Brand#1")),
    })
    sinks.write_unique_songs(odd, path)
    return songs.read_unique_songs(spark, path)


def assignment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Assignments as text and back; titles and artists hold brackets."""
    path = fresh_path(spark, "assignments")
    placed = read(spark, folder, "part").select(
        F.col("p_size").alias("cluster"),
        F.col("p_partkey").alias("id"),
        F.format_string("%s (live) [%s, %d]", "p_name", "p_type", "p_partkey").alias("title"),
        F.format_string("[%s]", "p_brand").alias("artist"),
    )
    sinks.write_assignment_lines(placed, path)
    return results.read_assignments(spark, path)


def _errors_by_size(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").groupBy(F.col("p_size").alias("k")).agg(F.max("p_retailprice").alias("wsos"))


def error_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "errors")
    sinks.write_errors(_errors_by_size(spark, folder), path)
    return results.read_errors(spark, path)


def run_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "run-lines")
    line = F.format_string(
        "(Setup(%d,123,20,0.5),ReadableClustering(%d,%s,ListBuffer((0,a,b)),ListBuffer((0,ListBuffer(1.0))),ListBuffer()))",
        "k", F.col("k") + 1, F.col("wsos").cast("string"),
    )
    _errors_by_size(spark, folder).select(line.alias("value")).write.text(path)
    return results.read_run_errors(spark, path)


def setup_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "setups")
    sizes = read(spark, folder, "part").groupBy(F.col("p_size").alias("k"))
    asked = sizes.agg(F.count(F.lit(1)).alias("seed"), F.max("p_retailprice").alias("epsilon"))
    sinks.write_setups(asked.select("k", "seed", F.lit(20).alias("max_iters"), "epsilon", F.col("k").alias("run_id")), path)
    return results.read_setups(spark, path)


def integer_lists(spark: SparkSession, folder: str) -> DataFrame:
    """A comma list out of each customer's name, read as integers."""
    text = F.concat_ws(",", F.regexp_extract("c_name", "([0-9]+)", 1), F.col("c_nationkey").cast("string"))
    numbers = read(spark, folder, "customer").select("c_custkey", integer_list(text).alias("numbers"))
    return numbers.select("c_custkey", F.posexplode("numbers").alias("pos", "number"))


def row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    keys = read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return ordering.row_numbers(keys, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row")


def _dealt(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.balanced_buckets(orders, "o_totalprice", 12, "o_orderkey")


def balanced_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return _dealt(spark, folder).select("o_orderkey", "bucket")


def bucket_loads(spark: SparkSession, folder: str) -> DataFrame:
    loads = ordering.bucket_loads(_dealt(spark, folder), "o_totalprice")
    return loads.select("bucket", "rows", F.round("load", 2).alias("load"))


def load_spread(spark: SparkSession, folder: str) -> DataFrame:
    spread = ordering.load_spread(ordering.bucket_loads(_dealt(spark, folder), "o_totalprice"))
    return spread.select(F.round("spread", 2).alias("spread"))


def work_order(spark: SparkSession, folder: str) -> DataFrame:
    asked = read(spark, folder, "part").select(
        F.col("p_partkey").alias("run_id"), F.col("p_size").alias("k"), (F.col("p_size") + 3).alias("max_iters")
    )
    return ordering.by_work(asked)


QUERIES = {
    query.__name__: query
    for query in (
        playlist_adjacency, playlist_adjacency_parts, adjacency_part_lines, adjacency_pairs, nested_playlists, nested_tracks, nested_songs,
        nested_playlists_streamed, nested_tracks_streamed,
        dedup_songs, enrich_success, enrich_failure, missing_songs, song_playlists, song_playlists_parts,
        songs_with_playlists, songs_with_playlists_full, songs_with_playlists_parts, list_decode, mixed_lines,
        song_count, json_props, feature_text_lines, feature_lines, feature_lines_with_playlists, unique_song_lines,
        assignment_lines, error_lines, run_lines, setup_lines, integer_lists, row_numbers, balanced_buckets,
        bucket_loads, load_spread, work_order,
    )
}
