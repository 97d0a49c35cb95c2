"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.text import mode_code
from kindred.functions.vectors import assemble
from kindred.operators.prepare import ordered_lists
from kindred.operators.scale import scaled_features, scaled_vectors
from kindred.schema import FEATURES
from kindred.session import fresh_path

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRACK_ORDER = ["pos", "l_partkey", "l_suppkey"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as tracks: ``(pid, pos, id)`` and the columns that settle the order."""
    return read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("pid"),
        F.col("l_linenumber").alias("pos"),
        F.col("l_partkey").cast("string").alias("id"),
        "l_partkey",
        "l_suppkey",
    )


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return tracks(spark, folder).select("id", "pid")


def songs(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as songs: ``(id, title, artist)``."""
    return read(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("artist")
    )


def featured_songs(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with thirteen features taken from them and their lines; titles hold a comma."""
    lines = (
        read(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum("l_quantity").alias("duration"),
            F.min("l_linenumber").alias("signature"),
            F.max("l_discount").alias("acousticness"),
            F.min("l_discount").alias("danceability"),
            F.max("l_tax").alias("energy"),
            F.min("l_tax").alias("instrumentalness"),
            F.count(F.lit(1)).alias("liveness"),
            F.max("l_extendedprice").alias("loudness"),
            F.max("l_quantity").alias("speechiness"),
            F.min("l_quantity").alias("valence"),
            F.min("l_extendedprice").alias("tempo"),
        )
    )
    mode = F.when(F.col("p_size") > 25, "MAJOR").otherwise("MINOR")
    return (
        read(spark, folder, "part")
        .join(lines, F.col("p_partkey") == F.col("l_partkey"))
        .withColumns(
            {
                "id": F.col("p_partkey").cast("string"),
                "title": F.concat_ws(", ", "p_name", "p_type"),
                "artist": F.col("p_brand"),
                "key": F.col("p_size"),
                "modality": mode_code(mode),
            }
        )
        .select("id", "title", "artist", *[F.col(name).cast("double").alias(name) for name in FEATURES])
    )


def song_points(spark: SparkSession, folder: str) -> DataFrame:
    return scaled_features(featured_songs(spark, folder), FEATURES, ["id", "title", "artist"])


def line_points(spark: SparkSession, folder: str, scale: bool = True) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    identity = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quantity).alias("id")
    lines = read(spark, folder, "lineitem").select(identity, *LINE_FEATURES)
    if not scale:
        return lines.select("id", assemble(LINE_FEATURES).alias("features"))
    return scaled_features(lines, LINE_FEATURES, ["id"])


def wide_line_points(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with thirteen features: the four numbers of a line, their products in pairs, and three keys."""
    quantity = F.col("l_quantity").cast("int")
    identity = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quantity).alias("id")
    pairs = [F.col(a) * F.col(b) for i, a in enumerate(LINE_FEATURES) for b in LINE_FEATURES[i + 1 :]]
    keys = [F.col(name).cast("double") for name in ("l_linenumber", "l_partkey", "l_suppkey")]
    numbers = [*map(F.col, LINE_FEATURES), *pairs, *keys]
    names = [f"f{i}" for i in range(len(numbers))]
    lines = read(spark, folder, "lineitem").select(identity, *[n.alias(name) for n, name in zip(numbers, names)])
    return scaled_features(lines, names, ["id"])


def embedding_points(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").withColumnRenamed("vec_id", "id")
    return scaled_vectors(vectors, "embedding", ["id", "label"])


def written_slices(spark: SparkSession, folder: str) -> str:
    """Lines packed into pretty-printed JSON files of up to 1000 playlists each."""
    track = F.struct(
        F.concat(F.lit("item:track:"), F.col("l_partkey").cast("string")).alias("track_uri"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artist_name"),
    )
    lines = (
        read(spark, folder, "lineitem")
        .join(read(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("pid"), F.col("l_linenumber").alias("pos"), "l_partkey", "l_suppkey",
            track.alias("track"),
        )
    )
    playlists = ordered_lists(lines, "pid", TRACK_ORDER, "track", "tracks").all()
    packed = (
        playlists.groupBy(F.floor(F.col("pid") / 1000).alias("slice"), "part")
        .agg(F.collect_list(F.struct("pid", "tracks")).alias("playlists"))
        .select(F.to_json(F.struct("playlists"), {"pretty": "true"}).alias("value"))
    )
    path = fresh_path(spark, "slices")
    packed.write.option("maxRecordsPerFile", 1).text(path)
    return path


def long_form(table: DataFrame, keys: list[str], vector: str, places: int = 6) -> DataFrame:
    """One row per element of a vector: ``keys``, ``dim`` and the rounded ``val``."""
    return table.select(*keys, F.posexplode(vector).alias("dim", "val")).select(
        *keys, "dim", (F.round("val", places) + F.lit(0.0)).alias("val")
    )
