"""Column names and types shared by every table of the library."""

from __future__ import annotations

from pyspark.sql import types as T

# The thirteen numeric features of an item, in file order.
FEATURES = [
    "duration",
    "key",
    "modality",
    "signature",
    "acousticness",
    "danceability",
    "energy",
    "instrumentalness",
    "liveness",
    "loudness",
    "speechiness",
    "valence",
    "tempo",
]

# Length of a song id, and the names written for centers that are not songs.
SONG_ID_LENGTH = 22
NAME_NOT_FOUND = "<Not Found>"
NAME_SYNTHETIC = "<Synthetic>"

ALGORITHMS = ("kmeans", "kmedoids")

SONG_TEXT_COLUMNS = ["id", "title", "artist"]

SONG_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in SONG_TEXT_COLUMNS]
    + [T.StructField(name, T.DoubleType()) for name in FEATURES]
)

TRACK_TYPE = T.StructType(
    [
        T.StructField("track_uri", T.StringType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("artist_name", T.StringType()),
    ]
)

PLAYLIST_TYPE = T.StructType(
    [
        T.StructField("pid", T.LongType()),
        T.StructField("tracks", T.ArrayType(TRACK_TYPE)),
    ]
)

SLICE_SCHEMA = T.StructType([T.StructField("playlists", T.ArrayType(PLAYLIST_TYPE))])

SETUP_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.IntegerType(), False),
        T.StructField("k", T.IntegerType(), False),
        T.StructField("seed", T.IntegerType(), False),
        T.StructField("max_iters", T.IntegerType(), False),
        T.StructField("epsilon", T.DoubleType(), False),
    ]
)
