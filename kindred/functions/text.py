"""Column expressions for the text formats: ids, names, feature lines and bracketed lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.schema import FEATURES, SONG_TEXT_COLUMNS


def track_id(uri: Column) -> Column:
    """The id at the end of a ``service:kind:id`` address."""
    return F.regexp_replace(uri, r"^[^:]*:[^:]*:", "")


def without_commas(value: Column) -> Column:
    """A name that cannot end a field or a line: no commas, blanks for tabs and line ends, null is empty."""
    return F.translate(one_field(value), ",", "")


def one_field(value: Column) -> Column:
    """A text as one field of a line delimited by tabs; null is empty."""
    return F.translate(F.coalesce(value, F.lit("")), "\t\n\r", "   ")


def mode_code(mode: Column) -> Column:
    """1 for MAJOR, 0 for anything else."""
    return F.when(mode == "MAJOR", F.lit(1)).otherwise(F.lit(0))


def feature_text() -> Column:
    """Title, artist and the thirteen features, comma separated in file order."""
    names = [without_commas(F.col(name)) for name in SONG_TEXT_COLUMNS[1:]]
    return F.concat_ws(",", *names, *[_feature(name) for name in FEATURES])


def _feature(name: str) -> Column:
    message = F.concat(F.lit(f"no {name}: "), F.coalesce("id", F.lit("")))
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name).cast("string"))


def feature_line() -> Column:
    """One line of a feature file: id, a tab, then :func:`feature_text`."""
    return F.concat_ws("\t", F.col("id"), feature_text())


def fields(line: Column) -> Column:
    """The pieces of a line delimited by tabs or commas; empty pieces at the end do not count."""
    return F.split(F.regexp_replace(F.translate(line, "\t", ","), ",+$", ""), ",")


def encode_list(values: Column) -> Column:
    """``[a;b;c]``."""
    return F.concat(F.lit("["), F.array_join(F.coalesce(values, F.array()), ";"), F.lit("]"))


def decode_list(value: Column) -> Column:
    """``[a;b;c]`` as an integer array; text of two characters or fewer is the empty array."""
    parts = F.split(F.translate(value, "[]", ""), ";")
    numbers = F.transform(parts, lambda part: part.cast("bigint"))
    return F.when(F.length(value) > 2, numbers).otherwise(F.array().cast("array<bigint>"))


def integer_list(value: Column) -> Column:
    """A comma separated list as an integer array."""
    return F.transform(F.split(value, ","), lambda part: F.trim(part).cast("bigint"))


def parse_integers(value: str) -> list[int]:
    """The same for an argument, such as the list of K values to try."""
    return [int(part) for part in value.split(",")]


def is_playlist_key(key: Column, song_id_length: int) -> Column:
    """Whether a key is a playlist number rather than a song id."""
    return key.rlike("^[0-9]+$") & (F.length(key) < song_id_length)
