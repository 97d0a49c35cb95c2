"""Rows of a large table whose key a smaller table may name, told apart in the scan.

The keys of the smaller table are bits of a map in ``WORDS`` words of 64, so the map is a table of bounded size, whatever
the data, and is broadcast. Rows that the map does not know have no key in the smaller table for sure and need no
shuffle; only those that it lets through meet the keys themselves. With a few million keys next to none is let
through for nothing, with more than some ten million more and more are: the exact join then has more to do, and the
result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import materialize

WORDS = 2**20


def _word(number: Column) -> Column:
    return F.pmod(number, F.lit(WORDS))


def _bits(number: Column) -> Column:
    """Two bits of a word, from parts of the hash that do not choose the word."""
    one = lambda shift: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(number, shift).bitwiseAND(63).cast("int"))
    return one(40).bitwiseOR(one(50))


def key_map(keys: DataFrame, *columns: str | Column) -> DataFrame:
    """``(_word, _bits)`` of all keys: at most ``WORDS`` rows, written."""
    number = F.xxhash64(*columns)
    bits = keys.select(_word(number).alias("_word"), _bits(number).alias("_bits"))
    return materialize(bits.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")), "key-map")


def named(rows: DataFrame, keys: DataFrame, *columns: Column, negate: bool = False) -> DataFrame:
    """The rows whose key the map lets through, or all others; ``columns`` give the key, from ``rows``.

    Columns of ``rows`` may have any names.
    """
    number = F.xxhash64(*columns)
    bits = _bits(number)
    there = (_word(number) == keys["_word"]) & (keys["_bits"].bitwiseAND(bits) == bits)
    # At most WORDS rows of two numbers.
    return rows.join(F.broadcast(keys), there, "left_anti" if negate else "left_semi")


def without(rows: DataFrame, keys: DataFrame, left: list[Column], right: list[str], map_: DataFrame | None = None) -> DataFrame:
    """The rows whose key is not in ``keys``, null-safe; ``left`` gives a row's key, ``right`` names its columns in ``keys``.

    Rows that stay pass no shuffle, but for the few that the map lets through for nothing.
    """
    map_ = key_map(keys, *right) if map_ is None else map_
    near = named(rows, map_, *left)
    same = [mine.eqNullSafe(keys[name]) for mine, name in zip(left, right)]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return named(rows, map_, *left, negate=True).unionByName(near.join(keys, condition, "left_anti"))
