"""Benchmark decontamination by a distributed positional inverted index.

The index of the training texts is a table in the shared folder. It is made in one pass without a shuffle: each
block of texts is a segment, and a segment has one row per term with the places of that term, ascending. A place
is one long, the text's number in the segment times 2**32 plus the word's number in the text, so places of one
text are never next to those of another. A second folder names the text of each number.

A search takes from every window of an item its rarest terms (by the counts in the index), subtracts each term's
place in the item from its places in the texts, and keeps the alignments on which all rare terms of some window
meet. The few texts that have one are read again to compare the other words; runs of words that all agree are exact
occurrences. Which texts these are is a map of bounded size (:mod:`kindred.llm.key_filter`), so the others are left
out in the scan.

Proximity matches are found on the same index: around every place of an item's rarest term the words of the text are
cut out, and the item is near if all its other terms are among them, in any order.

Search tables are small beside the index, and are written before they are joined, so that Spark knows their size
and joins them without moving the index if they are small enough for that.

Defined cases: null and empty texts and items have no words and are never hit; items of one text under several
ids are all named, rows of one item id count as one id; repeated rows of texts each have a result row; empty tables
give empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.key_filter import key_map, named, without
from kindred.llm.texts import LETTERS, blocks, release, words_of
from kindred.session import fresh_path, materialize, scratch, written

WINDOW = 10
#: How many of a window's terms have to meet before its other terms are looked up.
RARE_TERMS = 2
#: How far from a place of an item's rarest term its other terms may stand, in words, for the item to be near.
WITHIN = 50
#: Bytes of text of a segment.
SEGMENT_BYTES = 4_000_000
_TEXT = 2**32
#: Words of a text that are cut out for its alignments in one row, about.
ALIGNED_WORDS = 200_000


class Index(NamedTuple):
    """``terms``: ``(segment, term, n, places)``; ``texts``: ``(segment, number, key, digest, n_words)``."""

    terms: DataFrame
    texts: DataFrame


def _digests(block: pa.RecordBatch) -> pa.Array:
    return pa.array([hashlib.md5((t or "").encode()).digest() for t in block.column("_text").to_pylist()], pa.binary())


def build_index(docs: DataFrame, key: str, text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> Index:
    """Index the words of every text; ``key`` names a text."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "postings")
    schema = StructType(
        StructType.fromDDL("kind string, segment bigint, term binary, n bigint, places array<bigint>, number int").fields
        + [docs.schema[key]]
        + StructType.fromDDL("digest binary, n_words bigint").fields
    )

    def segments(batches):
        task = TaskContext.get().partitionId()
        for count, block in enumerate(blocks(batches, "_text", segment_bytes)):
            words = words_of(block.column("_text"), LETTERS)
            # One number for each block of each task, the same if the task runs again.
            segment = task * 2**32 + count
            rows, keys = block.num_rows, block.column(key)
            none = lambda kind, n: pa.nulls(n, kind)
            sizes = np.diff(words.first)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(["texts"] * rows), pa.array(np.full(rows, segment)), none(pa.binary(), rows), none(pa.int64(), rows),
                 none(longs, rows), pa.array(np.arange(rows, dtype=np.int32)), keys, _digests(block), pa.array(sizes, pa.int64())],
                names=schema.names,
            )
            coded = words.values.dictionary_encode()
            codes, terms = coded.indices.to_numpy(), len(coded.dictionary)
            owner = words.owner()
            places = owner * _TEXT + (np.arange(len(codes)) - words.first[owner])
            order = np.argsort(codes, kind="stable")
            counts = np.bincount(codes, minlength=terms)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            for at in range(0, terms, 20_000):
                part = slice(at, min(at + 20_000, terms))
                size = part.stop - at
                own = places[order[offsets[at] : offsets[part.stop]]]
                lists = pa.ListArray.from_arrays(
                    pa.array((offsets[at : part.stop + 1] - offsets[at]).astype(np.int32)), pa.array(own, pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["terms"] * size), pa.array(np.full(size, segment)), coded.dictionary.slice(at, size),
                     pa.array(counts[part], pa.int64()), lists, none(pa.int32(), size), none(keys.type, size),
                     none(pa.binary(), size), none(pa.int64(), size)],
                    names=schema.names,
                )
        release()

    indexed = docs.select(key, docs[text].alias("_text")).mapInArrow(segments, schema)
    # Both kinds of rows come from one pass; each has a folder of its own.
    indexed.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return open_index(spark, path, schema, key)


def open_index(spark: SparkSession, path: str, schema: StructType, key: str) -> Index:
    def folder(kind: str, *names: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(path).filter(F.col("kind") == kind)
        return rows.select("segment", *names)

    return Index(folder("terms", "term", "n", "places"), folder("texts", "number", F.col(key).alias("key"), "digest", "n_words"))


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of letters, digits and everything outside ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def search_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(item_id, item, words)`` of the items with words: ``item`` numbers their distinct word lists.

    Items of equal words are searched for once.
    """
    listed = items.select(F.col(item_id).alias("item_id"), words(items[text]).alias("words")).filter(F.size("words") > 0)
    numbered = listed.select("words").distinct().withColumn("item", F.monotonically_increasing_id())
    return materialize(listed.join(materialize(numbered, "item-numbers"), "words"), "items")


def _flat(items: DataFrame) -> DataFrame:
    once = items.groupBy("item").agg(F.first("words").alias("words"))
    return once.select("item", F.posexplode("words").alias("offset", "term")).withColumn("term", F.col("term").cast("binary"))


def _windows(terms: DataFrame, counts: DataFrame, window: int, rare: int) -> DataFrame:
    """``(item, size, windows)``: for each window of an item the offsets of its rarest terms.

    A window with a term that no text has cannot occur and is left out; so is an item without windows.
    """
    known = terms.join(counts, "term", "left").groupBy("item").agg(
        F.sort_array(F.collect_list(F.struct("offset", F.coalesce("n", F.lit(0)).alias("n")))).alias("terms")
    )
    span = F.least(F.size("terms"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("terms") - span)
    parts = F.transform(starts, lambda start: F.slice("terms", start + 1, span))
    possible = F.filter(parts, lambda part: ~F.exists(part, lambda t: t["n"] == 0))
    by_count = F.transform(
        possible,
        lambda part: F.transform(
            F.slice(F.sort_array(F.transform(part, lambda t: F.struct(t["n"].alias("n"), t["offset"].alias("offset")))), 1, rare),
            lambda t: t["offset"],
        ),
    )
    return known.select("item", F.size("terms").alias("size"), F.array_distinct(by_count).alias("windows")).filter(
        F.size("windows") > 0
    )


def _mark(offset: Column) -> Column:
    """One bit for an offset; offsets far apart may share one."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (offset % 63).cast("int"))


def term_counts(index: Index, terms: DataFrame) -> DataFrame:
    """How often each of the terms occurs in the texts, summed before any shuffle."""
    wanted = materialize(terms.select("term").distinct(), "wanted-terms")
    return index.terms.join(wanted, "term").groupBy("term").agg(F.sum("n").alias("n"))


def alignments(index: Index, items: DataFrame, window: int = WINDOW, rare: int = RARE_TERMS) -> DataFrame:
    """``(segment, number, item, shift, size)``: where an item's word 0 would stand in a text, if all rare
    terms of one of its windows meet there. ``items`` come from :func:`search_terms`."""
    terms = materialize(_flat(items), "item-terms")
    counts = materialize(term_counts(index, terms), "term-counts")
    windows = materialize(_windows(terms, counts, window, rare), "windows")
    rare_offsets = windows.select("item", F.explode(F.array_distinct(F.flatten("windows"))).alias("offset"))
    rare_terms = materialize(terms.join(rare_offsets, ["item", "offset"]), "rare-terms")
    # Offset-adjusted lists of the rare terms meet where the item would begin.
    places = index.terms.join(rare_terms, "term").select("segment", "item", "offset", F.explode("places").alias("place"))
    shift = F.col("place").bitwiseAND(_TEXT - 1) - F.col("offset")
    met = places.groupBy(
        "segment", "item", F.shiftright("place", 32).cast("int").alias("number"), shift.cast("int").alias("shift")
    ).agg(F.bit_or(_mark(F.col("offset"))).alias("marks"))
    # Shared bits may let a wrong alignment through, which the words themselves then decide.
    joint = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda so_far, o: so_far.bitwiseOR(_mark(o)))
    masks = windows.select("item", "size", F.array_distinct(F.transform("windows", joint)).alias("masks"))
    all_there = F.exists("masks", lambda mask: mask.bitwiseAND(F.col("marks")) == mask)
    found = met.join(materialize(masks, "window-masks"), "item").filter(all_there)
    return materialize(found.select("segment", "number", "item", "shift", "size"), "alignments")


def _texts_again(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``(key, digest, words)`` of the wanted ``(key, digest)``, each once."""
    digest = F.unhex(F.md5(F.coalesce(docs[text], F.lit(""))))
    near = named(docs, key_map(wanted, "key", "digest"), docs[key], digest)
    near = near.select(docs[key].alias("_key"), digest.alias("_digest"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest"))
    once = near.join(wanted, same).groupBy("key", "digest").agg(F.first("_text").alias("_text"))
    return once.select("key", "digest", words(F.col("_text")).alias("words"))


def _alignment_rows(named: DataFrame, aligned_words: int) -> DataFrame:
    """``(key, digest, block, alignments)``: the alignments of a text, in as many rows as their words call for."""
    words_ = F.sum(F.col("size").cast("bigint"))
    blocks_ = named.groupBy("key", "digest").agg(F.ceil(words_ / aligned_words).alias("blocks")).filter("blocks > 1")
    blocks_ = materialize(blocks_.select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), "blocks"), "alignment-blocks")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest"))
    salt = F.pmod(F.xxhash64("segment", "number", "item", "shift"), F.coalesce("blocks", F.lit(1)))
    return named.join(blocks_, same, "left").groupBy("key", "digest", salt.alias("block")).agg(
        F.collect_list(F.struct("segment", "number", "item", "shift", "size")).alias("alignments")
    )


def _cut_out(index: Index, docs: DataFrame, key: str, text: str, found: DataFrame) -> DataFrame:
    """Alignments ``(segment, number, item, shift, size)`` with ``there``, the words of the text that they cover."""
    named = found.join(index.texts.select("segment", "number", "key", "digest"), ["segment", "number"])
    named = materialize(named, "named-alignments")
    texts = _texts_again(docs, key, text, named.select("key", "digest").distinct())
    per_text = _alignment_rows(named, ALIGNED_WORDS)
    same = per_text["key"].eqNullSafe(texts["key"]) & (per_text["digest"] == texts["digest"])
    # Only the words of an alignment go on, not the text once for each.
    covered = lambda a: F.slice("words", F.greatest(a["shift"], F.lit(0)) + 1, a["size"] + F.least(a["shift"], F.lit(0)))
    both = F.transform("alignments", lambda a: F.struct(a.alias("at"), covered(a).alias("there")))
    return per_text.join(texts, same).select(F.explode(both).alias("cut")).select("cut.at.*", "cut.there")


def phrase_matches(index: Index, docs: DataFrame, key: str, text: str, items: DataFrame, window: int = WINDOW,
                   rare: int = RARE_TERMS) -> DataFrame:
    """Exact occurrences: ``(segment, number, item, word, length)``, runs of item words that hold a window.

    ``word`` is where the run begins in the text. An item of fewer words than a window has to occur as a whole.
    """
    cut = _cut_out(index, docs, key, text, alignments(index, items, window, rare))
    wanted = materialize(items.groupBy("item").agg(F.first("words").alias("words")), "item-words")
    skipped = F.greatest(-F.col("shift"), F.lit(0))
    equal = F.filter(
        F.sequence(F.lit(0), F.size("there") - 1),
        lambda i: F.get("there", i) == F.get("words", i + skipped),
    )
    offsets = F.when(F.size("there") > 0, equal).otherwise(F.array().cast("array<int>"))
    hits = cut.join(wanted, "item").select(
        "segment", "number", "item", "shift", "size", skipped.alias("skipped"), F.posexplode(offsets).alias("rank", "i")
    )
    # In a run of equal words, place minus rank is one number.
    runs = hits.groupBy("segment", "number", "item", "shift", "size", "skipped", (F.col("i") - F.col("rank")).alias("run")).agg(
        F.min("i").alias("first"), F.count(F.lit(1)).alias("length")
    )
    long_enough = runs.filter(F.col("length") >= F.least(F.col("size"), F.lit(window)))
    return long_enough.select(
        "segment", "number", "item", (F.col("shift") + F.col("skipped") + F.col("first")).cast("bigint").alias("word"), "length"
    )


def proximity_matches(index: Index, docs: DataFrame, key: str, text: str, items: DataFrame, within: int = WITHIN) -> DataFrame:
    """Places of an item's rarest term near which all its other terms stand: ``(segment, number, item, word)``.

    Near is at most ``within`` words away in the same text, in any order. Of terms equally rare the first in the item
    counts. An item with a term that no text has is near nowhere.
    """
    terms = materialize(_flat(items).groupBy("item", "term").agg(F.min("offset").alias("offset")), "near-terms")
    counts = materialize(term_counts(index, terms), "near-counts")
    known = terms.join(counts, "term", "left").fillna(0, ["n"])
    ordered = F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("terms")
    rarest = materialize(known.groupBy("item").agg(ordered).filter(F.col("terms")[0]["n"] > 0), "rarest-terms")
    begins = _places(index, rarest.select("item", F.col("terms")[0]["term"].alias("term"))).withColumnRenamed("place", "at")
    # The second rarest term has to be near already in the index, so only few texts are read again.
    strip = F.floor(F.col("place") / within)
    others = _places(index, rarest.filter(F.size("terms") > 1).select("item", F.col("terms")[1]["term"].alias("term")))
    around = F.explode(F.array(*[F.floor(F.col("at") / within) + i for i in (-1, 0, 1)])).alias("strip")
    paired = begins.select("segment", "item", "at", around).join(others.withColumn("strip", strip), ["segment", "item", "strip"])
    paired = paired.filter(F.abs(F.col("place") - F.col("at")) <= within).select("segment", "item", "at").distinct()
    alone = begins.join(rarest.filter(F.size("terms") == 1).select("item"), "item").select("segment", "item", "at")
    word = F.col("at").bitwiseAND(_TEXT - 1).cast("int")
    number = F.shiftright("at", 32).cast("int").alias("number")
    around = paired.select("segment", number, "item", (word - within).alias("shift"), F.lit(2 * within + 1).alias("size"))
    cut = _cut_out(index, docs, key, text, materialize(around, "around-anchors"))
    wanted = materialize(items.groupBy("item").agg(F.array_distinct(F.first("words")).alias("words")), "item-sets")
    near = cut.join(wanted, "item").filter(F.size(F.array_except("words", "there")) == 0)
    found = near.select("segment", "number", "item", (F.col("shift") + within).cast("bigint").alias("word"))
    return found.unionByName(alone.select("segment", number, "item", word.cast("bigint").alias("word")))


def _places(index: Index, terms: DataFrame) -> DataFrame:
    """``(segment, item, place)``: where the one term of each item stands."""
    wanted = materialize(terms, "single-terms")
    return index.terms.join(wanted, "term").select("segment", "item", F.explode("places").alias("place"))


def _judged(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, window: int,
            segment_bytes: int, within: int | None = None) -> DataFrame:
    """``(key, digest, n_words, n_hit, ids, n_near)`` of every row, the last three null where nothing occurs; without
    ``within`` there is no search for what is near."""
    path = fresh_path(docs.sparkSession, "judged")
    # The index and all search tables go once this is written.
    with scratch(docs.sparkSession):
        return written(_hits(docs, items, doc_id, text, item_id, item_text, window, segment_bytes, within), path)


def _hits(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, window: int,
          segment_bytes: int, within: int | None) -> DataFrame:
    index = build_index(docs, doc_id, text, segment_bytes)
    searched = search_terms(items, item_id, item_text)
    placed = materialize(phrase_matches(index, docs, doc_id, text, searched, window), "matches")
    hit_words = placed.select(
        "segment", "number", F.explode(F.sequence(F.col("word"), F.col("word") + F.col("length") - 1)).alias("word")
    )
    n_hit = hit_words.distinct().groupBy("segment", "number").agg(F.count(F.lit(1)).alias("n_hit"))
    ids = searched.select("item", F.col("item_id").cast("string").alias("id")).distinct()
    named = placed.select("segment", "number", "item").distinct().join(ids, "item")
    n_items = named.groupBy("segment", "number").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    hits = n_hit.join(n_items, ["segment", "number"], "left")
    found = index.texts.join(hits, ["segment", "number"], "left")
    if within is None:
        return found.select("key", "digest", "n_words", "n_hit", "ids", F.lit(None).cast("bigint").alias("n_near"))
    near = proximity_matches(index, docs, doc_id, text, searched, within).select("segment", "number", "item").distinct()
    n_near = near.join(ids, "item").groupBy("segment", "number").agg(F.countDistinct("id").alias("n_near"))
    return found.join(n_near, ["segment", "number"], "left").select("key", "digest", "n_words", "n_hit", "ids", "n_near")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, segment_bytes: int = SEGMENT_BYTES, within: int = WITHIN) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near)``.

    ``n_hit`` counts words inside any occurrence of a window, ``n_items`` the item ids with one, ``n_near`` those with a
    proximity match, which by itself contaminates nothing.
    """
    judged = _judged(docs, items, doc_id, text, item_id, item_text, window, segment_bytes, within)
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return judged.select(
        F.col("key").alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without an occurrence; a row goes only for its own text, whatever rows share its id."""
    hit = _judged(docs, items, doc_id, text, "item_id", "text", WINDOW, SEGMENT_BYTES).filter("n_hit > 0")
    # Written, so that Spark knows how few they are.
    hit = materialize(hit.select("key", "digest").distinct(), "contaminated-texts")
    own = F.unhex(F.md5(F.coalesce(docs[text], F.lit(""))))
    return without(docs, hit, [docs[doc_id], own], ["key", "digest"])
