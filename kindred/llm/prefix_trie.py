"""Conversation prefix trie by whole-sequence collapse.

1. Every turn becomes a digest of its role and text with the number of its words; texts go no further. Turns are put
   in order by ranges, so a conversation of any length lies in as many ranges (its *parts*) as its turns fill.
2. A sequence is named by two 64-bit sums (exclusive or) of hashes of its turns with their places. Equal sequences
   are one from here on: a *weighted sequence* with its number of conversations, the least of them and its end list.
   End lists are put together as sorted blocks of ids in many tasks; only the running hash over a list is one stream.
3. The same sums over the first turns name the prefixes of the distinct sequences. Sequences that are a proper prefix
   of another go out by an anti-join; those left are the leaves.
4. Each prefix is given to the least sequence through it. A sequence then owns all nodes of its path from one depth
   on, so what a node's subtree saves is a sum over the sequences through the node, and no level is walked.

Every step is a join or an aggregation on a conversation and part, on a prefix or on a sequence, so neither a long
conversation nor a first turn that many share is ever in one task; common prefixes are added up before the shuffle.

Defined cases: rows without a conversation id belong to none and are left out; turns of one number (and repeated
rows, which all count) are in the order of their digests, a null number comes first; null roles and texts are empty;
a conversation without turns of its own left ends at the root; an empty table has no nodes, not even a root. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import fresh_path, materialize, scratch, written

NOT_SPACE = r"[^\x20\x09-\x0D]+"
_PLACE_BITS = 33
#: Ids of an end list in one row of its blocks.
END_IDS = 1_000
#: Parents with more children than this share of all lookups (and than ``HOT_ROWS``) are looked up by a broadcast.
HOT_SHARE = 10_000
HOT_ROWS = 1_000


class Turns(NamedTuple):
    """``rows``: ``(conv_id, part, place, digest, words)`` in order of ``place`` within a part; ``spans``:
    ``(conv_id, part, low, n, before)``, the least place and the turns of a part and how many come before it."""

    rows: DataFrame
    spans: DataFrame


class Trie(NamedTuple):
    """``nodes``, one row per prefix, and ``sequences``, the weighted distinct sequences ``(a, b, n, n_convs,
    conv_id, ends_sha256, leaf)``: their names, lengths, conversations and the least of these."""

    nodes: DataFrame
    sequences: DataFrame


def ordered_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Turns:
    """The turns of every conversation, digested and in order."""
    who, what = F.coalesce(rows[role].cast("string"), F.lit("")), F.coalesce(rows[text].cast("string"), F.lit(""))
    narrow = rows.filter(rows[conv_id].isNotNull()).select(
        rows[conv_id].cast("long").alias("conv_id"), rows[turn].alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what))).alias("digest"),
        F.regexp_count(what, F.lit(NOT_SPACE)).cast("int").alias("words"),
    )
    spark = rows.sparkSession
    # Ranges are drawn from a sample first, so the digests are worked out once and written. Equal rows are dealt by chance.
    narrow = materialize(narrow, "turns").withColumn("_salt", F.rand(11))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "digest", "_salt"]
    place = F.monotonically_increasing_id()
    placed = narrow.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("place", place)
    placed = materialize(
        placed.select("conv_id", F.shiftright("place", _PLACE_BITS).cast("int").alias("part"), "place", "digest", "words"), "ordered-turns"
    )
    # A row per conversation and range: few per conversation, whatever its length.
    spans = placed.groupBy("conv_id", "part").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return Turns(placed, materialize(spans, "spans"))


def plain(turns: Turns) -> DataFrame:
    """The plan of conversations as they are: nothing skipped, nothing put before. See :func:`rebuilt`."""
    none = F.array().cast("array<struct<digest: binary, words: int>>")
    return turns.spans.select("*", F.lit(0).alias("skip"), none.alias("head"))


def rebuilt(turns: Turns, group: int = 20, ways: int = 4) -> DataFrame:
    """``turns.spans`` with ``skip``, turns of its own that a conversation loses, and ``head``, those it gets instead.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % group`` for its own first ``h``, ``h`` being
    the CRC-32 of its number modulo ``ways``. A head has less than ``ways`` turns.
    """
    first = lambda table: table.filter(F.col("conv_id") % group == 0)
    place = (F.col("before") + F.col("place") - F.col("low")).alias("at")
    heads = first(turns.rows).join(first(turns.spans), ["conv_id", "part"]).select("conv_id", place, "digest", "words")
    heads = heads.filter(F.col("at") < ways - 1).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("turns")
    )
    heads = heads.select(F.col("conv_id").alias("_base"), F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("_turns"))
    skip = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % ways).cast("int")
    spans = turns.spans.withColumn("skip", skip).withColumn("_base", F.col("conv_id") - F.col("conv_id") % group)
    # A base has at most 2 * group conversations.
    head = F.coalesce(F.slice("_turns", F.lit(1), F.col("skip")), F.array().cast("array<struct<digest: binary, words: int>>"))
    return spans.join(heads, "_base", "left").withColumn("head", head).drop("_base", "_turns")


def _names(digest: Column, place: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its place."""
    return F.xxhash64(digest, place), F.xxhash64(place, digest)


def _head_sum(which: int, length: Column | None = None) -> Column:
    """The sum over the first turns of ``head`` of one of their names."""
    turns = F.col("head") if length is None else F.slice("head", F.lit(1), length)
    hashed = F.transform(turns, lambda t, i: _names(t["digest"], i.cast("long") + 1)[which])
    return F.aggregate(hashed, F.lit(0).cast("long"), lambda total, x: total.bitwiseXOR(x))


def _head_words(length: Column | None = None) -> Column:
    turns = F.col("head") if length is None else F.slice("head", F.lit(1), length)
    return F.aggregate(turns, F.lit(0).cast("long"), lambda total, t: total + t["words"])


def _own_turns(turns: Turns, plan: DataFrame) -> DataFrame:
    """``(conv_id, part, depth, x, y, words)``: the turns a conversation keeps, with their depth and names."""
    at = F.col("before") + F.col("place") - F.col("low")
    spans = plan.select("conv_id", "part", "low", "before", "skip", F.size("head").alias("_head"))
    kept = turns.rows.join(spans, ["conv_id", "part"]).filter(at >= F.col("skip"))
    kept = kept.withColumn("depth", (at - F.col("skip") + F.col("_head") + 1).cast("long"))
    x, y = _names(F.col("digest"), F.col("depth"))
    return kept.select("conv_id", "part", "depth", x.alias("x"), y.alias("y"), "words")


def _parts(own: DataFrame, plan: DataFrame) -> DataFrame:
    """For each part of a conversation the sums before it and those of the whole conversation: ``a``, ``b``, ``n`` and
    ``words``; ``first`` marks the part that has the head."""
    sums = own.groupBy("conv_id", "part").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("w"), F.count(F.lit(1)).alias("m")
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    known = plan.join(sums, ["conv_id", "part"], "left").select(
        "conv_id", "part", (F.col("before") == 0).alias("first"), "head", *[zero(name) for name in ("x", "y", "w", "m")]
    )
    every = Window.partitionBy("conv_id")
    earlier = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda total: F.coalesce(total.over(earlier), F.lit(0).cast("long"))
    return known.select(
        "conv_id", "part", "first", "head",
        before(F.bit_xor("x")).bitwiseXOR(_head_sum(0)).alias("a_before"), before(F.bit_xor("y")).bitwiseXOR(_head_sum(1)).alias("b_before"),
        (before(F.sum("w")) + _head_words()).alias("words_before"),
        F.bit_xor("x").over(every).bitwiseXOR(_head_sum(0)).alias("a"), F.bit_xor("y").over(every).bitwiseXOR(_head_sum(1)).alias("b"),
        (F.sum("m").over(every) + F.size("head")).alias("n"), (F.sum("w").over(every) + _head_words()).alias("words"),
    )


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns."""
    changed = np.ones(table.num_rows, dtype=bool)
    columns = [table.column(name).to_numpy(zero_copy_only=False) for name in names]
    changed[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return changed


def weighted_sequences(whole: DataFrame, ids: int = END_IDS) -> DataFrame:
    """``(a, b, n, words, n_convs, conv_id, ends_sha256)`` of the distinct sequences in ``(conv_id, a, b, n, words)``.

    Sorted ids are first put together in blocks of ``ids``, range by range, then a sequence's blocks pass one hash.
    """
    ranges = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["a", "b", "n", "conv_id"]
    in_order = whole.select("a", "b", "n", "words", "conv_id").repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def put_together(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            starts = np.flatnonzero(_changes(table, ["a", "b", "n"]))
            ends = np.append(starts[1:], table.num_rows)
            cuts = np.concatenate([np.arange(s, e, ids) for s, e in zip(starts, ends)])
            stops = np.append(cuts[1:], table.num_rows)
            numbers = table.column("conv_id").to_pylist()
            lists = [",".join(map(str, numbers[s:e])) for s, e in zip(cuts, stops)]
            heads = table.take(cuts)
            yield pa.RecordBatch.from_arrays(
                [heads.column(name).combine_chunks() for name in ("a", "b", "n", "words", "conv_id")]
                + [pa.array(stops - cuts, pa.int64()), pa.array(lists)],
                names=["a", "b", "n", "words", "conv_id", "n_convs", "ids"],
            )

    schema = "a bigint, b bigint, n bigint, words bigint, conv_id bigint"
    blocks = in_order.mapInArrow(put_together, f"{schema}, n_convs bigint, ids string")

    def hashed(batches):
        # The sequence whose blocks are being read: its row so far and its running hash.
        row, running = None, None
        for batch in batches:
            done = []
            for a, b, n, words, conv_id, n_convs, ids_ in zip(*[column.to_pylist() for column in batch.columns]):
                if row is not None and row[:3] == [a, b, n]:
                    running.update(b"," + ids_.encode())
                    row[5] += n_convs
                    continue
                if row is not None:
                    done.append([*row, running.hexdigest()])
                row, running = [a, b, n, words, conv_id, n_convs], hashlib.sha256(ids_.encode())
            yield _rows(done)
        if row is not None:
            yield _rows([[*row, running.hexdigest()]])

    ready = blocks.repartition("a", "b", "n").sortWithinPartitions(*order)
    return ready.mapInArrow(hashed, f"{schema}, n_convs bigint, ends_sha256 string")


def _rows(rows: list[list]) -> pa.RecordBatch:
    kinds = [*[("i", pa.int64())] * 6, ("s", pa.string())]
    names = ["a", "b", "n", "words", "conv_id", "n_convs", "ends_sha256"]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)], names=names)


def _paths(own: DataFrame, parts: DataFrame, sequences: DataFrame) -> DataFrame:
    """One row per prefix of a distinct sequence: ``(conv_id, part, n, depth, a, b, a_up, b_up, words, words_up)``.

    ``conv_id`` is the least conversation of the sequence, ``a_up`` and ``b_up`` name the prefix without its last
    turn, ``words`` and ``words_up`` are the words of both.
    """
    chosen = parts.drop("a", "b", "n", "words").join(sequences.select("conv_id", "n"), "conv_id")
    along = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    walked = own.join(chosen.drop("head", "first"), ["conv_id", "part"]).select(
        "conv_id", "part", "n", "depth", "x", "y", F.col("words").alias("w"),
        F.bit_xor("x").over(along).bitwiseXOR(F.col("a_before")).alias("a"),
        F.bit_xor("y").over(along).bitwiseXOR(F.col("b_before")).alias("b"),
        (F.sum("words").over(along) + F.col("words_before")).alias("words"),
    )
    walked = walked.select(
        "conv_id", "part", "n", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("a_up"),
        F.col("b").bitwiseXOR(F.col("y")).alias("b_up"), "words", (F.col("words") - F.col("w")).alias("words_up"),
    )
    depth = F.explode(F.sequence(F.lit(0), F.size("head")))
    tops = chosen.filter("first").select("conv_id", "part", "n", "head", depth.alias("_depth"))
    here, up = F.col("_depth"), F.greatest(F.col("_depth") - 1, F.lit(0))
    tops = tops.select(
        "conv_id", "part", "n", here.cast("long").alias("depth"), _head_sum(0, here).alias("a"), _head_sum(1, here).alias("b"),
        _head_sum(0, up).alias("a_up"), _head_sum(1, up).alias("b_up"), _head_words(here).alias("words"), _head_words(up).alias("words_up"),
    )
    return walked.unionByName(tops)


def _parents(entries: DataFrame, owners: DataFrame) -> DataFrame:
    """``(conv_id, parent)``: who owns the node above the first one that each sequence owns.

    ``entries`` has a row per sequence, so only a node at which many sequences part is hot: those are few by number,
    as each takes one ``HOT_SHARE``-th of all entries, and are broadcast; all others meet at most that many rows.
    """
    key = ["a", "b", "depth"]
    wanted = entries.filter("depth > 0").select("conv_id", F.col("a_up").alias("a"), F.col("b_up").alias("b"), (F.col("depth") - 1).alias("depth"))
    wanted = materialize(wanted, "entries")
    limit = max(HOT_ROWS, wanted.count() // HOT_SHARE)
    many = wanted.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    hot = materialize(many.join(owners, key).select(*key, "parent"), "hot-parents")
    # At most HOT_SHARE rows.
    near = wanted.join(F.broadcast(hot), key)
    rest = wanted.join(F.broadcast(hot.select(*key)), key, "left_anti").join(owners, key)
    return near.select("conv_id", "parent").unionByName(rest.select("conv_id", "parent"))


def build_trie(turns: Turns, plan: DataFrame) -> Trie:
    """The trie of the conversations that ``plan`` makes of ``turns`` (see :func:`rebuilt` and :func:`plain`).

    Nodes have ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.
    """
    plan = materialize(plan, "rebuilt")
    own = materialize(_own_turns(turns, plan), "own-turns")
    parts = materialize(_parts(own, plan), "parts")
    found = materialize(weighted_sequences(parts.filter("first").select("conv_id", "a", "b", "n", "words")), "weighted")
    paths = materialize(_paths(own, parts, found), "paths")
    # Of all sequences through a prefix the least owns it.
    prefixes = paths.groupBy("a", "b", "depth").agg(
        F.min("conv_id").alias("parent"), F.max("n").alias("longest"), F.first("a_up").alias("a_up"), F.first("b_up").alias("b_up"),
        F.first("words_up").alias("words_up"),
    )
    prefixes = materialize(prefixes, "prefixes")
    proper = prefixes.filter("longest > depth").select("a", "b", F.col("depth").alias("n"))
    leaves = found.join(proper, ["a", "b", "n"], "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    entry = F.min(F.struct("depth", "a_up", "b_up", "words_up")).alias("entry")
    entries = prefixes.groupBy(F.col("parent").alias("conv_id")).agg(entry).select("conv_id", "entry.*")
    entries = materialize(entries, "first-owned")
    parents = _parents(entries, prefixes.select("a", "b", "depth", "parent"))
    # A sequence that is a proper prefix of a lesser one owns nothing: it begins to own after its end.
    entries = entries.select("conv_id", F.col("depth").alias("_entry"), F.col("words_up").alias("_entry_words"))
    sequences = found.join(leaves, "conv_id", "left").join(parents, "conv_id", "left").join(entries, "conv_id", "left").select(
        "a", "b", "n", "n_convs", "conv_id", "ends_sha256", F.coalesce("leaf", F.lit(0)).alias("leaf"), "words",
        F.coalesce("_entry", F.col("n") + 1).alias("entry"), F.coalesce("_entry_words", "words").alias("entry_words"), "parent",
    )
    sequences = materialize(sequences, "sequences")
    # A row of facts for every part, so that the rows of a long sequence meet them in several tasks.
    facts = parts.select("conv_id", "part").join(sequences.drop("a", "b", "n"), "conv_id")
    facts = materialize(facts.withColumnRenamed("words", "all_words"), "sequence-parts")
    nodes = _summed(paths.join(facts, ["conv_id", "part"]))
    return Trie(nodes, sequences.select("a", "b", "n", "n_convs", "conv_id", "ends_sha256", "leaf"))


def _summed(through: DataFrame) -> DataFrame:
    """Nodes from the rows of the sequences through them.

    A sequence owns the nodes of its path from ``entry`` on. Below a node it adds its weight times the words of its
    turns, less one count of the words of those turns whose nodes it owns.
    """
    depth, owned = F.col("depth"), F.col("depth") >= F.col("entry")
    below = F.col("all_words") - F.col("words_up")
    own_below = F.col("all_words") - F.when(owned, F.col("words_up")).otherwise(F.col("entry_words"))
    child = (depth < F.col("n")) & (depth + 1 >= F.col("entry"))
    above = F.when(depth == F.col("entry"), F.col("parent")).otherwise(F.col("conv_id"))
    parent = F.when(owned & (depth > 0), above)
    summed = through.groupBy("a", "b", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max(parent).alias("parent_conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum(child.cast("long")).alias("n_children"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
        F.sum(F.col("n_convs") * below - own_below).alias("saved_tokens"),
        F.max(F.when(depth == F.col("n"), F.col("ends_sha256"))).alias("ends"),
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return summed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, group: int = 20, ways: int = 4) -> DataFrame:
    """The nodes of the trie of all conversations, each rebuilt on the first of its group; only they stay written."""
    path = fresh_path(conversations.sparkSession, "trie")
    with scratch(conversations.sparkSession):
        turns = ordered_turns(conversations)
        return written(build_trie(turns, rebuilt(turns, group, ways)).nodes, path)
