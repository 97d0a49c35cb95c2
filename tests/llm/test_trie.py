"""The conversation prefix trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from kindred.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, part string, depth string, a string, words string"


def in_order(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv_id].append((turn is not None, turn or 0, digest, role, text))
    return {conv_id: [row[3:] for row in sorted(own)] for conv_id, own in turns.items()}


def rebuilt(turns):
    for conv_id, own in turns.items():
        h = zlib.crc32(str(conv_id).encode()) % 4
        yield conv_id, turns.get(conv_id - int(math.fmod(conv_id, 20)), [])[:h] + own[h:]


def brute(sequences):
    members, children = defaultdict(list), defaultdict(list)
    for conv_id, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def saved(node):
        return (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0

    leaves, savings = defaultdict(int), defaultdict(int)
    for node in members:
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            savings[node[:depth]] += saved(node)
    rows = []
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(i for i in ids if len(sequences[i]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(ids), len(node), parent, len(ids), len(children[node]), leaves[node], savings[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def nodes(table):
    return sorted((tuple(row) for row in table.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    """Null and equal turns, nulls in every column, negative ids, shared first turns, one very long conversation."""
    draw = random.Random(5)
    rows = [
        (conv_id, draw.choice([None, turn, turn, 1]), draw.choice(["user", "a", None]), draw.choice(["x", "y z", "", None]))
        for conv_id in [*range(-45, 90), 10**12]
        for turn in range(draw.randint(0, 6))
    ]
    rows += [(100, i, "u", f"word {i % 3}") for i in range(500)] + [(100, 7, "u", "word 1")]
    return rows + [(None, 1, "u", "x"), (None, None, None, None), (121, 0, "u", "y " * 200_000)]


@pytest.fixture(scope="module")
def odd_table(spark, odd_rows):
    return spark.createDataFrame([(*row, "p", "d", "a", "w") for row in odd_rows], SCHEMA).repartition(5)


def test_rebuilt_conversations_of_odd_turns(odd_rows, odd_table, monkeypatch):
    # Hot parents are looked up apart, and end lists have several blocks.
    monkeypatch.setattr(prefix_trie, "HOT_ROWS", 2)
    monkeypatch.setattr(prefix_trie.weighted_sequences, "__defaults__", (3,))
    assert nodes(prefix_trie.prefix_trie(odd_table)) == brute(dict(rebuilt(in_order(odd_rows))))


def test_conversations_as_they_are(spark, odd_rows, odd_table):
    turns = prefix_trie.ordered_turns(odd_table)
    # The long conversation is in several ranges.
    assert turns.spans.filter("conv_id = 100").count() > 1
    trie = prefix_trie.build_trie(turns, prefix_trie.plain(turns))
    sequences = in_order(odd_rows)
    assert nodes(trie.nodes) == brute(sequences)
    # Distinct sequences stand for all conversations, and leaves are those that no other goes on from.
    weighted = trie.sequences.collect()
    assert sum(row["n_convs"] for row in weighted) == len(sequences)
    distinct = {tuple(turns) for turns in sequences.values()}
    assert len(weighted) == len(distinct)
    inner = {turns[:depth] for turns in distinct for depth in range(len(turns))}
    assert sum(row["leaf"] for row in weighted) == len(distinct - inner)


def test_one_sequence_of_many_conversations(spark):
    rows = [(i, t, "u", "hello there") for i in range(3_000) for t in range(2)]
    found = nodes(prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert found == brute(dict(rebuilt(in_order(rows))))


def test_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert nodes(prefix_trie.prefix_trie(table)) == []
    table = spark.createDataFrame([(None, 1, "u", "x")], "conv_id long, turn long, role string, text string")
    assert nodes(prefix_trie.prefix_trie(table)) == []
