"""A minimal acyclic transducer from words to lists of numbers, in one file that workers map into memory.

The words are compiled into the least automaton that accepts them: states from which the same endings follow are one,
so endings are shared as beginnings are. Every edge has an output, the number of words that come before those that go
on through it, so the outputs along a word add up to the word's number in sorted order. By that number its list of
ids is found in a flat array.

Construction goes by arrays, not by words: common prefixes of neighbours in sorted order give the tree, then the
nodes of each height, from the leaves up, are one state where finality, labels and targets are equal.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_MAGIC = b"lexicon1"
_KINDS = {"keys": np.int64, "targets": np.int32, "outputs": np.int32, "final": np.uint8, "offsets": np.int32, "ids": np.int32}


class Lexicon(NamedTuple):
    """``keys`` of the edges (``state * 256 + byte``, ascending) with their ``targets`` and ``outputs``; ``final``
    states; the ids of word ``i`` are ``ids[offsets[i]:offsets[i + 1]]``. State 0 is the start."""

    keys: np.ndarray
    targets: np.ndarray
    outputs: np.ndarray
    final: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray

    @property
    def words(self) -> int:
        return len(self.offsets) - 1


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values and where each begins."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _tree(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tree of sorted distinct words: parent, label and depth of every node, and the node of each word."""
    width = max(map(len, words), default=0)
    table = np.zeros((len(words), width), np.uint8)
    sizes = np.array([len(word) for word in words], np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(len(words)), sizes)
    table[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    # A node at a depth is new where a word has it and differs up to there from the word before.
    same = np.ones(len(words), bool)
    same[:1] = False
    above = np.zeros(len(words), np.int64)
    parents, labels, depths, made = [np.array([-1])], [np.zeros(1, np.uint8)], [np.zeros(1, np.int64)], 1
    ends = np.zeros(len(words), np.int64)
    for depth in range(width):
        has = sizes > depth
        same[1:] &= (table[1:, depth] == table[:-1, depth]) & (sizes[:-1] > depth)
        new = has & ~same
        numbers = made + np.cumsum(new) - 1
        parents.append(above[new])
        labels.append(table[new, depth])
        depths.append(np.full(int(new.sum()), depth + 1))
        made += int(new.sum())
        above = np.where(has, numbers, above)
        ends[sizes == depth + 1] = above[sizes == depth + 1]
    return np.concatenate(parents), np.concatenate(labels), np.concatenate(depths), ends


def _heights(parents: np.ndarray, depths: np.ndarray) -> np.ndarray:
    height = np.zeros(len(parents), np.int64)
    for depth in range(int(depths.max(initial=0)), 0, -1):
        level = np.flatnonzero(depths == depth)
        np.maximum.at(height, parents[level], height[level] + 1)
    return height


def _classes(rows: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """A number for each distinct row of numbers of unequal lengths; ``rows`` is their flat content and its owners."""
    flat, owner = rows
    width = int(lengths.max(initial=0))
    table = np.full((len(lengths), width + 1), -1, np.int64)
    table[:, 0] = lengths
    starts = np.cumsum(lengths) - lengths
    table[owner, 1 + np.arange(len(flat)) - starts[owner]] = flat
    return np.unique(table, axis=0, return_inverse=True)[1].reshape(-1)


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> Lexicon:
    """The transducer of distinct words and their ids; the empty word is not allowed."""
    if any(not word for word in words) or len(set(words)) < len(words):
        raise ValueError("words must be distinct and not empty")
    order = sorted(range(len(words)), key=words.__getitem__)
    words = [words[i] for i in order]
    lists = [ids[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat_ids = np.array([i for x in lists for i in x], np.int32)

    parents, labels, depths, ends = _tree(words)
    final = np.zeros(len(parents), bool)
    final[ends] = True
    state = np.full(len(parents), -1, np.int64)
    heights = _heights(parents, depths)
    children = np.argsort(parents[1:] * 256 + labels[1:], kind="stable") + 1
    first = np.searchsorted(parents[children], np.arange(len(parents) + 1))
    below = np.zeros(len(parents), np.int64)  # words from a node on
    made, edges = 0, []
    for height in range(int(heights.max(initial=0)) + 1):
        nodes = np.flatnonzero(heights == height)
        spans = first[nodes + 1] - first[nodes]
        owner = np.repeat(np.arange(len(nodes)), spans)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
        own = children[first[nodes][owner] + within]
        below[nodes] = final[nodes] + np.bincount(owner, weights=below[own], minlength=len(nodes)).astype(np.int64)
        # Wide and narrow nodes apart, so that no table is as wide as the widest node for all of them.
        group = np.zeros(len(nodes), np.int64)
        for wide in np.unique(np.ceil(np.log2(spans + 1)).astype(int)):
            some = np.flatnonzero(np.ceil(np.log2(spans + 1)).astype(int) == wide)
            chosen = np.isin(owner, some)
            place = np.searchsorted(some, owner[chosen])
            code = state[own[chosen]] * 256 + labels[own[chosen]]
            flat = np.concatenate([final[nodes[some]].astype(np.int64), code])
            holder = np.concatenate([np.arange(len(some)), place])
            by_holder = np.argsort(holder, kind="stable")
            found = _classes((flat[by_holder], holder[by_holder]), spans[some] + 1)
            group[some] = found + group.max(initial=-1) + 1 if wide else found
        kinds, example, back = np.unique(group, return_index=True, return_inverse=True)
        state[nodes] = made + back.reshape(-1)
        for_edges = np.isin(owner, example)
        edges.append((state[nodes[owner[for_edges]]], own[for_edges]))
        made += len(kinds)
    # The root is the only node of its height; its state becomes 0.
    source = np.concatenate([e[0] for e in edges])
    target_node = np.concatenate([e[1] for e in edges])
    number = lambda s: made - 1 - s
    final_state = np.zeros(made, np.uint8)
    final_state[number(state)] = final
    keys = number(source) * 256 + labels[target_node]
    by_key = np.argsort(keys, kind="stable")
    keys, target_node, source = keys[by_key], target_node[by_key], number(source)[by_key]
    # What comes before: the word that ends in the state itself, and all words through smaller labels.
    passing = below[target_node]
    total = np.cumsum(passing) - passing
    head = np.searchsorted(source, source, side="left")
    outputs = final_state[source] + total - total[head]
    return Lexicon(keys, number(state[target_node]).astype(np.int32), outputs.astype(np.int32), final_state, offsets, flat_ids)


def word_numbers(lexicon: Lexicon, words: pa.Array) -> np.ndarray:
    """The number of each binary value in the lexicon, -1 if it has none; all values go a byte at a time together."""
    data, offsets = _bytes_of(words)
    found = np.full(len(words), -1, np.int64)
    if not len(lexicon.keys):
        return found
    sizes = np.diff(offsets)
    live = np.flatnonzero(sizes > 0)
    state, total, depth = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), 0
    while len(live):
        wanted = state * 256 + data[offsets[live] + depth]
        at = np.minimum(np.searchsorted(lexicon.keys, wanted), len(lexicon.keys) - 1)
        there = lexicon.keys[at] == wanted
        live, at = live[there], at[there]
        total = total[there] + lexicon.outputs[at]
        state = lexicon.targets[at].astype(np.int64)
        depth += 1
        done = sizes[live] == depth
        accepted = done & (lexicon.final[state] > 0)
        found[live[accepted]] = total[accepted]
        live, state, total = live[~done], state[~done], total[~done]
    return found


def to_bytes(lexicon: Lexicon) -> bytes:
    """One file: a header with the length of each array, then the arrays, each on an 8-byte boundary."""
    parts = [_MAGIC, struct.pack(f"<{len(_KINDS)}q", *[len(array) for array in lexicon])]
    for array, kind in zip(lexicon, _KINDS.values()):
        raw = np.ascontiguousarray(array, dtype=kind).tobytes()
        parts += [raw, b"\0" * (-len(raw) % 8)]
    return b"".join(parts)


def open_mapped(path: str) -> Lexicon:
    """A lexicon whose arrays lie in the mapped file, so that all workers of a machine share its pages."""
    raw = np.memmap(path, dtype=np.uint8, mode="r")
    if raw[:8].tobytes() != _MAGIC:
        raise ValueError(f"{path} is no lexicon")
    lengths = struct.unpack(f"<{len(_KINDS)}q", raw[8 : 8 + 8 * len(_KINDS)].tobytes())
    arrays, at = [], 8 + 8 * len(_KINDS)
    for length, kind in zip(lengths, _KINDS.values()):
        size = length * np.dtype(kind).itemsize
        arrays.append(raw[at : at + size].view(kind))
        at += size + -size % 8
    return Lexicon(*arrays)
