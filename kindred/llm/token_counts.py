"""Token counts of the parts of a document, from one encoding of the whole document.

Tokens are encoded once per document, with their byte spans. Each part (a field or a section) has a byte
span too, and an interval join gives every token to the part that holds it. A token that crosses from one
part into another belongs to one of them by an explicit rule:

- ``first``: the part that holds its first byte,
- ``last``: the part that holds its last byte,
- ``most``: the part that holds most of its bytes, the earlier one among equals.

So the counts of the parts add up to the count of the document. The parts of a document lie next to each
other and cover it, so the join is a sorted lookup inside the task that has the document: nothing is shuffled.

Defined cases: a null text is one empty section without tokens, as is an empty one; an empty part has no
tokens; repeated rows are each counted; an empty table gives an empty result. Columns that are not named
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.bpe import Codec, Vocabulary
from kindred.llm.lexicon_bpe import BETWEEN, CUT, PATTERN, Cut, Merger, Rules, class_table, cut_words, spread
from kindred.llm.texts import blocks

RULES = ("first", "last", "most")


class _Lengths:
    """The byte lengths of the tokens of pre-tokens; those of a block are merged together."""

    def __init__(self, codec: Codec):
        self.codec, self.classes = codec, class_table()
        ranks = codec.ranks
        # Two neighbours join where their bytes are a token; its rank says how soon.
        pairs = {
            ranks[token[:i]] << 32 | ranks[token[i:]]: (rank, rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        }
        bytes_of = [b""] * (max(ranks.values(), default=0) + 1)
        for token, rank in ranks.items():
            bytes_of[rank] = token
        self.merger = Merger(Rules(bytes_of, codec.of_byte, pairs, {}))
        self.sizes = np.array([len(token) for token in bytes_of], np.int64)
        self.whole = pa.array(list(ranks), pa.binary())

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens each word has, and the lengths of all of them in order."""
        # A pre-token that is a token stays whole, whatever its pairs.
        whole = pc.is_in(words, value_set=self.whole).to_numpy(zero_copy_only=False)
        counts = np.ones(len(words), np.int64)
        counts[~whole], ids = self.merger.merged(words.filter(pa.array(~whole)).to_pylist())
        begin, flat = np.cumsum(counts) - counts, np.empty(int(counts.sum()), np.int64)
        flat[begin[whole]] = pc.binary_length(words).to_numpy()[whole]
        flat[spread(begin[~whole], counts[~whole])] = self.sizes[ids]
        return counts, flat


#: Those that this worker used last.
_LENGTHS: dict[str, _Lengths] = {}


def _lengths(vocabulary: Vocabulary) -> _Lengths:
    if vocabulary.name not in _LENGTHS:
        _LENGTHS.clear()
        _LENGTHS[vocabulary.name] = _Lengths(vocabulary.codec())
    return _LENGTHS[vocabulary.name]


def _cut(lengths: _Lengths, texts: list[str]) -> Cut:
    """The pre-tokens of texts: by classes of code points where the pattern is the one those stand for."""
    if lengths.codec.pattern.pattern == PATTERN:
        return cut_words(texts, lengths.classes)
    pieces = [lengths.codec.pieces(text) for text in texts]
    coded = pa.array([piece.encode() for part in pieces for piece in part], pa.binary()).dictionary_encode()
    return Cut(coded.dictionary, coded.indices.to_numpy(), np.cumsum([0, *map(len, pieces)]))


def _parts(text: str) -> Iterator[str]:
    """A long text cut at blanks between words, which no pre-token spans."""
    while len(text) > CUT and (blank := BETWEEN.search(text, CUT)):
        yield text[: blank.start()]
        text = text[blank.start() :]
    yield text


def token_ends(lengths: _Lengths, texts: list[str]) -> list[np.ndarray]:
    """For each text the byte at which each of its tokens ends, in order."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    group: list[tuple[int, str]] = []
    by_pattern = lengths.codec.pattern.pattern != PATTERN

    def finish() -> None:
        cut = _cut(lengths, [part for _, part in group])
        counts, flat = lengths.of(cut.words)
        own = counts[cut.codes]
        sizes = flat[spread((np.cumsum(counts) - counts)[cut.codes], own)]
        first = np.concatenate([[0], np.cumsum(own)])[cut.first]
        for (number, _), begin, end in zip(group, first[:-1], first[1:]):
            found[number].append(sizes[begin:end])
        group.clear()

    held = 0
    for number, text in enumerate(texts):
        for part in [text] if by_pattern else _parts(text):
            group.append((number, part))
            held += len(part)
            if held >= 2 * CUT:
                finish()
                held = 0
    if group:
        finish()
    return [np.cumsum(np.concatenate(parts)) if parts else np.zeros(0, np.int64) for parts in found]


def allocate(ends: np.ndarray, part_ends: np.ndarray, rule: str) -> np.ndarray:
    """The part of each token; parts follow each other and end at ``part_ends`` (the last with the text)."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(part_ends, starts, side="right")
    if rule == "first":
        return first
    last = np.searchsorted(part_ends, ends - 1, side="right")
    if rule == "last":
        return last
    owner = first.copy()
    for i in np.flatnonzero(first != last):
        parts = np.arange(first[i], last[i] + 1)
        begins = np.concatenate([[0], part_ends])[parts]
        shares = np.minimum(part_ends[parts], ends[i]) - np.maximum(begins, starts[i])
        owner[i] = parts[np.argmax(shares)]
    return owner


def count_by_part(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, parts: str, rule: str = "most") -> DataFrame:
    """Tokens of each part of a document whose parts are an array of texts in the column ``parts``.

    The document is its parts put together. Gives ``keep`` and, per part, its place ``part`` (from 0), its
    byte span ``start``/``end``, ``n_tokens``, and ``n_crossing``: how many of those cross a boundary.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    filled = F.when(F.size(parts) > 0, F.transform(parts, lambda part: F.coalesce(part, F.lit("")))).otherwise(F.array(F.lit("")))
    listed = docs.select(*keep, filled.alias("_parts"))
    whole = listed.select(
        *keep, F.array_join("_parts", "").alias("_text"), F.transform("_parts", F.octet_length).alias("_sizes")
    )
    return _counted(whole, keep, vocabulary, rule, lambda block, texts: [np.cumsum(x, dtype=np.int64) for x in block.column("_sizes").to_pylist()])


def count_by_section(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, text: str = "text", rule: str = "most") -> DataFrame:
    """The same for the sections of a text (see :func:`sections`), which are found beside the tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def line_ends(block, texts: list[str]) -> list[np.ndarray]:
        raw = [np.frombuffer(one.encode(), np.uint8) for one in texts]
        return [np.append(np.flatnonzero(one == 10) + 1, len(one)) for one in raw]

    whole = docs.select(*keep, F.coalesce(docs[text], F.lit("")).alias("_text"))
    return _counted(whole, keep, vocabulary, rule, line_ends)


def _counted(whole: DataFrame, keep: list[str], vocabulary: Vocabulary, rule: str, part_ends_of) -> DataFrame:
    """Counts by part of ``_text``; ``part_ends_of`` gives for a block and its texts where the parts of each end."""
    fields = StructType.fromDDL(
        "n_document_tokens bigint, parts array<struct<part: bigint, start: bigint, end: bigint, n_tokens: bigint, n_crossing: bigint>>"
    )
    schema = StructType([whole.schema[name] for name in keep] + fields.fields)
    arrow = pa.list_(pa.struct([(n, pa.int64()) for n in ("part", "start", "end", "n_tokens", "n_crossing")]))

    def run(batches):
        lengths = _lengths(vocabulary)
        for block in blocks(batches, "_text"):
            totals, found = [], []
            texts = block.column("_text").to_pylist()
            for ends, part_ends in zip(token_ends(lengths, texts), part_ends_of(block, texts)):
                owner = allocate(ends, part_ends, rule)
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crossing = np.searchsorted(part_ends, starts, "right") != np.searchsorted(part_ends, ends - 1, "right")
                counts = np.bincount(owner, minlength=len(part_ends))
                crossed = np.bincount(owner[crossing], minlength=len(part_ends))
                begins = np.concatenate([[0], part_ends[:-1]])
                totals.append(len(ends))
                found.append(np.stack([np.arange(len(part_ends)), begins, part_ends, counts, crossed], axis=1))
            rows = np.concatenate(found).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(rows[:, i].copy()) for i in range(5)], fields=list(arrow.value_type))
            columns = [block.column(name) for name in keep]
            columns += [pa.array(totals, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), structs)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return whole.mapInArrow(run, schema).select(*keep, "n_document_tokens", F.inline("parts"))


def sections(text: str = "text"):
    """A text as its sections: lines, each with the newline that ends it."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    return F.transform(
        lines, lambda line, i: F.when(i < F.size(lines) - 1, F.concat(line, F.lit("\n"))).otherwise(line)
    )


def count_by_field(rows: DataFrame, key: list[str], order: str, text: str, vocabulary: Vocabulary, rule: str = "most",
                   separator: str = "\n") -> DataFrame:
    """Tokens of rows that together are one document, such as the turns of a conversation.

    The rows of a key, in order, are joined by a separator that belongs to the row before it. A document
    is one row of the result's input, so it has to fit a task.
    """
    entry = F.struct(order, F.coalesce(F.col(text), F.lit("")).alias("value"))
    grouped = rows.groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    texts = F.transform(
        "_rows",
        lambda row, i: F.when(i < F.size("_rows") - 1, F.concat(row["value"], F.lit(separator))).otherwise(row["value"]),
    )
    counted = count_by_part(grouped.select(*key, texts.alias("_turns")), key, vocabulary, "_turns", rule)
    return counted
