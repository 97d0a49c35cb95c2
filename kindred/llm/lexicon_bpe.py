"""BPE encoding and decoding with a minimal acyclic transducer as lexicon of the frequent words.

1. All texts are cut into words (pre-tokens) and the words counted, added up in the tasks first. The most frequent
   ones, ``LEXICON_WORDS`` at most, are merged once and compiled into a transducer (:mod:`kindred.llm.transducer`).
   It is one file in the shared folder, which Spark hands to every machine and workers map into memory.
2. A block of texts is cut into words, its distinct words are looked up in the transducer together, and those that it
   does not have are merged by the vocabulary's merge list, so the result does not depend on what the lexicon holds.
3. Tokens of a text are those of its words. Decoding puts their bytes together; bytes that are no UTF-8 become the
   replacement character.

Words are cut without a pattern, from the classes of code points: runs of letters, of numbers and of other marks, each
with a blank before it; the English endings after an apostrophe; and white space, whose last character is on its own
if a word follows. Strings of added tokens in a text become those tokens, and cut it. Long texts are cut at blanks
between words, where no word can span, so a task holds a block's worth of words, and a text with its result.

Defined cases: a null text is empty and has no tokens; repeated rows each have a result row; an empty table gives an
empty result. Columns of ``docs`` that are not named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm import transducer
from kindred.llm.texts import blocks, map_blocks
from kindred.session import fresh_path, materialize

#: Words in the lexicon at most, and the bytes of each at most.
LEXICON_WORDS = 2**17
LEXICON_BYTES = 48
#: Distinct words that a task counts before it gives its counts on.
COUNTED_WORDS = 400_000
#: Words up to these many bytes are merged together, longer ones one by one.
TOGETHER = (6, 9, 12, 16, 24, 32, 64)
#: Characters after which a long text is cut at the next blank between words.
CUT = 500_000

# Fixed value: the pattern whose pieces are the words here, as tokenizer files write it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = range(4)
BETWEEN = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others
    for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Rules(NamedTuple):
    """``bytes_of`` each id, the id ``of_byte``, ``merges`` (two ids as one number to rank and id), ``added`` tokens."""

    bytes_of: list[bytes]
    of_byte: list[int]
    merges: dict[int, tuple[int, int]]
    added: dict[str, int]


def load_rules(path: str) -> Rules:
    """The rules in a tokenizer file of the kind byte-level BPE without normalisation and other options."""
    with open(path, encoding="utf-8") as file:
        loaded = json.load(file)
    model, cut = loaded["model"], loaded["pre_tokenizer"]
    plain = model["type"] == "BPE" and cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True)
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if not plain or loaded["normalizer"] or any(model.get(name) for name in options):
        raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
    if any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in loaded["added_tokens"]):
        raise ValueError("added tokens must be matched as they are")
    byte_of, ids = byte_characters(), dict(model["vocab"])
    added = {token["content"]: token["id"] for token in loaded["added_tokens"]}
    bytes_of = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for token, number in ids.items():
        bytes_of[number] = bytes(byte_of[c] for c in token)
    for token, number in added.items():
        bytes_of[number] = token.encode()
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.setdefault(ids[left] << 32 | ids[right], (rank, ids[left + right]))
    of_byte = [0] * 256
    for character, byte in byte_of.items():
        of_byte[byte] = ids[character]
    return Rules(bytes_of, of_byte, merges, added)


def merge(rules: Rules, word: bytes) -> list[int]:
    """Join the pair of neighbours that comes first in the merge list, the leftmost of equal ones, until none is in it."""
    if len(word) > 200:
        return _merge_long(rules, word)
    never = (1 << 62, 0)
    get = rules.merges.get
    ids = [rules.of_byte[b] for b in word]
    pairs = [get(a << 32 | b, never) for a, b in zip(ids, ids[1:])]
    while pairs:
        best = min(pairs)
        if best is never:
            break
        i, joined = pairs.index(best), best[1]
        ids[i] = joined
        del ids[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(joined << 32 | ids[i + 1], never)
        if i:
            pairs[i - 1] = get(ids[i - 1] << 32 | joined, never)
    return ids


class Merger:
    """Merges of many words at once: in each round every word joins its first pair."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.of_byte = np.array(rules.of_byte, np.int32)
        self.keys = np.array(sorted(rules.merges), np.int64)
        found = [rules.merges[key] for key in self.keys.tolist()]
        self.ranks = np.array([rank for rank, _ in found], np.int32)
        self.never = max(self.ranks.tolist(), default=0) + 1
        self.joined = np.zeros(self.never, np.int32)
        self.joined[self.ranks] = [joined for _, joined in found]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place in the merge list of pairs of ids, ``never`` if there is none or an id is -1 (no token)."""
        if not len(self.keys):
            return np.full(left.shape, self.never, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (right >= 0), self.ranks[at], np.int32(self.never))

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, as :func:`merge` gives them."""
        counts, flat = self.merged(words)
        ends, ids = np.cumsum(counts).tolist(), flat.tolist()
        return [ids[begin:end] for begin, end in zip([0, *ends], ends)]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all of them in order."""
        sizes = np.array([len(word) for word in words], np.int64)
        counts, parts, low = np.zeros(len(words), np.int64), [], 0
        for high in TOGETHER:
            some = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(some):
                table = self._together([words[i] for i in some], sizes[some])
                counts[some] = (table >= 0).sum(axis=1)
                parts.append((some, table[table >= 0]))
        for i in np.flatnonzero(sizes > low):
            ids = merge(self.rules, words[i])
            counts[i] = len(ids)
            parts.append((np.array([i]), np.array(ids, np.int32)))
        flat, begin = np.empty(int(counts.sum()), np.int32), np.cumsum(counts) - counts
        for some, ids in parts:
            flat[spread(begin[some], counts[some])] = ids
        return counts, flat

    def _together(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """A row of ids for each word, with -1 behind them."""
        width = int(sizes.max())
        ids = np.full((len(words), width + 1), -1, np.int32)
        flat = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        ids[np.repeat(np.arange(len(words)), sizes), spread(np.zeros(len(words), np.int64), sizes)] = flat
        result, live = ids, np.arange(len(words))
        work, ranks = ids.copy(), self.rank(ids[:, :-1], ids[:, 1:])
        steps = np.arange(width)
        while len(live):
            first = ranks.argmin(axis=1)
            rows = np.arange(len(live))
            best = ranks[rows, first]
            going = best < self.never
            if not going.all():
                result[live[~going]] = work[~going]
                live, work, ranks, first, best = live[going], work[going], ranks[going], first[going], best[going]
                rows = np.arange(len(live))
                if not len(live):
                    break
            joined = self.joined[best]
            # Ids behind the pair move up by one, and so do the ranks behind that of the pair.
            behind = steps[None, :] > first[:, None]
            work[:, :-1] = np.where(behind, work[:, 1:], work[:, :-1])
            work[:, -1] = -1
            work[rows, first] = joined
            here = steps[None, :-1] >= first[:, None]
            ranks[:, :-1] = np.where(here, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = self.never
            ranks[rows, first] = self.rank(joined, work[rows, first + 1])
            left = np.flatnonzero(first > 0)
            ranks[left, first[left] - 1] = self.rank(work[left, first[left] - 1], joined[left])
        return result


def _merge_long(rules: Rules, word: bytes) -> list[int]:
    """The same with a queue of pairs, for words whose pairs are too many to look through each time."""
    ids, n = [rules.of_byte[b] for b in word], len(word)
    after, before, get = [*range(1, n + 1)], [*range(-1, n - 1)], rules.merges.get
    queue = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := get(ids[i] << 32 | ids[i + 1]))]
    queue = [(rank, i, joined, left, right) for rank, joined, i, left, right in queue]
    heapq.heapify(queue)
    while queue:
        _, i, joined, left, right = heapq.heappop(queue)
        j = after[i]
        # The pair may be gone: joined to others since.
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i], ids[j], after[i] = joined, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            if found := get(joined << 32 | ids[after[i]]):
                heapq.heappush(queue, (found[0], i, found[1], joined, ids[after[i]]))
        if before[i] >= 0 and (found := get(ids[before[i]] << 32 | joined)):
            heapq.heappush(queue, (found[0], before[i], found[1], ids[before[i]], joined))
    return [x for x in ids if x >= 0]


def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, everything):
            begin, end = run.span()
            shift = lambda at: at if at < 0xD800 else at + 0x800
            table[shift(begin) : shift(end - 1) + 1] = kind
    table[0xD800:0xE000] = OTHER
    return table


def word_starts(codes: np.ndarray, texts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where words begin among code points; ``texts`` are the places at which texts begin, which no word spans."""
    n = len(codes)
    kinds = classes[codes]
    opens = np.zeros(n + 1, bool)
    opens[texts[texts < n]] = True
    opens[n] = True
    fresh = opens[:-1]
    run = fresh.copy()
    run[1:] |= kinds[1:] != kinds[:-1]
    starts = run.copy()
    # White space before a word: a last blank belongs to the word, any other last character is by itself.
    words = np.flatnonzero(run & (kinds != SPACE) & ~fresh)
    words = words[words > 0]
    words = words[kinds[words - 1] == SPACE]
    starts[words - 1] = True
    starts[words[codes[words - 1] == 0x20]] = False
    # An apostrophe by itself right before letters takes an English ending with it.
    marks = np.flatnonzero(starts[:-1] & (codes[:-1] == 0x27) & (kinds[1:] == LETTER) & ~opens[1:-1]) if n > 1 else np.zeros(0, int)
    if len(marks):
        padded = np.concatenate([codes, [0, 0]])
        inside = np.concatenate([~opens[:-1], [False, False]])
        one, two, joined = padded[marks + 1], padded[marks + 2], inside[marks + 2]
        pairs = np.isin(one.astype(np.int64) << 21 | two, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")]) & joined
        length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pairs, 2, 0))
        marks, length = marks[length > 0], length[length > 0]
        starts[marks + 1] = False
        behind = marks + 1 + length
        starts[behind[behind < n]] = True
    return np.flatnonzero(starts)


class Cut(NamedTuple):
    """The words of some texts: distinct ``words``, ``codes`` that name them in order, and ``first``, where the words
    of each text begin in ``codes``."""

    words: pa.Array
    codes: np.ndarray
    first: np.ndarray


def cut_words(texts: list[str], classes: np.ndarray) -> Cut:
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
    starts = word_starts(codes, begins, classes)
    sizes = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    offsets = np.append(at[starts], at[-1]).astype(np.int32)
    data = "".join(texts).encode()
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    return Cut(coded.dictionary, coded.indices.to_numpy(), np.searchsorted(starts, begins))


class Encoder:
    """What a worker needs: the rules, the lexicon and the classes."""

    def __init__(self, rules: Rules, lexicon: transducer.Lexicon):
        self.rules, self.lexicon, self.classes = rules, lexicon, class_table()
        self.merger = Merger(rules)
        self.token_bytes = pa.array(rules.bytes_of, pa.binary())
        self.token_text = pa.array([str(i).encode() for i in range(len(rules.bytes_of))], pa.binary())
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(rules.added, key=len, reverse=True))) + ")") if rules.added else None

    def parts(self, text: str):
        """``(part, id)``: stretches to be cut into words (then without an id), and added tokens."""
        for i, piece in enumerate(self.added.split(text) if self.added else [text]):
            if i % 2:
                yield piece, self.rules.added[piece]
                continue
            while len(piece) > CUT:
                blank = BETWEEN.search(piece, CUT)
                if blank is None:
                    break
                yield piece[: blank.start()], None
                piece = piece[blank.start() :]
            if piece:
                yield piece, None

    def tokens(self, words: pa.Array) -> pa.ListArray:
        """The ids of each word: from the lexicon, else by merging."""
        numbers = transducer.word_numbers(self.lexicon, words)
        known = numbers >= 0
        lists = self.merger.merge(words.filter(pa.array(~known)).to_pylist())
        offsets = self.lexicon.offsets
        sizes = np.zeros(len(words), np.int64)
        sizes[known] = offsets[numbers[known] + 1] - offsets[numbers[known]]
        sizes[~known] = [len(ids) for ids in lists]
        ends = np.cumsum(sizes)
        flat = np.empty(int(sizes.sum()), np.int32)
        source = offsets[numbers[known]].astype(np.int64)
        flat[spread(ends[known] - sizes[known], sizes[known])] = self.lexicon.ids[spread(source, sizes[known])]
        flat[spread(ends[~known] - sizes[~known], sizes[~known])] = [i for ids in lists for i in ids]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))

    def groups(self, texts: list[str | None]):
        """Parts of texts in groups of a bounded size: lists of ``(text number, part, id)``."""
        group, size = [], 0
        for number, text in enumerate(texts):
            for part, added in self.parts(text or ""):
                group.append((number, part, added))
                size += len(part)
                if size >= 2 * CUT:
                    yield group
                    group, size = [], 0
        yield group

    def encoded(self, texts: list[str | None], finish) -> list:
        """``finish`` of a list of ``(ids, words)`` for each text: the ids of each of its parts, and a function that
        gives for a list of token values by id the value of the part."""
        found: list[list] = [[] for _ in texts]
        for group in self.groups(texts):
            if not group:
                continue
            plain = [part for _, part, added in group if added is None]
            cut = cut_words(plain, self.classes)
            tokens = self.tokens(cut.words)
            at = 0
            rows = finish.of_words(self, tokens)
            for number, part, added in group:
                if added is not None:
                    found[number].append(finish.of_added(self, added))
                    continue
                found[number].append(finish.of_part(rows, cut.codes[cut.first[at] : cut.first[at + 1]]))
                at += 1
        return [finish.of_text(parts) for parts in found]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each stretch, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Tokens:
    """``(ids, decoded)`` of a text."""

    fields = "ids array<int>, decoded string"

    @staticmethod
    def of_words(encoder: Encoder, tokens: pa.ListArray):
        return tokens, _joined(encoder.token_bytes, tokens, b"")

    @staticmethod
    def of_added(encoder: Encoder, added: int):
        return np.array([added], np.int32), encoder.rules.bytes_of[added]

    @staticmethod
    def of_part(rows, codes: np.ndarray):
        tokens, decoded = rows
        return tokens.take(pa.array(codes)).flatten().to_numpy(), b"".join(decoded.take(pa.array(codes)).to_pylist())

    @staticmethod
    def of_text(parts: list) -> tuple:
        ids = np.concatenate([ids for ids, _ in parts]) if parts else np.zeros(0, np.int32)
        return ids, b"".join(decoded for _, decoded in parts).decode("utf-8", "replace")


class Digests:
    """``(n_tokens, ids_sha256, decoded_sha256)`` of a text."""

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    @staticmethod
    def of_words(encoder: Encoder, tokens: pa.ListArray):
        sizes = np.diff(tokens.offsets.to_numpy())
        texts = _joined(encoder.token_text, tokens, b",").to_pylist()
        return sizes, texts, _joined(encoder.token_bytes, tokens, b"").to_pylist()

    @staticmethod
    def of_added(encoder: Encoder, added: int):
        return 1, str(added).encode(), encoder.rules.bytes_of[added]

    @staticmethod
    def of_part(rows, codes: np.ndarray):
        sizes, texts, decoded = rows
        listed = codes.tolist()
        return int(sizes[codes].sum()), b",".join([texts[i] for i in listed]), b"".join([decoded[i] for i in listed])

    @staticmethod
    def of_text(parts: list) -> tuple:
        ids = b",".join(ids for _, ids, _ in parts)
        # Bytes that are no UTF-8 are replaced; those of a text's own tokens never need it.
        decoded = b"".join(decoded for _, _, decoded in parts).decode("utf-8", "replace").encode()
        return sum(n for n, _, _ in parts), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


OUTPUTS = {"tokens": Tokens, "digests": Digests}


def _joined(values: pa.Array, tokens: pa.ListArray, by: bytes) -> pa.Array:
    """The values of each list of ids, joined."""
    return pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, values.take(tokens.values)), by)


def word_counts(docs: DataFrame, text: str, added: list[str]) -> DataFrame:
    """``(word, n)``: how often each word of at most ``LEXICON_BYTES`` occurs in all texts."""
    rules = Rules([], [], {}, dict.fromkeys(added, 0))

    def count(batches):
        encoder = Encoder(rules, transducer.compile_lexicon([], []))
        kept = pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        for block in blocks(batches, "_text"):
            for group in encoder.groups(block.column("_text").to_pylist()):
                cut = cut_words([part for _, part, known in group if known is None], encoder.classes)
                own = pa.table({"word": cut.words, "n": pa.array(np.bincount(cut.codes, minlength=len(cut.words)).astype(np.int64))})
                own = own.filter(pc.less_equal(pc.binary_length(own["word"]), LEXICON_BYTES))
                kept = pa.concat_tables([kept, own]).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
                if kept.num_rows >= COUNTED_WORDS:
                    yield from kept.to_batches(20_000)
                    kept = kept.slice(0, 0)
        yield from kept.to_batches(20_000)

    counted = docs.select(docs[text].alias("_text")).mapInArrow(count, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent words that occur twice or more, ``most`` at most: whole classes of frequency are taken."""
    level = F.floor(F.log2("n") * 64).cast("int")
    # At most 64 classes for each doubling, so some thousands.
    classes = sorted(counts.filter("n > 1").groupBy(level.alias("level")).count().collect(), reverse=True)
    room, least = most, None
    for row in classes:
        if row["count"] > room:
            break
        room, least = room - row["count"], row["level"]
    return counts.filter(F.lit(False) if least is None else (F.col("n") > 1) & (level >= least)).select("word")


#: What this worker used last: rules and lexicon by the name of the file.
_ENCODER: dict[str, Encoder] = {}


class Vocabulary:
    """Rules and a lexicon at the executors: both are bounded, by the tokenizer file and by ``LEXICON_WORDS``."""

    def __init__(self, spark: SparkSession, rules: Rules, lexicon: transducer.Lexicon):
        self.rules = spark.sparkContext.broadcast(rules)
        path = fresh_path(spark, "lexicon")
        hadoop, configuration = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        target = hadoop.Path(path)
        stream = target.getFileSystem(configuration).create(target)
        stream.write(bytearray(transducer.to_bytes(lexicon)))
        stream.close()
        # Spark copies it to every machine.
        spark.sparkContext.addFile(target.getFileSystem(configuration).makeQualified(target).toString())
        self.name = path.rsplit("/", 1)[-1]

    def encoder(self) -> Encoder:
        if self.name not in _ENCODER:
            _ENCODER.clear()
            _ENCODER[self.name] = Encoder(self.rules.value, transducer.open_mapped(SparkFiles.get(self.name)))
        return _ENCODER[self.name]


def learn(docs: DataFrame, path: str, text: str = "text", words: int = LEXICON_WORDS) -> Vocabulary:
    """The vocabulary in a tokenizer file with a lexicon of the frequent words of ``docs``."""
    spark, rules = docs.sparkSession, load_rules(path)
    shared = spark.sparkContext.broadcast(rules)

    def merged(batches):
        for batch in batches:
            ids = Merger(shared.value).merge(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    counts = materialize(word_counts(docs, text, list(rules.added)), "word-counts")
    # At most ``words`` rows.
    known = frequent(counts, words).mapInArrow(merged, "word binary, ids array<int>").toArrow()
    lexicon = transducer.compile_lexicon(known["word"].to_pylist(), known["ids"].to_pylist())
    return Vocabulary(spark, rules, lexicon)


def encode(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, text: str = "text", output: str = "tokens") -> DataFrame:
    """``keep`` and, by ``output``, ``ids`` with the ``decoded`` text, or their number and digests of both."""
    finish = OUTPUTS[output]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    arrow = [kinds[field.dataType.simpleString()] for field in StructType.fromDDL(finish.fields).fields]

    def work(block: pa.RecordBatch) -> list[pa.Array]:
        rows = vocabulary.encoder().encoded(block.column("_text").to_pylist(), finish)
        return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(arrow)]

    return map_blocks(docs, keep, text, finish.fields, work)


def decode(encoded: DataFrame, keep: list[str], vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """The text of token ids: ``keep`` and ``decoded``; null ids decode to nothing."""
    schema = StructType([encoded.schema[name] for name in keep] + StructType.fromDDL("decoded string").fields)

    def run(batches):
        bytes_of = vocabulary.rules.value.bytes_of
        for batch in batches:
            rows = batch.column(len(keep)).to_pylist()
            decoded = [b"".join(bytes_of[i] for i in row or ()).decode("utf-8", "replace") for row in rows]
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return encoded.select(*keep, encoded[ids].alias("_ids")).mapInArrow(run, schema)
