"""Byte-level BPE: overlapping chunk encoding and decoding.

A long text is cut into overlapping chunks that are pre-tokenised apart from each other. Where the
piece boundaries of two neighbouring chunks meet again inside their overlap, the text from there on is
cut alike in both, so the chunks are stitched at that place. Stretches in which they never meet (one
piece longer than the overlap) are pre-tokenised once more over both chunks. Then the pieces are
encoded. Decoding puts the bytes of the tokens together.

Texts of one chunk are encoded where they are read. Only the chunks of longer ones are shuffled, by
text, to be stitched: one text is one row of the result, so a text has to fit a task.

Defined cases: a null text is empty and has no tokens; repeated rows each have a result row (equal long
texts of one key are encoded once); an empty table gives an empty result. Columns of ``docs`` that are
not named are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.texts import map_blocks

#: Characters of a chunk, and how many of them it shares with the one after it.
CHUNK = 65_536
OVERLAP = 1_024
#: Pieces whose tokens a worker keeps at hand.
CACHED_PIECES = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


NEVER = 1 << 30
#: Ranks below this; two of them are looked up as one number.
MAX_RANK = 1 << 17


class _Joined(dict):
    """The rank of two tokens put together, by both numbers; looked up in the vocabulary once."""

    def __init__(self, ranks: dict[bytes, int], tokens: dict[int, bytes]):
        self.ranks, self.tokens = ranks, tokens

    def __missing__(self, pair: int) -> int:
        if len(self) >= CACHED_PIECES:
            self.clear()
        rank = self.ranks.get(self.tokens[pair >> 17] + self.tokens[pair & 0x1FFFF], NEVER)
        self[pair] = rank
        return rank


class Codec:
    """Pre-tokenising, merging and decoding by one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(not 0 <= rank < MAX_RANK for rank in ranks.values()):
            raise ValueError(f"ranks must be below {MAX_RANK}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.of_byte = [ranks.get(bytes([b])) for b in range(256)]
        self.joined = _Joined(ranks, self.tokens)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, tuple[int, ...]] = {}

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_pieces(self, pieces: list[str]) -> Iterator[tuple[int, ...]]:
        """The tokens of each piece."""
        known = self.known
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                if len(known) >= CACHED_PIECES:
                    known.clear()
                ids = known[piece] = self.merge(piece.encode())
            yield ids

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Join the neighbours of least rank, the leftmost first, until no pair is in the vocabulary."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 200:
            return _merge_long(piece, ranks)
        # A joined token's number is its rank.
        ids, joined = [self.of_byte[b] for b in piece], self.joined
        pairs = [joined[a << 17 | b] for a, b in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            ids[i] = best
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = joined[best << 17 | ids[i + 1]]
            if i:
                pairs[i - 1] = joined[ids[i - 1] << 17 | best]
        return tuple(ids)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same for long pieces, with a heap of pairs and links between neighbours."""
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is joined to the left
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != j:
            continue
        end[i], end[middle] = j, 0
        if j < n:
            before[j] = i
            if (rank := ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, end[j]))
        left = before[i]
        if left >= 0 and (rank := ranks.get(piece[left:j])) is not None:
            heapq.heappush(heap, (rank, left, j))
    return tuple(ranks[piece[i : end[i]]] for i in range(n) if end[i])


#: The codec that this worker used last, by its vocabulary.
_CODEC: dict[str, Codec] = {}


class Vocabulary:
    """A vocabulary sent to the executors: its size is that of the rank file, whatever the data."""

    def __init__(self, spark, path: str, pattern: str):
        ranks = load_ranks(path)
        self.pattern = pattern
        self.name = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
        self.shared = spark.sparkContext.broadcast(ranks)

    def codec(self) -> Codec:
        """The codec of this worker, made once."""
        if self.name not in _CODEC:
            _CODEC.clear()
            _CODEC[self.name] = Codec(self.shared.value, self.pattern)
        return _CODEC[self.name]


def stitch(codec: Codec, chunks: list[tuple[str, list[int]]], step: int) -> list[str]:
    """The pieces of a text from its chunks and the piece starts in each, in order.

    ``step`` is how far a chunk begins after the one before it.
    """
    text, starts = chunks[0][0], chunks[0][1]
    for number, (chunk, own) in enumerate(chunks[1:], 1):
        begin = number * step
        # Up to here both have a piece start of their own; the last start of a chunk is sound.
        mine = {start + begin for start in own}
        at = next((i for i, start in enumerate(starts) if start >= begin and start in mine), None)
        text += chunk[len(text) - begin :]
        if at is None:
            # They never meet: cut the rest again from the last sound start.
            last = starts.pop() if starts else 0
            again, place = [], last
            for piece in codec.pieces(text[last:]):
                again.append(place)
                place += len(piece)
            starts += again
        else:
            meeting = starts[at]
            starts = starts[:at] + sorted(start for start in mine if start >= meeting)
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


_FIELDS = "ids array<int>, decoded binary"


def _encoded(codec: Codec, pieces: list[str]) -> tuple[list[int], bytes]:
    ids = [i for piece in codec.encode_pieces(pieces) for i in piece]
    return ids, codec.decode(ids)


def _digest_row(ids: list[int], decoded: bytes) -> tuple[int, str, str]:
    text = " ".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256(decoded).hexdigest()


#: What a caller wants of each text: the columns, and how they follow from tokens and decoded bytes.
OUTPUTS = {
    "tokens": (_FIELDS, lambda ids, decoded: (ids, decoded)),
    "both": (
        "n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string",
        lambda ids, decoded: (len(ids), ids, *_digest_row(ids, decoded)[1:]),
    ),
    "digests": ("n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digest_row),
}


def encode(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, text: str = "text", output: str = "tokens",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` and, by ``output``, the token ids with the bytes they decode to, or digests of both."""
    if not 0 < overlap < chunk:
        raise ValueError("overlap must be positive and less than chunk")
    fields, finish = OUTPUTS[output]
    types = [field.dataType for field in StructType.fromDDL(fields).fields]
    arrow = [_arrow(kind.simpleString()) for kind in types]

    def arrays(rows: list[tuple]) -> list[pa.Array]:
        return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(arrow)]

    def short(block: pa.RecordBatch) -> list[pa.Array]:
        codec = vocabulary.codec()
        return arrays([finish(*_encoded(codec, codec.pieces(text or ""))) for text in block.column("_text").to_pylist()])

    length = F.coalesce(F.length(docs[text]), F.lit(0))
    brief = map_blocks(docs.filter(length <= chunk), keep, text, fields, short)
    chunks = _pretokenised(docs.filter(length > chunk), keep, text, vocabulary, chunk, overlap)
    return brief.unionByName(_stitched(chunks, docs, keep, vocabulary, chunk - overlap, fields, finish, arrow))


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[kind]


def _pretokenised(docs, keep, text, vocabulary, chunk, overlap) -> DataFrame:
    """Chunks of long texts with the starts of their pieces: ``(_key.., _digest, number, _text, starts)``."""
    step = chunk - overlap
    length = F.length("_text")
    last = F.ceil((length - chunk) / F.lit(step)).cast("int")
    cut = (
        docs.select(F.struct(*keep).alias("_keep"), docs[text].alias("_text"))
        .select("_keep", F.sha2("_text", 256).alias("_digest"), "_text", F.explode(F.sequence(F.lit(0), last)).alias("number"))
        .select("_keep", "_digest", "number", F.substring("_text", F.col("number") * step + 1, F.lit(chunk)).alias("_chunk"))
    )

    def piece_starts(block: pa.RecordBatch) -> list[pa.Array]:
        codec, found = vocabulary.codec(), []
        for chunk_text in block.column("_text").to_pylist():
            starts, at = [], 0
            for piece in codec.pieces(chunk_text):
                starts.append(at)
                at += len(piece)
            found.append(starts)
        return [block.column("_text"), pa.array(found, pa.list_(pa.int32()))]

    return map_blocks(cut, ["_keep", "_digest", "number"], "_chunk", "chunk string, starts array<int>", piece_starts)


def _stitched(chunks, docs, keep, vocabulary, step, fields, finish, arrow) -> DataFrame:
    # Chunks of equal texts of one key are the same rows: one set of them, and how many texts there are.
    grouped = chunks.groupBy("_keep", "_digest", "number").agg(
        F.first(F.struct("chunk", "starts")).alias("cut"), F.count(F.lit(1)).alias("copies")
    )
    texts = grouped.groupBy("_keep", "_digest").agg(
        F.sort_array(F.collect_list(F.struct("number", "cut"))).alias("chunks"), F.max("copies").alias("copies")
    )
    kept = StructType([docs.schema[name] for name in keep])
    schema = StructType([*kept.fields, *StructType.fromDDL(fields).fields])

    def finish_texts(batches):
        codec = vocabulary.codec()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                parts = [(c["cut"]["chunk"], c["cut"]["starts"]) for c in row.column("chunks")[0].as_py()]
                done = finish(*_encoded(codec, stitch(codec, parts, step)))
                columns = [row.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array([value], kind) for value, kind in zip(done, arrow)], names=schema.names
                )

    rows = texts.select("_keep.*", "chunks", "copies").withColumn("_", F.explode(F.sequence(F.lit(1), "copies")))
    return rows.select(*keep, "chunks").mapInArrow(finish_texts, schema)


def decode(encoded: DataFrame, keep: list[str], vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """The bytes of token ids: ``keep`` and ``decoded``; null ids decode to nothing."""
    schema = StructType([encoded.schema[name] for name in keep] + StructType.fromDDL("decoded binary").fields)

    def run(batches):
        codec = vocabulary.codec()
        for batch in batches:
            decoded = [codec.decode(row or ()) for row in batch.column("_ids").to_pylist()]
            columns = [batch.column(name) for name in keep] + [pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return encoded.select(*keep, encoded[ids].alias("_ids")).mapInArrow(run, schema)

