"""Arrow batches of texts inside a task: blocks of bounded size, and their words as byte arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Bytes of text that a task works on at a time; a longer text is a block of its own.
BLOCK_BYTES = 2_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words: digits, letters and everything outside ASCII (after lower-casing).
LETTERS = np.zeros(256, dtype=bool)
LETTERS[ord("0") : ord("9") + 1] = True
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[0x80:] = True

#: Bytes of words parted by white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


class Words(NamedTuple):
    """The words of a block: ``first[i]:first[i + 1]`` are those of text ``i``.

    ``starts`` are their first bytes in the block, ``edges`` the first byte of each text.
    """

    values: pa.Array
    first: np.ndarray
    starts: np.ndarray
    edges: np.ndarray

    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a block, and the first byte of each text (nulls are empty)."""
    binary = pc.fill_null(texts.cast(pa.binary()), b"")
    size, start = len(binary), binary.offset
    if not size:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(binary.buffers()[1], dtype=np.int32)[start : start + size + 1].astype(np.int64)
    data = binary.buffers()[2]
    bytes_ = np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, edges - edges[0]


def words_of(texts: pa.Array, in_word: np.ndarray) -> Words:
    """Lower-case A-Z and take the runs of bytes in ``in_word``; no word spans two texts."""
    data, edges = text_bytes(texts)
    data = LOWER[data]
    inside = in_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = edges[:-1][edges[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    kept = data[inside]
    offsets = np.empty(len(starts) + 1, dtype=np.int32)
    # Where each word begins once all other bytes are gone.
    offsets[:-1] = np.cumsum(inside, dtype=np.int64)[starts] - 1
    offsets[-1] = len(kept)
    values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return Words(values, np.searchsorted(starts, edges), starts, edges)


def blocks(batches: Iterable[pa.RecordBatch], column: str | int = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into blocks of about ``limit`` bytes of text, a row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < len(ends):
            done = ends[at - 1] if at else 0
            after = max(int(np.searchsorted(ends, done + limit, side="right")), at + 1)
            yield batch.slice(at, after - at)
            at = after


def release() -> None:
    """Give back what Arrow keeps at hand for later: workers outlive their tasks, and others share their machine."""
    pa.default_memory_pool().release_unused()


def map_blocks(
    docs: DataFrame,
    keep: list[str],
    column: str,
    fields: str,
    work: Callable[[pa.RecordBatch], list[pa.Array]],
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """Work out ``fields`` (names and types, as SQL writes them) from a text column, block by block, beside the columns in ``keep``.

    ``work`` gets a block of the one column ``_text`` and gives one array for each field.
    Only the named columns are read, so other columns of ``docs`` cannot clash; kept ones may have any name.
    """
    schema = StructType([docs.schema[name] for name in keep] + StructType.fromDDL(fields).fields)
    kept = len(keep)

    def run(batches):
        for block in blocks(batches, kept, limit):
            texts = pa.RecordBatch.from_arrays([block.column(kept)], names=["_text"])
            columns = [block.column(i) for i in range(kept)] + work(texts)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        release()

    # A name that no kept column has.
    name = "_text"
    while name in keep:
        name += "_"
    return docs.select(*[docs[kept_name] for kept_name in keep], docs[column].alias(name)).mapInArrow(run, schema)
