"""A convolutional network over bytes in NumPy, and the quality classifier that it is.

A text is cut into overlapping chunks that cover all of it. In a chunk, at every byte from which a window fits, learned
filters look at the embeddings of the bytes from there on, and the greatest value of each filter stands for the chunk, beside the
share of it that is filled. A hidden layer turns that into a few numbers, the mean over all chunks of the text
stands for the text, and a last layer gives one probability.

The network is trained in one task on a bounded sample of labelled rows (``TRAIN_TEXTS``, the least by a digest of the
id, and ``TRAIN_CHUNKS`` spread over each). All texts are scored as a whole where they are read, without a shuffle.

Defined cases: a null text is empty, and an empty text is one chunk that is filled to no part; an unlabelled or null
label row is not trained on, nor is one of a null id; an id labelled more than once counts with each of its labels; a
table without labelled rows gives every text the score of an untrained network, one half; repeated rows are each
scored; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.texts import map_blocks, text_bytes
from kindred.session import materialize

#: Bytes of a chunk, and how far the next one begins after it.
CHUNK = 512
STRIDE = 384
WIDTH = 10
#: Bytes from one window to the next. With more than one, bytes and patterns between windows are not looked at.
HOP = 1
EMBEDDING = 8
FILTERS = 32
HIDDEN = 16
#: Number of a byte that is not there.
NONE = 256

TRAIN_TEXTS = 4_000
TRAIN_CHUNKS = 8
#: Steps of training, whatever the size of the sample.
STEPS = 1_000
BATCH = 32
RATE = 0.004
FOLDS = 5
THRESHOLD = 0.3

_AT = np.arange(0, CHUNK - WIDTH + 1, HOP)
_COLUMNS = _AT[:, None] + np.arange(WIDTH)
Weights = dict[str, np.ndarray]


def chunks_of(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All chunks of the texts ``data[edges[i]:edges[i + 1]]``, their filled share, and each text's first chunk."""
    sizes = np.diff(edges)
    counts = np.maximum(1, -(-np.maximum(sizes - CHUNK, 0) // STRIDE) + 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    own = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    begin = np.repeat(edges[:-1], counts) + own * STRIDE
    end = np.minimum(begin + CHUNK, np.repeat(edges[1:], counts))
    padded = np.append(data.astype(np.int16), np.full(CHUNK, NONE, np.int16))
    places = begin[:, None] + np.arange(CHUNK)
    chunks = padded[np.minimum(places, len(padded) - 1)]
    chunks[places >= end[:, None]] = NONE
    return chunks, ((end - begin) / CHUNK).astype(np.float32), first


def initial() -> Weights:
    draw = np.random.default_rng(3)
    scale = lambda *shape: draw.normal(0, 1, shape).astype(np.float32)
    weights = {
        "bytes": scale(NONE + 1, EMBEDDING),
        "filters": scale(WIDTH * EMBEDDING, FILTERS) * np.float32((1 / (WIDTH * EMBEDDING)) ** 0.5),
        "levels": np.zeros(FILTERS, np.float32),
        "mix": scale(FILTERS + 1, HIDDEN) * np.float32((2 / FILTERS) ** 0.5),
        "mix_levels": np.zeros(HIDDEN, np.float32),
        "last": np.zeros(HIDDEN, np.float32),
        "last_level": np.zeros(1, np.float32),
    }
    weights["bytes"][NONE] = 0
    return weights


def _responses(weights: Weights, chunks: np.ndarray) -> np.ndarray:
    """What each filter finds at each place of each chunk: ``(filters, chunks, places)``."""
    embedded = np.take(weights["bytes"], chunks, axis=0).reshape(len(chunks), -1)
    windows = sliding_window_view(embedded, WIDTH * EMBEDDING, axis=1)[:, :: HOP * EMBEDDING]
    seen = np.ascontiguousarray(windows).reshape(-1, WIDTH * EMBEDDING)
    return (weights["filters"].T @ seen.T).reshape(FILTERS, len(chunks), len(_AT))


def pooled(weights: Weights, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The greatest value of each filter in each chunk (zero at least), and where it is."""
    values = np.empty((len(chunks), FILTERS), np.float32)
    places = np.empty((len(chunks), FILTERS), np.int64)
    for at in range(0, len(chunks), 64):
        found = _responses(weights, chunks[at : at + 64])
        places[at : at + 64] = found.argmax(axis=2).T
        values[at : at + 64] = found.max(axis=2).T
    return np.maximum(values + weights["levels"], 0), places


def hidden(weights: Weights, values: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inputs = np.concatenate([values, filled[:, None]], axis=1)
    return inputs, np.maximum(inputs @ weights["mix"] + weights["mix_levels"], 0)


def probabilities(weights: Weights, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The probability of each text."""
    chunks, filled, first = chunks_of(data, edges)
    values = np.empty((len(chunks), FILTERS), np.float32)
    for at in range(0, len(chunks), 16):
        # The greatest value without its place, which only training needs.
        values[at : at + 16] = _responses(weights, chunks[at : at + 16]).max(axis=2).T
    _, units = hidden(weights, np.maximum(values + weights["levels"], 0), filled)
    means = np.add.reduceat(units, first[:-1]) / np.diff(first)[:, None]
    return 1 / (1 + np.exp(-(means @ weights["last"] + weights["last_level"]).astype(np.float64)))


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS) -> Weights:
    """Weights fitted to texts given as ``(chunks, filled)``, by Adam on the logarithmic loss."""
    weights = initial()
    mean = {name: np.zeros_like(value) for name, value in weights.items()}
    square = {name: np.zeros_like(value) for name, value in weights.items()}
    draw = np.random.default_rng(11)
    turn: list[np.ndarray] = []
    for step in range(1, steps + 1):
        if not turn:
            turn = np.array_split(draw.permutation(len(texts)), -(-len(texts) // BATCH))
        own = turn.pop()
        chunks = np.concatenate([texts[i][0] for i in own])
        filled = np.concatenate([texts[i][1] for i in own])
        counts = np.array([len(texts[i][0]) for i in own])
        grads = _gradients(weights, chunks, filled, counts, labels[own])
        rate = np.float32(RATE * (1 - step / (steps + 1)) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step))
        for name, grad in grads.items():
            mean[name] += 0.1 * (grad - mean[name])
            square[name] += 0.001 * (grad * grad - square[name])
            weights[name] -= rate * mean[name] / (np.sqrt(square[name]) + 1e-7)
    return weights


def _gradients(weights: Weights, chunks, filled, counts, labels) -> Weights:
    values, places = pooled(weights, chunks)
    inputs, units = hidden(weights, values, filled)
    first = np.cumsum(counts) - counts
    means = np.add.reduceat(units, first) / counts[:, None]
    p = 1 / (1 + np.exp(-(means @ weights["last"] + weights["last_level"])))
    error = ((p - labels) / len(labels)).astype(np.float32)
    grads = {"last": means.T @ error, "last_level": np.array([error.sum()], np.float32)}
    into_units = np.repeat(error[:, None] * weights["last"] / counts[:, None], counts, axis=0).astype(np.float32)
    into_units *= units > 0
    grads |= {"mix": inputs.T @ into_units, "mix_levels": into_units.sum(axis=0)}
    into_values = (into_units @ weights["mix"].T)[:, :-1] * (values > 0)
    grads["levels"] = into_values.sum(axis=0)
    # A filter learns from the one place of a chunk where it was greatest.
    seen = np.take_along_axis(chunks[:, None, :], _COLUMNS[places], axis=2)
    embedded = weights["bytes"][seen]
    grads["filters"] = np.einsum("cfwe,cf->wef", embedded, into_values).reshape(-1, FILTERS)
    turned = weights["filters"].reshape(WIDTH, EMBEDDING, FILTERS).transpose(2, 0, 1)
    into_bytes = into_values[:, :, None, None] * turned[None]
    grads["bytes"] = np.stack(
        [np.bincount(seen.ravel(), into_bytes[..., e].ravel(), minlength=NONE + 1) for e in range(EMBEDDING)], axis=1
    ).astype(np.float32)
    grads["bytes"][NONE] = 0
    return grads


def held_out(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, limit: int) -> DataFrame:
    """``(label, chunks, filled)`` of the sample: at most ``limit`` labelled ids that are not held out."""
    known = labels.select(labels[doc_id].alias("_id"), labels[label].cast("int").alias("_label")).dropna()
    order = F.md5(F.col("_id").cast("string"))
    # At most ``limit`` rows of two numbers, so they go to every executor.
    chosen = materialize(known.filter(~held_out("_id")).orderBy(order, "_id", "_label").limit(limit), "labelled")
    rows = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text")).join(F.broadcast(chosen), "_id")

    def some_chunks(block: pa.RecordBatch) -> list[pa.Array]:
        chunks, filled, first = chunks_of(*text_bytes(block.column("_text")))
        out, parts = [], []
        for begin, end in zip(first[:-1], first[1:]):
            take = np.unique(np.linspace(begin, end - 1, min(TRAIN_CHUNKS, end - begin)).astype(np.int64))
            out.append(chunks[take].tobytes())
            parts.append(filled[take].tobytes())
        return [pa.array(out, pa.binary()), pa.array(parts, pa.binary())]

    return map_blocks(rows, ["_id", "_label"], "_text", "chunks binary, filled binary", some_chunks)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        limit: int = TRAIN_TEXTS) -> Weights:
    """Weights learned from rows whose id is not held out.

    What one task trains on is at most ``limit`` ids with ``TRAIN_CHUNKS`` chunks for each of their rows.
    """
    sample = materialize(training_rows(docs, labels, label, doc_id, text, limit), "training-chunks")

    def learn(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        rows.sort(key=lambda row: (row["_id"], row["_label"], row["chunks"]))
        texts = [
            (np.frombuffer(r["chunks"], np.int16).reshape(-1, CHUNK), np.frombuffer(r["filled"], np.float32)) for r in rows
        ]
        weights = train(texts, np.array([row["_label"] for row in rows], np.float32))
        yield pa.RecordBatch.from_pydict({"name": list(weights), "values": [w.tobytes() for w in weights.values()]})

    # One row per id is enough: copies of a row would only weigh more.
    once = sample.groupBy("_id", "_label").agg(F.min(F.struct("chunks", "filled")).alias("s")).select("_id", "_label", "s.*")
    learned = once.coalesce(1).mapInArrow(learn, "name string, values binary").collect()
    weights = initial()
    for row in learned:
        weights[row["name"]] = np.frombuffer(row["values"], np.float32).reshape(weights[row["name"]].shape)
    return weights


def classify(docs: DataFrame, weights: Weights, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, the ``score`` of every whole text and ``predicted`` (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(block: pa.RecordBatch) -> list[pa.Array]:
        scores = probabilities(shared.value, *text_bytes(block.column("_text")))
        return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

    return map_blocks(docs, keep, text, "score double, predicted int", work, limit=1_000_000)


def passing(docs: DataFrame, weights: Weights, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, as they are."""
    rows = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("_row"), docs[text].alias("_body"))
    return classify(rows, weights, ["_row"], "_body", threshold).filter("predicted = 1").select("_row.*")
