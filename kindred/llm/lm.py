"""Language-model scores of texts: word counts of the whole corpus, and a recurrent model on top.

1. Words of all training texts are counted, added up in each task before the shuffle. The counts give the base
   score, the vocabulary of the model and the share of every rare word within the tail.
2. The model (:mod:`kindred.llm.gru`) is warmed up in one task on a bounded sample, then every task goes on from
   there over all its training texts, and the weights of the tasks are averaged by their tokens, in two steps.
3. All texts are scored in one pass, each as a whole, with the state carried from window to window. Frequent words
   (the ``HEAD_WORDS`` at most, each of ``HEAD_BYTES`` at most, so a bounded broadcast) are looked up there. What is
   left, one row per text and rare word, is joined with the counts.

As each task trains on its own share, the weights, and with them ``score``, depend on how the input is split into
tasks (the base score does not); over the same tasks they are the same on every run.

The words of a text and its end are its tokens. Defined cases: a null text is empty, its only token is its end; rows
with a null id are training rows; repeated rows each count and each have a result row; without training texts every
token has the probability of an unseen one and the model is untrained; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm import gru
from kindred.llm.texts import NOT_SPACE, blocks, words_of
from kindred.session import fresh_path, materialize

HEAD_WORDS = 2**18
HEAD_BYTES = 32
#: Texts of the warm-up, drawn from all training texts, and how many of their tokens it uses at most.
WARM_TEXTS = 1_500
WARM_TOKENS = 600_000
WARM_RATE, RATE = 0.005, 0.002
#: Words of blocks that a task adds up before it hands them on.
TASK_WORDS = 800_000
#: Bytes of text that run in step.
LANE_BYTES = 12_000_000
FOLDS, HELD_OUT = 7, 2


def held_out(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def count_words(texts: DataFrame, text: str) -> DataFrame:
    """``(word, n)`` over all texts; ends of texts are not words."""

    def run(batches):
        pending: list[pa.Table] = []
        for block in blocks(batches, "_text"):
            coded = words_of(block.column("_text"), NOT_SPACE).values.dictionary_encode()
            counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            pending.append(pa.table({"word": coded.dictionary, "n": pa.array(counts, pa.int64())}))
            if sum(table.num_rows for table in pending) >= TASK_WORDS:
                yield from _summed(pending)
                pending = []
        if pending:
            yield from _summed(pending)

    rows = texts.select(texts[text].alias("_text")).mapInArrow(run, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _summed(counts: list[pa.Table]) -> list[pa.RecordBatch]:
    """Counts added up by word, before they leave the task."""
    table = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return table.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches(max_chunksize=50_000)


class Counts(NamedTuple):
    """``words`` of the training texts with their counts, and what is broadcast of them."""

    words: DataFrame
    ends: int
    tokens: int
    distinct: int
    head: list[tuple[bytes, int]]


def corpus_counts(training: DataFrame, text: str, head_words: int = HEAD_WORDS) -> Counts:
    words = materialize(count_words(training, text), "word-counts")
    ends = training.count()
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("words")).first()
    # How many words there are of each count, in steps of an eighth of a doubling: a few hundred rows.
    short = words.filter(F.octet_length("word") <= HEAD_BYTES)
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    sizes = short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    fits, lowest = 0, None
    for row in sizes:
        fits += row["count"]
        if fits > head_words:
            break
        lowest = row["level"]
    head = [] if lowest is None else short.filter(level >= lowest).collect()
    listed = sorted(((bytes(row["word"]), row["n"]) for row in head), key=lambda e: (-e[1], e[0]))
    return Counts(words, ends, total["n"] + ends, total["words"] + (ends > 0), listed)


class Head:
    """Frequent words on an executor: numbers of the model's tokens and counts, by word."""

    def __init__(self, head: list[tuple[bytes, int]], ends: int):
        self.words = pa.array([word for word, _ in head], pa.binary())
        # One more for the words that are not there, which the model has in the tail.
        self.counts = np.array([n for _, n in head] + [0], dtype=np.int64)
        tokens = np.full(len(head) + 1, gru.TAIL, dtype=np.int32)
        known = min(len(head), gru.WORDS)
        tokens[:known] = np.arange(known)
        self.tokens, self.ends = tokens, ends

    def places(self, words: pa.Array) -> np.ndarray:
        """The place of each word in the list, or the list's length."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), len(self.words)).to_numpy(zero_copy_only=False)


_HEAD: dict[str, Head] = {}


class SharedHead:
    """The head sent to the executors, made ready once per worker."""

    def __init__(self, spark, counts: Counts):
        self.name = uuid.uuid4().hex
        self.shared = spark.sparkContext.broadcast((counts.head, counts.ends))

    def get(self) -> Head:
        if self.name not in _HEAD:
            _HEAD.clear()
            _HEAD[self.name] = Head(*self.shared.value)
        return _HEAD[self.name]


class Lanes(NamedTuple):
    """A block of texts as tokens: places in the head (its length: not there, -1: the end), and token numbers."""

    rows: pa.RecordBatch
    places: np.ndarray
    tokens: np.ndarray
    first: np.ndarray
    rare: pa.Array
    rare_owner: np.ndarray


def lanes(batches, head: Head):
    """Blocks of about ``LANE_BYTES``, tokenised a few megabytes at a time."""
    for block in blocks(batches, "_text", LANE_BYTES):
        places, sizes, rare, owners, done = [], [], [], [], 0
        for part in blocks([block], "_text"):
            words = words_of(part.column("_text"), NOT_SPACE)
            own = head.places(words.values)
            missing = np.flatnonzero(own == len(head.words))
            rare.append(words.values.take(pa.array(missing)))
            owners.append(words.owner()[missing] + done)
            places.append(np.insert(own, words.first[1:], -1))
            sizes.append(np.diff(words.first) + 1)
            done += part.num_rows
        found = np.concatenate(places)
        tokens = np.where(found < 0, np.int32(gru.END), head.tokens[found])
        first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        yield Lanes(block, found, tokens, first, pa.concat_arrays(rare), np.concatenate(owners))


def token_counts(counts: Counts) -> np.ndarray:
    """How often each token of the model occurs in training."""
    known = [n for _, n in counts.head[: gru.WORDS]]
    found = np.zeros(gru.TAIL + 1)
    found[: len(known)] = known
    found[gru.END] = counts.ends
    found[gru.TAIL] = counts.tokens - counts.ends - sum(known)
    return found


def train(training: DataFrame, text: str, counts: Counts, head: SharedHead, sample_texts: int = WARM_TEXTS,
          sample_tokens: int = WARM_TOKENS) -> gru.Weights:
    """Weights of the model after one pass over all training texts."""
    start = gru.initial(token_counts(counts))
    if not counts.ends:
        return start
    texts = training.select(training[text].alias("_text"))
    sample = materialize(texts.sample(min(1.0, sample_texts / counts.ends), seed=5), "warm-up")
    warm = _averaged(_learned(sample.repartition(1), start, head, WARM_RATE, sample_tokens)) or start
    return _averaged(_learned(texts, warm, head, RATE, None)) or warm


def _learned(texts: DataFrame, weights: gru.Weights, head: SharedHead, rate: float, limit: int | None) -> DataFrame:
    """``(part, tokens, weights)`` of every task, each having gone on from ``weights`` over its own texts."""
    shared = texts.sparkSession.sparkContext.broadcast(gru.to_bytes(weights))

    def run(batches):
        trainer = gru.Trainer(gru.from_vector(np.frombuffer(shared.value, np.float32)), rate)
        for block in lanes(batches, head.get()):
            trainer.learn(block.tokens, block.first)
            if limit is not None and trainer.tokens >= limit:
                break
        if trainer.tokens:
            part = TaskContext.get().partitionId()
            total = np.concatenate([trainer.weights[n].ravel() for n in gru.SHAPES]).astype(np.float64) * trainer.tokens
            yield pa.RecordBatch.from_pydict({"part": [part], "tokens": [trainer.tokens], "total": [total.tobytes()]})

    return texts.mapInArrow(run, _SUMS)


_SUMS = "part bigint, tokens bigint, total binary"


def _averaged(learned: DataFrame) -> gru.Weights | None:
    """Weights averaged by tokens: summed in about the root of the number of tasks, then in one."""

    def add(batches):
        first, tokens, total = None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["total"], np.float64)
                first = row["part"] if first is None else first
                tokens, total = tokens + row["tokens"], own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [first], "tokens": [tokens], "total": [total.tobytes()]})

    written = materialize(learned, "weights")
    groups = math.isqrt(max(written.count(), 1)) + 1
    # The order of a sum is that of the tasks, so the average is the same on every run over the same tasks.
    some = written.repartition(groups, (F.col("part") % groups)).sortWithinPartitions("part").mapInArrow(add, _SUMS)
    found = some.repartition(1).sortWithinPartitions("part").mapInArrow(add, _SUMS).collect()
    if not found:
        return None
    return gru.from_vector(np.frombuffer(found[0]["total"], np.float64) / found[0]["tokens"])


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    Both scores are log10 probabilities of the whole text.
    """
    training = docs.filter(~held_out(doc_id))
    counts = corpus_counts(training, text, head_words)
    head = SharedHead(docs.sparkSession, counts)
    weights = train(training, text, counts, head)
    return _scored(docs, doc_id, text, counts, head, weights)


def _scored(docs: DataFrame, doc_id: str, text: str, counts: Counts, head: SharedHead, weights: gru.Weights) -> DataFrame:
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "lm-scores")
    shared = spark.sparkContext.broadcast(gru.to_bytes(weights))
    fields = "kind string, row bigint, n_tokens bigint, n_known bigint, base double, model double, n_tail bigint, word binary, n bigint"
    schema = StructType([docs.schema[doc_id], *StructType.fromDDL("held_out boolean").fields, *StructType.fromDDL(fields).fields])
    ends = counts.ends

    def run(batches):
        words = head.get()
        weights = gru.from_vector(np.frombuffer(shared.value, np.float32))
        log_counts = np.log10(words.counts + 1.0)
        log_counts[-1] = 0.0
        # Numbers of rows, the same if the task runs again.
        done = TaskContext.get().partitionId() * 2**32
        for block in lanes(batches, words):
            rows = block.rows.num_rows
            keys = pa.array(np.arange(done, done + rows))
            done += rows
            is_end, starts = block.places < 0, block.first[:-1]
            logs = np.where(is_end, math.log10(ends + 1), log_counts[block.places])
            known = np.where(is_end, ends > 0, block.places < len(words.words))
            in_tail = block.tokens == gru.TAIL
            add = lambda values: np.add.reduceat(values, starts)
            # Of a word in the tail the model needs its count as well; those in the head are known here.
            model = gru.score(weights, block.tokens, block.first) / math.log(10) + add(np.where(in_tail, logs, 0.0))
            nulls = lambda kind, n: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(doc_id), block.rows.column("held_out"), pa.array(["texts"] * rows), keys,
                 pa.array(np.diff(block.first)), pa.array(add(known.astype(np.int64))), pa.array(add(logs)),
                 pa.array(model), pa.array(add(in_tail.astype(np.int64))), nulls(pa.binary(), rows), nulls(pa.int64(), rows)],
                names=schema.names,
            )
            # Words that are not in the head: one row per text and word.
            coded = block.rare.dictionary_encode()
            if not len(coded):
                continue
            pairs = block.rare_owner * len(coded.dictionary) + coded.indices.to_numpy()
            pairs, times = np.unique(pairs, return_counts=True)
            for at in range(0, len(pairs), 100_000):
                own, size = pairs[at : at + 100_000], len(pairs[at : at + 100_000])
                yield pa.RecordBatch.from_arrays(
                    [nulls(block.rows.column(doc_id).type, size), nulls(pa.bool_(), size), pa.array(["rare"] * size),
                     keys.take(pa.array(own // len(coded.dictionary))), nulls(pa.int64(), size), nulls(pa.int64(), size),
                     nulls(pa.float64(), size), nulls(pa.float64(), size), nulls(pa.int64(), size),
                     coded.dictionary.take(pa.array(own % len(coded.dictionary))), pa.array(times[at : at + size])],
                    names=schema.names,
                )

    ready = docs.select(doc_id, held_out(doc_id).alias("held_out"), docs[text].alias("_text"))
    ready.mapInArrow(run, schema).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    read = spark.read.schema(schema).parquet(path)
    rare = read.filter("kind = 'rare'").select("row", "word", "n").join(
        counts.words.select("word", F.col("n").alias("count")), "word"
    )
    of_text = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("count") + F.lit(1.0))).alias("rare_logs"), F.sum("n").alias("rare_known")
    )
    unseen = math.log10(counts.tokens + counts.distinct + 1)
    in_model = [n for _, n in counts.head[: gru.WORDS]]
    tail_tokens = counts.tokens - counts.ends - sum(in_model)
    tail_unseen = math.log10(tail_tokens + max(counts.distinct - len(in_model), 0) + 1)
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return (
        read.filter("kind = 'texts'")
        .join(of_text, "row", "left")
        .select(
            F.col(doc_id), "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + rare_logs - F.col("n_tokens") * unseen).alias("base_score"),
            (F.col("model") + rare_logs - F.col("n_tail") * tail_unseen).alias("score"),
        )
    )
