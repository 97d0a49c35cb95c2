"""Ranked lexical search for many queries at once, with common subexpressions evaluated once.

1. Items of equal term sets are one query. Queries are taken in blocks of about ``BLOCK_TERMS`` terms; each block passes
   the documents, so nothing grows with the number of items but the number of passes.
2. One pass over the texts writes each document's length and how often the block's terms occur in it. Document
   frequencies come from that table, and the weights of the terms from these.
3. Term sets that queries share are mined: in the queries' terms, the most frequent first and those of the same queries
   together, pairs of neighbours found in two queries or more become a node, and again on what that gives, until no
   pair is shared. Nodes are partial sums; queries are sums of nodes and of terms of their own: the sharing DAG.
4. The pass over the written table holds, for some documents at a time, one accumulator per term and per node. Nodes are
   added up once, level by level, then combined into the scores of all queries. A task keeps the best of each query;
   those of all tasks meet in two steps.

Scores are whole numbers, so no order of summation changes them. Defined cases: null, empty and wordless texts have no
terms; such documents are not counted and never found, such items have no result; every row of the items is an item
and every row of the documents a document, whatever ids repeat; documents without an id come last among equals; empty
tables give an empty result. Columns of either table that are not named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kindred.llm.texts import LETTERS, map_blocks, words_of
from kindred.operators.ordering import with_start
from kindred.session import fresh_path, materialize, scratch, written

TOP = 50
#: Terms of the queries of one block, about: what the driver and every task hold of the queries.
BLOCK_TERMS = 200_000
#: Bytes of the accumulators that a task holds at a time.
ACCUMULATOR_BYTES = 48_000_000
#: Groups in which the best of all tasks meet before they meet by query.
FIRST_STEP = 64


class Plan(NamedTuple):
    """The sharing DAG: sums 0 to ``terms - 1`` are the terms, the following ones nodes. ``levels`` has for each level
    its nodes and the two sums of each; query ``i`` adds up ``parts[first[i]:first[i + 1]]``."""

    terms: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    parts: np.ndarray
    first: np.ndarray

    @property
    def sums(self) -> int:
        return self.terms + sum(len(nodes) for nodes, _, _ in self.levels)

    @property
    def additions(self) -> int:
        """How many accumulators are added to another for all queries."""
        return self.sums - self.terms + len(self.parts) - (len(self.first) - 1)


def share(queries: list[list[int]], terms: int) -> Plan:
    """Mine the term sets that queries (lists of distinct term numbers) share."""
    users: list[list[int]] = [[] for _ in range(terms)]
    for number, query in enumerate(queries):
        for term in query:
            users[term].append(number)
    # Frequent terms first; terms of the same queries are neighbours.
    place = sorted(range(terms), key=lambda term: (-len(users[term]), users[term], term))
    order = {term: i for i, term in enumerate(place)}
    open_ = [sorted(query, key=order.__getitem__) for query in queries]
    level = [0] * terms
    nodes: list[tuple[int, int, int]] = []
    while True:
        pairs = Counter(pair for sums in open_ for pair in zip(sums, sums[1:]))
        chosen: dict[tuple[int, int], int] = {}
        taken = []
        for sums in open_:
            at, cuts = 0, []
            while at < len(sums) - 1:
                here = pairs[sums[at], sums[at + 1]]
                after = pairs[sums[at + 1], sums[at + 2]] if at + 2 < len(sums) else 0
                if here > 1 and here >= after:
                    cuts.append(at)
                    at += 2
                else:
                    at += 1
            taken.append(cuts)
        used = Counter((sums[at], sums[at + 1]) for sums, cuts in zip(open_, taken) for at in cuts)
        for pair, times in used.items():
            if times > 1:
                chosen[pair] = terms + len(nodes)
                nodes.append((chosen[pair], *pair))
                level.append(1 + max(level[pair[0]], level[pair[1]]))
        if not chosen:
            break
        for number, (sums, cuts) in enumerate(zip(open_, taken)):
            joined, at, gone = [], 0, set(cuts)
            while at < len(sums):
                node = chosen.get((sums[at], sums[at + 1])) if at in gone else None
                joined.append(sums[at] if node is None else node)
                at += 1 if node is None else 2
            open_[number] = joined
    by_level: dict[int, list[tuple[int, int, int]]] = {}
    for node in nodes:
        by_level.setdefault(level[node[0]], []).append(node)
    levels = [tuple(np.array(side) for side in zip(*by_level[i])) for i in sorted(by_level)]
    first = np.concatenate([[0], np.cumsum([len(sums) for sums in open_])]).astype(np.int64)
    return Plan(terms, levels, np.array([x for sums in open_ for x in sums], np.int64), first)


def scores(plan: Plan, accumulators: np.ndarray) -> np.ndarray:
    """Scores by query and document from ``accumulators`` by sum and document, whose first ``terms`` rows are filled."""
    for nodes, left, right in plan.levels:
        accumulators[nodes] = accumulators[left] + accumulators[right]
    found = np.zeros((len(plan.first) - 1, accumulators.shape[1]), np.int64)
    full = np.flatnonzero(np.diff(plan.first))
    if len(full):
        step = max(1, 4_000_000 // max(1, accumulators.shape[1]))
        # Some queries at a time, so that their parts laid side by side stay small.
        bounds = [full[0]]
        for query in full:
            if plan.first[query + 1] - plan.first[bounds[-1]] > step and query != bounds[-1]:
                bounds.append(query)
        for begin, end in zip(bounds, [*bounds[1:], len(plan.first) - 1]):
            own = full[(full >= begin) & (full < end)]
            parts = accumulators[plan.parts[plan.first[begin] : plan.first[end]]]
            found[own] = np.add.reduceat(parts, plan.first[own] - plan.first[begin], axis=0)
    return found


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, sorted: runs of letters, digits and what is outside ASCII; A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_sort(F.array_distinct(F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")))


def query_blocks(items: DataFrame, item_id: str, text: str, block_terms: int) -> tuple[DataFrame, DataFrame]:
    """``(item_id, query)`` of all items with terms, and ``(query, block, terms)`` of the distinct queries."""
    listed = items.select(F.col(item_id).alias("item_id"), terms_of(items[text]).alias("terms")).filter(F.size("terms") > 0)
    listed = materialize(listed.withColumn("query", F.sha2(F.array_join("terms", " "), 256)), "item-terms")
    distinct = listed.groupBy("query").agg(F.first("terms").alias("terms")).withColumn("_size", F.size("terms"))
    placed = with_start(distinct, ["query"], "_start", "_size")
    queries = placed.select("query", F.floor(F.col("_start") / block_terms).cast("int").alias("block"), "terms")
    return listed.select("item_id", "query"), materialize(queries, "queries")


def occurrences(docs: DataFrame, doc_id: str, text: str, vocabulary) -> DataFrame:
    """``(doc_id, n, terms, counts)`` of every document with words: its words, and which terms of the broadcast sorted
    vocabulary it has how often."""

    def work(block: pa.RecordBatch) -> list[pa.Array]:
        words = words_of(block.column("_text"), LETTERS)
        coded = words.values.dictionary_encode()
        known = vocabulary.value
        numbers = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy().astype(np.int64)
        own = numbers[coded.indices.to_numpy()]
        owner = words.owner()
        pairs, counts = np.unique(owner[own >= 0] * len(known) + own[own >= 0], return_counts=True)
        rows, terms = np.divmod(pairs, max(1, len(known)))
        offsets = pa.array(np.searchsorted(rows, np.arange(block.num_rows + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (terms, counts)]
        return [pa.array(np.diff(words.first).astype(np.int64)), *lists]

    found = map_blocks(docs, [doc_id], text, "_n bigint, _terms array<int>, _counts array<int>", work)
    return found.filter("_n > 0")


def weights(frequencies: dict[int, int], documents: int, terms: int) -> np.ndarray:
    """The weight of each term by the number of documents that have it."""
    found = np.zeros(terms, np.int64)
    for term, df in frequencies.items():
        found[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    return found


def lengths(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """The length part ``m`` of each document, from its words and those of all documents."""
    if len(n) and int(n.max()) > (2**63 - 1) // (50 * documents):
        return np.array([50 + 50 * int(x) * documents // words for x in n], np.int64)
    return 50 + 50 * n.astype(np.int64) * documents // words


class _Best:
    """The best documents of each query so far."""

    def __init__(self, queries: int, top: int, kind: pa.DataType):
        self.top = top
        self.least = np.ones(queries, np.int64)
        self.rows = pa.table([pa.array([], pa.int32()), pa.array([], pa.int64()), pa.array([], kind)], names=["query", "score", "id"])

    def add(self, found: np.ndarray, ids: pa.Array) -> None:
        query, column = np.nonzero(found >= self.least[:, None])
        if not len(query):
            return
        new = pa.table([pa.array(query.astype(np.int32)), pa.array(found[query, column]), ids.take(pa.array(column))], names=["query", "score", "id"])
        rows = pa.concat_tables([self.rows, new]).combine_chunks()
        order = pc.sort_indices(rows, [("query", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end")
        rows = rows.take(order)
        queries = rows["query"].to_numpy()
        rank = np.arange(len(queries)) - np.searchsorted(queries, queries, side="left")
        self.rows = rows.filter(pa.array(rank < self.top))
        last = rows.filter(pa.array(rank == self.top - 1))
        # Equals of the last one may still come before it by their ids.
        self.least[last["query"].to_numpy()] = last["score"].to_numpy()


def block_best(found: DataFrame, doc_id: str, plan, top: int) -> DataFrame:
    """``(query, score, id)``: the best documents of each task for each query of a block; ``query`` is its number.

    ``plan`` is a broadcast of ``(Plan, weights, documents, words)``.
    """
    schema = StructType([*StructType.fromDDL("query int, score bigint").fields, StructField("id", found.schema[doc_id].dataType)])

    def run(batches):
        dag, weight, documents, words = plan.value
        step = max(1, ACCUMULATOR_BYTES // (8 * max(1, dag.sums)))
        best = None
        for batch in batches:
            if best is None:
                best = _Best(len(dag.first) - 1, top, batch.column(0).type)
            m = lengths(batch.column(1).to_numpy(), documents, words)
            offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
            terms, counts = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            offsets = offsets - offsets[0]
            for at in range(0, batch.num_rows, step):
                end = min(at + step, batch.num_rows)
                own = slice(offsets[at], offsets[end])
                owner = np.repeat(np.arange(end - at), np.diff(offsets[at : end + 1]))
                tf = counts[own].astype(np.int64)
                accumulators = np.zeros((dag.sums, end - at), np.int64)
                accumulators[terms[own], owner] = weight[terms[own]] * (1_000_000_000 * tf // (1_000 * tf + 20 * m[at:end][owner]))
                best.add(scores(dag, accumulators), batch.column(0).slice(at, end - at))
        if best is not None:
            yield from best.rows.rename_columns(schema.names).to_batches()

    return found.select(doc_id, "_n", "_terms", "_counts").mapInArrow(run, schema)


def _first(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item with a score above 0, equals by id."""
    spark = docs.sparkSession
    path = fresh_path(spark, "ranked")
    with scratch(spark):
        named, queries = query_blocks(items, item_id, item_text, block_terms)
        numbers = sorted(row["block"] for row in queries.select("block").distinct().collect())
        best = [_search_block(docs, doc_id, text, queries.filter(F.col("block") == block), top) for block in numbers]
        if not best:
            empty = docs.select(F.lit("").alias("query"), F.lit(0).cast("bigint").alias("score"), docs[doc_id].alias("id"))
            best = [empty.limit(0)]
        rows = best[0]
        for more in best[1:]:
            rows = rows.unionByName(more)
        # The best of all tasks meet in groups first, as there may be very many tasks.
        grouped = rows.withColumn("_group", F.pmod(F.xxhash64("id", "score"), F.lit(FIRST_STEP)))
        ranked = _first(_first(grouped, ["query", "_group"], top).drop("rank", "_group"), ["query"], top)
        result = ranked.join(named, "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        return written(result, path)


def _search_block(docs: DataFrame, doc_id: str, text: str, queries: DataFrame, top: int) -> DataFrame:
    """``(query, score, id)`` for the queries of a block, written. The driver holds the block's terms, no more."""
    spark = docs.sparkSession
    asked = queries.select("query", "terms").orderBy("query").toArrow()
    vocabulary = pc.unique(asked["terms"].combine_chunks().flatten()).sort()
    numbered = pc.index_in(asked["terms"].combine_chunks().flatten(), value_set=vocabulary).to_numpy()
    ends = np.cumsum(pc.list_value_length(asked["terms"]).to_numpy())
    lists = [part.tolist() for part in np.split(numbered, ends[:-1])]
    known = spark.sparkContext.broadcast(vocabulary.cast(pa.binary()))
    found = materialize(occurrences(docs, doc_id, text, known), "occurrences")
    total = found.agg(F.count(F.lit(1)).alias("documents"), F.sum("_n").alias("words")).first()
    counted = found.select(F.explode("_terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    frequencies = {row["term"]: row["df"] for row in counted.collect()}
    weight = weights(frequencies, total["documents"], len(vocabulary))
    plan = spark.sparkContext.broadcast((share(lists, len(vocabulary)), weight, total["documents"], total["words"] or 0))
    names = spark.createDataFrame(pa.table({"number": pa.array(np.arange(len(lists)), pa.int32()), "name": asked["query"]}), "number int, name string")
    best = block_best(found, doc_id, plan, top)
    # One row per query of the block.
    best = best.join(F.broadcast(names), F.col("query") == F.col("number")).select(F.col("name").alias("query"), "score", "id")
    return materialize(best, "block-best")
