"""Ranked search against brute force, and the sharing of partial sums against plain sums."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import FOLDER, documents, odd, table  # noqa: F401

from kindred.llm import ranked_search


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top):
    """Sorted ``(item_id, rank, doc_id, score)`` from pairs of ids and texts."""
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [(doc_id, counts) for doc_id, counts in held if counts]
    total = sum(sum(counts.values()) for _, counts in held)
    df = Counter(term for _, counts in held for term in counts)
    weight = {term: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * n + 1))) for term, n in df.items()}
    rows = []
    for item_id, text in items:
        found = []
        for doc_id, counts in held:
            m = 50 + 50 * sum(counts.values()) * len(held) // total
            score = sum(weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 20 * m)) for t in set(terms(text)) if t in counts)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = sorted(found, key=lambda row: row[:3])[:top]
        rows += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(best, 1)]
    return sorted(rows, key=repr)


def found(table):
    return sorted((tuple(row) for row in table.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(table, key):
    return [(row[key], row["text"]) for row in table.collect()]


sets = st.lists(st.sets(st.integers(0, 30), max_size=12), min_size=1, max_size=12)


@settings(max_examples=60, deadline=None)
@given(sets, st.integers(0, 2**32))
def test_shared_sums_are_plain_sums(queries, seed):
    queries = [sorted(query) for query in queries]
    plan = ranked_search.share(queries, 31)
    values = np.random.default_rng(seed).integers(0, 1000, (31, 5))
    room = np.zeros((plan.sums, 5), np.int64)
    room[:31] = values
    assert ranked_search.scores(plan, room).tolist() == [values[query].sum(axis=0).tolist() for query in queries]
    assert plan.additions <= sum(max(0, len(query) - 1) for query in queries)


def test_what_queries_share_is_added_up_once():
    common = list(range(20))
    plan = ranked_search.share([common + [20 + i] for i in range(10)], 30)
    # Nineteen additions for the shared set, and one for each query.
    assert plan.additions == 19 + 10


@pytest.mark.parametrize("block_terms, top, room", [(200_000, 50, 48_000_000), (40, 3, 40_000)])
def test_ranks_are_those_of_brute_force(spark, documents, odd, table, monkeypatch, block_terms, top, room):
    # The second case has many blocks of queries, and few documents at a time.
    monkeypatch.setattr(ranked_search, "ACCUMULATOR_BYTES", room)
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text")
    more = [(900, "the of and THE"), (900, "the of and"), (901, None), (902, ""), (903, "... --"), (None, "word é"), (904, "never-there-at-all qqqqq"), (905, "word " * 5)]
    items = benchmark.unionByName(spark.createDataFrame(more, "item_id long, text string"))
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).repartition(5)
    want = brute(pairs(docs, "doc_id"), pairs(items, "item_id"), top)
    assert found(ranked_search.search(docs, items, top=top, block_terms=block_terms)) == want


def test_ties_nulls_and_repeated_rows(table, spark):
    rows = [(i, "same words here") for i in (5, 3, None, 9, 3, None)] + [(1, "words " * 200_000), (2, None), (4, "other")]
    items = spark.createDataFrame([(1, "words", 7), (2, "same OTHER", 7)], "item_id long, text string, score long")
    for top in (4, 50):
        assert found(ranked_search.search(table(rows), items, top=top)) == brute(rows, [(1, "words"), (2, "same OTHER")], top)


def test_ids_that_are_text(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "name string, text string")
    items = spark.createDataFrame([("i", "x")], "item string, text string")
    rows = ranked_search.search(docs, items, "name", "text", "item", "text").collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, "a"), (2, "b"), (3, None)]


def test_long_documents_do_not_overflow():
    many = np.array([1, 10, 4 * 10**9], np.int64)
    assert ranked_search.lengths(many, 10**9, 10**12).tolist() == [50 + 50 * int(n) * 10**9 // 10**12 for n in many]


def test_empty_tables(documents, odd, spark):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert found(ranked_search.search(odd.limit(0), benchmark)) == []
    assert found(ranked_search.search(documents, benchmark.limit(0))) == []
    assert found(ranked_search.search(odd.filter("text IS NULL"), benchmark)) == []
