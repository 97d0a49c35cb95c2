"""Near-duplicates, decontamination, WARC, models and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents, odd, table  # noqa: F401

import corpus_pipeline
from kindred import session
from kindred.llm import cnn, components, decontaminate, gru, key_filter, lm, minhash, queries, warc

FOLDER = "/root/testdata/sf0.001"
LETTER_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def spaced(text):
    return SPACED_WORDS.findall((text or "").encode().lower())


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


# Near-duplicates


def shingles(text, size):
    words = spaced(text)
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def brute_components(rows, size, percent):
    sets = [shingles(text, size) for _, text in rows]
    union = Union()
    for i, (doc_id, _) in enumerate(rows):
        union.root(doc_id)
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                union.join(doc_id, rows[j][0])
    return Counter((i, len(s), union.root(i), union.root(i) == i) for (i, _), s in zip(rows, sets))


def near_copies(seed, bases, copies, words, edits):
    draw = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{draw.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randrange(edits + 1)):
                own[draw.randrange(words)] = f"x{draw.randrange(5000)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_are_those_of_brute_force(documents, table, size, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(10_000 + i, text) for i, text in near_copies(1, 6, 12, 90, 9)]
    rows += [(20_000, "A b"), (20_001, "a B"), (20_002, "a b c"), (20_003, None), (20_004, " "), (20_005, "A b"), (20_005, "A b")]
    found = minhash.near_duplicates(table(rows), size=size, threshold=percent / 100).collect()
    assert Counter(tuple(r) for r in found) == brute_components(rows, size, percent)


def test_blocks_of_large_groups(table, monkeypatch):
    rows = near_copies(2, 1, 60, 80, 8)
    docs = table(rows)
    signed = minhash.signatures(docs, ["doc_id"], "text", 3)
    classes = signed.groupBy("class").agg(minhash.F.min("doc_id").alias("rep"), minhash.F.first("bands").alias("bands"), *[
        minhash.F.first(s).alias(s) for s in minhash._SIGNATURE])
    whole = components.components(minhash.candidate_edges(classes, 0.85))
    cut = components.components(minhash.candidate_edges(classes, 0.85, bucket_rows=7))
    same = lambda found: sorted(sorted(bytes(n) for n, r in found.rdd.map(tuple).collect() if r == root) for root in {r.root for r in found.collect()})
    assert same(whole) == same(cut)
    wanted = whole.select("root", minhash.F.col("node").alias("class")).join(classes.select("class", "rep"), "class")
    sets = minhash._sets_of(docs, wanted, "doc_id", "text", 3)
    assert same(components.components(minhash.exact_links(sets, 0.85))) == same(
        components.components(minhash.exact_links(sets, 0.85, block_shingles=300))
    )


def test_estimates_are_near_the_similarity():
    draw = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        common = draw.integers(0, 2**63, 4_000, dtype=np.uint64)
        own = draw.integers(0, 2**63, (2, int(4_000 * (1 - share) / share / 2)), dtype=np.uint64)
        low = minhash.packed(minhash.minima([np.concatenate([common, own[i]]) for i in (0, 1)]))
        assert abs(minhash.estimate(low[0], low[1]) - share) < 4 * minhash.slack(share) / 6


def test_near_duplicates_of_odd_texts(odd):
    found = minhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert all(r.kept for r in found if not r.n_shingles)
    assert {r.component_id for r in found if r.doc_id is None} == {3, None}
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=5, deadline=None)
def test_graph_components(spark, edges):
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add(r.node)
    want = defaultdict(set)
    for node in list(union.up):
        want[union.root(node)].add(node)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_one_of_each_group_stays(table):
    rows = near_copies(3, 3, 5, 100, 1) + [(50, "only one here"), (50, "only one here"), (51, None), (52, "")]
    kept = minhash.deduplicated(table(rows))
    assert kept.columns == ["doc_id", "text", "score", "kept", "class"]
    want = {i for (i, _, _, stays), n in brute_components(rows, 5, 80).items() if stays}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_rows_without_an_own_id_are_merged_by_text(table):
    near = [text for _, text in near_copies(5, 1, 8, 100, 1)]
    other, third = [text for _, text in near_copies(6, 2, 1, 100, 0)]
    rows = [(None, near[0]), (None, near[1]), (4, near[2]), (9, near[3]), (9, other), (6, other), (6, third), (6, third + " more"),
            (None, ""), (None, ""), (None, None), (3, None), (None, "w x y"), (None, "W  x y")]
    found = minhash.deduplicated(table(rows)).collect()
    assert Counter(r.doc_id for r in found) == {4: 1, 6: 2, 3: 1, None: 4}
    assert sorted(r.text for r in found if r.doc_id == 6)[0] in (other, third, third + " more")
    assert sum(r.text == other for r in found) == 1 and sum(r.text in (third, third + " more") for r in found) == 1
    assert sum(not r.text for r in found if r.doc_id is None) == 3


def test_classes_meet_only_the_text_of_their_row(table, monkeypatch):
    rows = [(i, text) for i, seed in ((None, 8), (1, 9)) for _, text in near_copies(seed, 10, 2, 60, 1)]
    met, real = [], minhash.map_blocks

    def counting(docs, keep, column, *more, **named):
        if column == "_body":
            met.append(docs.count())
        return real(docs, keep, column, *more, **named)

    monkeypatch.setattr(minhash, "map_blocks", counting)
    found = minhash.near_duplicates(table(rows), size=3, threshold=0.85).collect()
    assert Counter(r.n_shingles for r in found) == Counter(len(shingles(text, 3)) for _, text in rows)
    assert len(met) == 1 and 0 < met[0] <= len(set(rows))


# Decontamination


def brute_hits(text, items, window=10):
    words = LETTER_WORDS.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item_id, item in items:
        target = LETTER_WORDS.findall((item or "").encode().lower())
        n = min(window, len(target))
        windows = {tuple(target[i : i + n]) for i in range(len(target) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit)


@pytest.mark.parametrize("segment_bytes", [decontaminate.SEGMENT_BYTES, 20_000])
def test_hits_are_those_of_brute_force(spark, documents, odd, table, segment_bytes):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    item = items[0][1]
    items += [(900, "two words"), (901, item), (902, None), (903, ""), (904, "the the the the the the the the the the the"), (904, "other words")]
    extra = [
        (5_000, "xx two words two words"), (5_001, "the " * 30), (5_002, item + " " + item), (5_003, item[: len(item) // 2]),
        (5_004, " ".join(item.split()[3:])), (5_004, "not this one"), (5_005, "words two, TWO-words"),
    ]
    docs = documents.select("doc_id", "text").unionByName(table(extra).select("doc_id", "text")).unionByName(
        odd.select((odd.doc_id + 7_000).alias("doc_id"), "text"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = Counter(tuple(r) for r in decontaminate.contamination(docs, bench, segment_bytes=segment_bytes).drop("n_near").collect())
    assert found == Counter((r.doc_id, *brute_hits(r.text, items)) for r in docs.collect())
    assert any(r[-1] for r in found)


def test_alignments_of_one_text_are_spread_over_rows(spark, table, monkeypatch):
    monkeypatch.setattr(decontaminate, "ALIGNED_WORDS", 240)
    sizes, spread = [], decontaminate._alignment_rows
    items = [(i, "the " * (10 + i % 3) + f"end{i % 4}") for i in range(6)]
    docs = table([(1, "the " * 300), (None, "the " * 40 + "end1 " + "the " * 20), (2, "nothing")])

    def watched(named, aligned_words):
        found = spread(named, aligned_words)
        sizes.extend(sum(a["size"] for a in r.alignments) for r in found.collect())
        return found

    monkeypatch.setattr(decontaminate, "_alignment_rows", watched)
    found = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).drop("n_near").collect()
    assert Counter(tuple(r) for r in found) == Counter((r.doc_id, *brute_hits(r.text, items)) for r in docs.collect())
    assert len(sizes) > 20 and max(sizes) < 4 * 240 < sum(sizes)


def test_decontamination_of_empty_tables(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(odd, none).filter("contaminated").count() == 0
    assert decontaminate.contamination(odd.limit(0), none).count() == 0


def test_a_row_goes_only_for_its_own_text(spark, table):
    passage = " ".join(f"b{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    stay = [(None, "clean and nameless"), (None, None), (None, ""), (7, "clean"), (8, "also clean"), (8, "also clean")]
    go = [(None, passage), (None, "x " + passage), (7, passage + " y"), (9, passage), (9, passage)]
    found = decontaminate.clean(table(stay + go), bench)
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter(stay)


def test_proximity(spark, table):
    docs = table([(1, "alpha x x beta"), (2, "beta x x x x x alpha"), (3, "alpha"), (4, "Beta, alpha! gamma")])
    index = decontaminate.build_index(docs, "doc_id")
    items = decontaminate.search_terms(spark.createDataFrame([(1, "alpha beta")], "item_id long, text string"), "item_id", "text")
    near = decontaminate.proximity_matches(index, docs, "doc_id", "text", items, 3).join(index.texts, ["segment", "number"])
    assert sorted((r.key, r.word) for r in near.collect()) == [(1, 3), (4, 0)]
    again = decontaminate.contamination(docs, spark.createDataFrame([(1, "alpha beta"), (2, "beta alpha"), (3, "no alpha")], "item_id long, text string"), within=3)
    assert sorted((r.doc_id, r.n_near, r.contaminated) for r in again.collect()) == [(1, 2, False), (2, 0, False), (3, 0, False), (4, 2, True)]


def test_proximity_on_a_whole_table(spark, documents):
    docs = {r.doc_id: LETTER_WORDS.findall((r.text or "").encode().lower()) for r in documents.collect()}
    draw = random.Random(12)
    long = sorted(i for i, own in docs.items() if len(own) > 40)
    items = []
    for number in range(12):
        own = docs[draw.choice(long)]
        at = draw.randrange(len(own) - 6)
        items.append((number, b" ".join(draw.sample(own[at : at + 6], 1 + number % 3)).decode()))
    index = decontaminate.build_index(documents, "doc_id", segment_bytes=50_000)
    searched = decontaminate.search_terms(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    near = decontaminate.proximity_matches(index, documents, "doc_id", "text", searched, 5)
    found = near.join(index.texts, ["segment", "number"]).join(searched.select("item", "item_id").distinct(), "item")
    found = {(r.item_id, r.key) for r in found.collect()}
    totals = Counter(word for own in docs.values() for word in own)
    want = set()
    for number, text in items:
        terms = list(dict.fromkeys(text.encode().split()))
        anchor = min(terms, key=lambda t: (totals[t], text.encode().split().index(t)))
        for doc_id, own in docs.items():
            for i, word in enumerate(own):
                if word == anchor and set(terms) <= set(own[max(0, i - 5) : i + 6]):
                    want.add((number, doc_id))
    assert found == want and len(want) >= 12


# WARC


@given(st.binary(max_size=200), st.integers(1, 50))
@settings(max_examples=100, deadline=None)
def test_chunked_framing(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


@pytest.mark.parametrize("segment_bytes", [400, 65_536])
def test_round_trip(spark, tmp_path, segment_bytes):
    draw = random.Random(4)
    big = "".join(draw.choice("abcé\r\n<>") for _ in range(3_000))
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
            (7, "u\nv", "x" * 1_000), (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "WARC/1.1\r\n\r\n" * 200), (2, "http://b", big),
            (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"), segment_bytes=segment_bytes, chunk_bytes=100)
    found = warc.read_archives(spark, str(tmp_path / "w")).collect()
    want = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        last = max((p for p, _, h in rows if h == html and p is not None), default=None)
        revisit = len(body) >= 1_000 and page != last
        want[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == want
    for r in found:
        assert r.payload is None if r.record_type == "revisit" else hashlib.sha1(r.payload).hexdigest() == r.payload_digest


def test_lost_segments_are_noticed(spark):
    record = ("<o>", 1, "u", "response", "0" * 40, None, b"x")
    rows = spark.createDataFrame(
        [(1, record[2], "response", record[4], "<o>", 1, None, b"x"), (1, "u", "continuation", record[4], "<o>", 3, 9, b"y")],
        "page_id long, url string, record_type string, payload_digest string, origin string, segment int, total long, block binary",
    )
    with pytest.raises(Exception, match="segments"):
        warc._reassembled(rows, ["page_id", "payload"]).collect()


def test_empty_archive(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


# Language model


@pytest.mark.parametrize("head_words", [lm.HEAD_WORDS, 50])
def test_base_scores_are_those_of_brute_force(documents, odd, head_words):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = docs.collect()
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter()
    for r in rows:
        if not fold(r.doc_id):
            counts.update([*spaced(r.text), None])
    total, kinds = sum(counts.values()), len(counts)

    def brute(r):
        tokens = [*spaced(r.text), None]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        return r.doc_id, fold(r.doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)

    found = lm.score(docs, head_words=head_words).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in found) == Counter(map(brute, rows))
    held = [r for r in found if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_score_of_a_text_does_not_depend_on_its_company():
    weights = gru.initial(np.arange(gru.TAIL + 1))
    draw = np.random.default_rng(2)
    texts = [np.append(draw.integers(0, gru.TAIL + 1, n), gru.END).astype(np.int32) for n in (0, 3, 150, 700, 40)]
    texts = [np.where(t[:-1] == gru.END, 0, t[:-1]).tolist() + [gru.END] for t in texts]
    first = np.cumsum([0, *map(len, texts)])
    together = gru.score(weights, np.concatenate(texts).astype(np.int32), first)
    alone = [gru.score(weights, np.array(t, np.int32), np.array([0, len(t)]), steps=10)[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-4)


def test_probabilities_of_all_tokens_add_up_to_one():
    weights = gru.initial(np.arange(gru.TAIL + 1))
    state = np.random.default_rng(1).normal(0, 1, (1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.TAIL + 1)
    logs, _ = gru.output(weights, np.repeat(state, len(every), axis=0), every, learn=False)
    assert math.isclose(np.exp(logs.astype(float)).sum(), 1, rel_tol=1e-4)


def test_gradients_are_those_of_small_steps():
    weights = gru.initial(np.full(gru.TAIL + 1, 3.0))
    draw = np.random.default_rng(5)
    inputs, targets = draw.integers(0, gru.TAIL + 1, (2, 6, 4)).astype(np.int32)
    inputs[3, 1] = gru.END

    def loss(w):
        cells = gru.Cells(w, inputs, np.zeros((4, gru.HIDDEN), np.float32))
        logs, grads = gru.output(w, cells.after.reshape(-1, gru.HIDDEN), targets.ravel(), learn=True)
        return -float(logs.astype(np.float64).sum()), grads | cells.gradients(w, grads.pop("state").reshape(cells.after.shape))

    _, grads = loss(weights)
    for name in gru.SHAPES:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        moved = {k: v.copy() for k, v in weights.items()}
        moved[name][at] += 1e-2
        up = loss(moved)[0]
        moved[name][at] -= 2e-2
        assert math.isclose((up - loss(moved)[0]) / 2e-2, grads[name][at], rel_tol=0.05)


def test_weights_are_averaged_by_tokens(spark):
    size = sum(int(np.prod(shape)) for shape in gru.SHAPES.values())
    rows = [(part, tokens, bytearray(np.full(size, value * tokens).tobytes())) for part, tokens, value in
            [(0, 10, 1.0), (3, 30, 2.0), (4, 0, 9.0), (9, 60, 3.0)]]
    found = lm._averaged(spark.createDataFrame(rows, lm._SUMS).repartition(3))
    assert np.allclose(found["u"], 2.5) and found["x"].shape == gru.SHAPES["x"]
    assert lm._averaged(spark.createDataFrame([], lm._SUMS)) is None


def test_counts_of_words_over_blocks(spark, table, documents):
    docs = documents.select("doc_id", "text").unionByName(table([(1, "a b a"), (2, None), (3, "B")]).select("doc_id", "text"))
    want = Counter(word for r in docs.collect() for word in spaced(r.text))
    assert {bytes(r.word): r.n for r in lm.count_words(docs, "text").collect()} == dict(want)


def test_language_model_of_an_empty_table(odd):
    assert lm.score(odd.limit(0)).count() == 0


# Quality classifier


def test_held_out_accuracy(spark):
    found = queries.op10_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9


def test_chunks_cover_the_whole_text():
    for size in (0, 1, 511, 512, 513, 896, 897, 5_000):
        data = np.arange(size, dtype=np.int64).astype(np.uint8)
        chunks, filled, first = cnn.chunks_of(data, np.array([0, size]))
        seen = np.zeros(size, bool)
        for k, chunk in enumerate(chunks):
            part = data[k * cnn.STRIDE : k * cnn.STRIDE + cnn.CHUNK]
            assert (chunk[: len(part)] == part).all() and (chunk[len(part) :] == cnn.NONE).all()
            assert math.isclose(filled[k], len(part) / cnn.CHUNK, abs_tol=1e-6)
            seen[k * cnn.STRIDE : k * cnn.STRIDE + cnn.CHUNK] = True
        assert seen.all() and first.tolist() == [0, len(chunks)]


def test_filters_look_at_every_byte():
    weights = cnn.initial()
    weights["filters"][:] = 0
    weights["bytes"][1:] = 0
    weights["bytes"][65] = 1
    weights["filters"][: 10 * cnn.EMBEDDING, 0] = 1
    found = []
    for at in (*range(100, 108), 502):
        data = np.zeros(cnn.CHUNK, np.uint8) + 66
        data[at : at + 10] = 65
        chunks = cnn.chunks_of(data, np.array([0, cnn.CHUNK]))[0]
        values, places = cnn.pooled(weights, chunks)
        assert cnn._COLUMNS[places[0, 0]].tolist() == list(range(at, at + 10))
        found.append(values[0, 0])
    assert len(set(found)) == 1 and set(cnn._COLUMNS.ravel()) == set(range(cnn.CHUNK))


def test_classifier_gradients_are_those_of_small_steps():
    weights = cnn.initial()
    weights["last"] += 0.3
    draw = np.random.default_rng(0)
    chunks = draw.integers(0, 256, (3, cnn.CHUNK)).astype(np.int16)
    args = (chunks, np.ones(3, np.float32), np.array([1, 2]), np.array([1, 0], np.float32))

    def loss(w):
        data = [cnn.hidden(w, cnn.pooled(w, chunks)[0], args[1])[1]]
        means = np.stack([data[0][0], data[0][1:].mean(axis=0)])
        p = 1 / (1 + np.exp(-(means @ w["last"] + w["last_level"]).astype(np.float64)))
        return -np.mean(args[3] * np.log(p) + (1 - args[3]) * np.log(1 - p))

    grads = cnn._gradients(weights, *args)
    for name in weights:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        moved = {k: v.copy() for k, v in weights.items()}
        moved[name][at] += 1e-3
        up = loss(moved)
        moved[name][at] -= 2e-3
        assert math.isclose((up - loss(moved)) / 2e-3, grads[name][at], rel_tol=0.1, abs_tol=1e-4)


def test_classifier_of_odd_texts_and_without_labels(spark, odd):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    found = cnn.classify(odd, cnn.fit(odd, none), ["doc_id"]).collect()
    assert len(found) == odd.count() and {r.score for r in found} == {0.5}
    assert cnn.passing(odd, cnn.initial()).columns == odd.columns
    assert cnn.classify(odd.limit(0), cnn.initial(), ["doc_id"]).count() == 0


# Pipeline


def test_stages_in_turn(spark, documents):
    docs, before = documents, None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = minhash.materialize(stage(spark, docs, FOLDER), name)
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and (before is None or set(ids) <= before)
        if i < 4:
            assert docs.columns == documents.columns
            if i:
                assert len(ids) < len(before)
            before = set(ids)
    assert set(ids) == before
    assert all(r.n_tokens == len(r.ids) for r in docs.collect())


def test_a_run_leaves_its_result_and_nothing_else(spark, tmp_path, monkeypatch):
    setting = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, FOLDER)
    left = [path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir() if path.is_dir()]
    assert left == ["byte_bpe"] and found.count() > 0
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == setting


def test_stages_of_odd_texts(spark, odd):
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            assert out.count() <= docs.count()


CLASHES = ["_id", "_digest", "_hit", "_hit_digest", "_text", "_word", "_bits", "digest", "key", "goes", "id", "n_words", "failed", "segment"]


def test_stages_bear_columns_of_their_own_names(spark, documents):
    clashing = documents.limit(60).select("*", *[minhash.F.lit(f"own {name}").alias(name) for name in CLASHES]).cache()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing, FOLDER)
        if name != "byte_bpe":
            assert out.columns == clashing.columns
        for row in out.collect():
            assert name == "byte_bpe" or all(row[clash] == f"own {clash}" for clash in CLASHES)


def test_operators_keep_columns_of_their_own_names(spark, documents):
    from kindred.llm import bpe, quality_rules, queries

    clashing = documents.limit(20).select("*", *[minhash.F.lit(f"own {name}").alias(name) for name in CLASHES])
    encoded = bpe.encode(clashing, ["doc_id", "_text", "_id"], queries.byte_bpe(spark), output="digests").collect()
    assert len(encoded) == 20 and all(row["_text"] == "own _text" for row in encoded)
    judged = quality_rules.judge_with_measures(clashing, ["doc_id", "n_words", "_text", "failed"])
    assert judged.columns.count("n_words") == 1 and all(row["_text"] == "own _text" for row in judged.collect())


def test_what_stays_passes_no_shuffle_with_its_text(spark, documents, monkeypatch):
    """With broadcasts of unknown tables off, only rows that the key map lets through are shuffled."""
    folder = minhash.materialize(documents, "plan-docs")
    marked = folder.limit(30).select("doc_id", "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        keys = minhash.materialize(marked.select(marked.doc_id.alias("id"), minhash.F.unhex(minhash.F.md5("text")).alias("digest")), "marked")
        digest = minhash.F.unhex(minhash.F.md5(minhash.F.coalesce(folder["text"], minhash.F.lit(""))))
        map_ = key_filter.key_map(keys, "id", "digest")
        rest = key_filter.without(folder, keys, [folder["doc_id"], digest], ["id", "digest"], map_)
        assert rest.count() == folder.count() - 30
        near = key_filter.named(folder, map_, folder["doc_id"], digest)
        far = key_filter.named(folder, map_, folder["doc_id"], digest, negate=True)
        assert near.count() <= 31 and near.count() + far.count() == folder.count()
        plan = far._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
