"""License scan, quality rules, sharding, BPE and token counts against brute force."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents, odd, table  # noqa: F401

from kindred.llm import bpe, license_scan, quality_rules, queries, sharding, token_counts

FOLDER = "/root/testdata/sf0.001"

LETTER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


# License scan


def brute_base(text):
    words = LETTER_WORDS.findall(lower(text))
    places = [
        (i, label)
        for phrase, label in license_scan.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_base_places_are_those_of_brute_force(documents, table):
    extra = [(900_000 + i, t) for i, t in enumerate([
        "MIT License mit-license xmit license mit licenses", "the GNU  general\npublic. LICENSE apache license", "mit", "mitélicense mit é license",
        "mit mit license license",
    ])]
    docs = documents.select("doc_id", "text").unionByName(table(extra).select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in license_scan.scan(docs, ["doc_id"]).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def test_there_are_hundreds_of_signatures_and_each_has_its_keyword():
    rules = license_scan._rules()[0]
    assert len(rules) > 300
    for text, label in {
        "Licensed under the Apache License, Version 2.0": "apache-2.0",
        "GNU General Public License, version 3.": "gpl-3.0",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "see https://www.mozilla.org/MPL/2.0/": "mpl-2.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
        "All rights reserved.": "proprietary",
    }.items():
        assert label in {rules[d.rule].label for d in license_scan.resolve(license_scan.detect(text.lower().encode()))}


def test_prefilter_loses_no_match(documents):
    rules = license_scan._rules()[0]
    for (text,) in documents.filter("lower(text) LIKE '%licen%'").select("text").collect():
        raw = lower(text).encode()
        every = {(m.start(), m.end(), i) for i, rule in enumerate(rules) for m in rule.pattern.finditer(raw)}
        assert every == {tuple(d) for d in license_scan.detect(raw)}


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 8), st.integers(0, 300)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_suppression(found):
    rules = license_scan._rules()[0]
    detections = list({license_scan.Detection(a, a + n, i % len(rules)) for a, n, i in found})

    def rank(d):
        return (-rules[d.rule].priority, -(d.end - d.start), d.rule, d.start)

    def suppressed(d):
        return any(
            o.start <= d.start and o.end >= d.end and rank(o) < rank(d) for o in detections if o != d
        )

    assert license_scan.resolve(detections) == sorted(d for d in detections if not suppressed(d))


def test_scan_of_odd_texts(odd):
    assert license_scan.scan(odd, ["doc_id"]).count() == odd.count()
    assert license_scan.scan(odd.limit(0), ["doc_id"]).count() == 0


# Quality rules


def brute_quality(text):
    text = text or ""
    words = SPACED_WORDS.findall(text)
    lines = [line for line in text.split("\n") if SPACED_WORDS.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_are_those_of_brute_force(documents, odd, table):
    extra = table([(10**6, "a b c a b c"), (10**6 + 1, "a a a a"), (10**6 + 2, "a a a"), (10**6 + 3, "\r\na\n a\na\n\n")])
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(extra.select("doc_id", "text"))
    rows = quality_rules.judge_with_measures(docs, ["doc_id", "text"]).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(r.text)
        base_failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert not (base_failed and r.kept)
    assert len(rows) == docs.count()


def test_order_of_rules_does_not_change_the_verdict(documents):
    verdict = lambda rules: {
        (r.doc_id, r.ok)
        for r in documents.select("doc_id", quality_rules.first_failed(rules, quality_rules.measures(documents["text"])).isNull().alias("ok")).collect()
    }
    assert verdict(quality_rules.RULES) == verdict(quality_rules.RULES[::-1])
    kept = {r.doc_id for r in quality_rules.passing(documents).collect()}
    assert kept == {i for i, ok in verdict(quality_rules.RULES) if ok}


def test_rules_with_more_rejections_per_second_go_first():
    estimate = quality_rules.Estimate
    found = [estimate(rule.name, 1.0, 0.0) for rule in quality_rules.RULES]
    found[3] = estimate(quality_rules.RULES[3].name, 2.0, 0.5)
    found[5] = estimate(quality_rules.RULES[5].name, 0.5, 0.2)
    order = quality_rules.ordered_rules(quality_rules.RULES, found)
    assert [rule.name for rule in order[:2]] == [quality_rules.RULES[5].name, quality_rules.RULES[3].name]


def test_quality_of_an_empty_table(odd):
    assert quality_rules.judge(odd.limit(0)).columns[-2:] == ["failed", "kept"]
    assert quality_rules.judge(odd.limit(0)).count() == 0


# Sharding


def brute_table(shards, size):
    def number(value):
        return int(hashlib.md5(value.encode()).hexdigest()[:15], 16)

    orders = [
        [(number(f"{s}/offset") + k * (number(f"{s}/skip") % (size - 1) + 1)) % size for k in range(size)] for s in shards
    ]
    owner, turn = {}, 0
    while len(owner) < size:
        who = turn % len(shards)
        slot = next(s for s in orders[who] if s not in owner)
        owner[slot] = who
        turn += 1
    return owner


@pytest.mark.parametrize(("names", "size"), [(["a", "b", "c"], 31), (["one"], 7), (queries.SHARDS[:5], 101)])
def test_table_is_filled_by_turns(spark, names, size):
    rows = sharding.lookup_table(spark, names, size).collect()
    assert {r.slot: r.shard_no for r in rows} == brute_table(names, size)


def test_few_slots_move_when_a_shard_leaves(spark):
    before = {r.slot: r.shard for r in sharding.lookup_table(spark, list("abcde"), 503).collect()}
    after = {r.slot: r.shard for r in sharding.lookup_table(spark, list("abcd"), 503).collect()}
    stayed = sum(before[s] == after[s] for s in before if before[s] != "e")
    assert stayed > 0.7 * sum(owner != "e" for owner in before.values())


def test_placement(odd):
    placed = sharding.place(odd, "doc_id", queries.SHARDS).collect()
    assert len(placed) == odd.count() and {r.score for r in placed} == {"s"}
    assert len({r.shard for r in placed if r.doc_id is None}) == 1
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.place(odd, "doc_id", bad)
    with pytest.raises(ValueError):
        sharding.lookup_table(odd.sparkSession, ["a"], 8)


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary(spark):
    return queries.byte_bpe(spark)


@pytest.mark.parametrize(("chunk", "overlap"), [(bpe.CHUNK, bpe.OVERLAP), (200, 16), (64, 8)])
def test_tokens_are_those_of_the_library(documents, odd, vocabulary, reference, chunk, overlap):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    found = bpe.encode(docs, ["doc_id"], vocabulary, chunk=chunk, overlap=overlap).collect()
    want = Counter((r.doc_id, tuple(reference.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found) == want


@given(st.text(alphabet="ab '\n\t 1é!", max_size=300), st.integers(5, 40))
@settings(max_examples=300, deadline=None)
def test_stitching(codec_text, chunk):
    codec = bpe.Codec({}, public_tokenizers.PATTERN)
    overlap = chunk // 3
    step, chunks, at = chunk - overlap, [], 0
    while True:
        part = codec_text[at : at + chunk]
        starts = [m.start() for m in codec.pattern.finditer(part)]
        chunks.append((part, starts))
        if at + chunk >= len(codec_text):
            break
        at += step
    assert bpe.stitch(codec, chunks, step) == codec.pieces(codec_text)


@given(st.binary(min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_both_ways_to_merge_agree(piece):
    codec = queries_codec()
    if piece not in codec.ranks:
        assert bpe._merge_long(piece, codec.ranks) == codec.merge(piece)


def queries_codec(made={}):  # noqa: B006
    if not made:
        made[0] = bpe.Codec(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    return made[0]


def test_decoding(spark, vocabulary, reference):
    rows = spark.createDataFrame([(1, reference.encode_ordinary("añb 😀")), (2, []), (3, None)], "i int, ids array<int>")
    assert [(r.i, bytes(r.decoded)) for r in bpe.decode(rows, ["i"], vocabulary).orderBy("i").collect()] == [
        (1, "añb 😀".encode()), (2, b""), (3, b""),
    ]


# Token counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_counts_by_section(documents, odd, vocabulary, reference, rule):
    docs = documents.select("doc_id", "text").filter("doc_id > 50").limit(60).unionByName(odd.select("doc_id", "text").filter("doc_id IS NOT NULL").dropDuplicates())
    listed = docs.select("doc_id", token_counts.sections("text").alias("parts"))
    found = {(r.doc_id, r.part): (r.start, r.end, r.n_tokens) for r in token_counts.count_by_part(listed, ["doc_id"], vocabulary, "parts", rule).collect()}
    by_text = {(r.doc_id, r.part): (r.start, r.end, r.n_tokens) for r in token_counts.count_by_section(docs, ["doc_id"], vocabulary, rule=rule).collect()}
    assert len(by_text) == len(found)
    for r in docs.collect():
        text = r.text or ""
        sections = [line + "\n" for line in text.split("\n")]
        sections[-1] = sections[-1][:-1]
        edges = np.cumsum([0] + [len(s.encode()) for s in sections])
        counts, at = Counter(), 0
        for token in reference.encode_ordinary(text):
            size = len(reference.decode_single_token_bytes(token))
            overlaps = [max(0, min(at + size, b) - max(at, a)) for a, b in zip(edges, edges[1:])]
            touched = [i for i, n in enumerate(overlaps) if n]
            counts[{"first": touched[0], "last": touched[-1], "most": int(np.argmax(overlaps))}[rule]] += 1
            at += size
        for i in range(len(sections)):
            assert found[r.doc_id, i] == by_text[r.doc_id, i] == (edges[i], edges[i + 1], counts[i])


def test_token_ends_of_long_texts_and_other_patterns(reference, monkeypatch):
    texts = ["word after word, it's  so\n" * 60_000, "", "x" * 1_000, "a b"]
    other = bpe.Codec(queries_codec().ranks, r"\w+|\W+")
    lengths = token_counts._Lengths(queries_codec())
    plain = lambda text: np.cumsum([len(reference.decode_single_token_bytes(i)) for i in reference.encode_ordinary(text)]).tolist()
    assert [ends.tolist() for ends in token_counts.token_ends(lengths, texts)] == [plain(text) for text in texts]
    monkeypatch.setattr(token_counts, "CUT", 9)
    assert [ends.tolist() for ends in token_counts.token_ends(lengths, texts[1:] + ["so it's many words\n  here"])][-1] == plain("so it's many words\n  here")
    by_pattern = token_counts.token_ends(token_counts._Lengths(other), ["a b", ""])
    assert [ends.tolist() for ends in by_pattern] == [[1, 2, 3], []]


def test_a_token_over_a_boundary_has_one_part():
    ends, parts = np.array([2, 6, 9]), np.array([3, 3, 9])
    assert [token_counts.allocate(ends, parts, rule).tolist() for rule in token_counts.RULES] == [[0, 0, 2], [0, 2, 2], [0, 2, 2]]


def test_counts_by_field(spark, vocabulary, reference):
    rows = spark.createDataFrame([(1, 1, "b c"), (1, 0, "hello"), (2, 0, None)], "conv_id int, turn int, text string")
    found = token_counts.count_by_field(rows, ["conv_id"], "turn", "text", vocabulary).collect()
    assert sum(r.n_tokens for r in found if r.conv_id == 1) == len(reference.encode_ordinary("hello\nb c"))
    assert [(r.part, r.n_tokens) for r in found if r.conv_id == 2] == [(0, 0)]


def test_tables(spark):
    assert queries.op8_token_counts(spark, FOLDER).count() > 0


def test_ranks_beyond_the_bound_are_rejected():
    bytes_ = {bytes([b]): b for b in range(256)}
    assert bpe.Codec(bytes_ | {b"ab": bpe.MAX_RANK - 1}, r".+").merge(b"abab") == (bpe.MAX_RANK - 1,) * 2
    with pytest.raises(ValueError):
        bpe.Codec(bytes_ | {b"ab": bpe.MAX_RANK}, r".+")
