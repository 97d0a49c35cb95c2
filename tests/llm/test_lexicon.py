"""The transducer lexicon against brute force, and its encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import documents, odd, table  # noqa: F401

from kindred.llm import lexicon_bpe, transducer

PATH = public_tokenizers.path("byte_bpe_50k.json")
RULES = lexicon_bpe.load_rules(PATH)
#: What word boundaries hang on: blanks and other white space, apostrophes with endings, letters, numbers, marks.
BITS = [" ", "  ", "\n", "\t", " ", "　", "\x1f", "\x85", "'", "'s", "'re", "'ll", "'ve", "'D", "’s", "a", "Z", "re", "é", "漢", "ſ", "1",
        "٣", "½", "!", "-", "_", "\u0000", "​", "́", "😀", "<|endoftext|>", "<|endo"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def least_states(words) -> int:
    """How many different sets of endings there are."""
    heads = {word[:i] for word in words for i in range(len(word) + 1)}
    endings = {frozenset(word[len(head) :] for word in words if word.startswith(head)) for head in heads}
    return len(endings)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5), min_size=1, max_size=40), st.sets(st.text("abc", min_size=1, max_size=6), max_size=60))
def test_transducer_is_minimal_and_numbers_its_words(some, more):
    words = list(some | {word.encode() for word in more})
    lexicon = transducer.compile_lexicon(words, [[i] * (i % 3) for i in range(len(words))])
    assert len(lexicon.final) == least_states(words)
    others = [word + b"a" for word in words] + [word[:-1] for word in words]
    asked = words + [word for word in others if word not in set(words)]
    numbers = transducer.word_numbers(lexicon, pa.array(asked, pa.binary()))
    assert numbers.tolist() == [sorted(words).index(word) if word in words else -1 for word in asked]
    for i, number in enumerate(numbers[: len(words)]):
        assert lexicon.ids[lexicon.offsets[number] : lexicon.offsets[number + 1]].tolist() == [i] * (i % 3)


@pytest.mark.parametrize("words", [[], [b"a"], [b"nation", b"station", b"stations", "über".encode()]])
def test_mapped_file(tmp_path, words):
    lexicon = transducer.compile_lexicon(words, [[1, 2]] * len(words))
    path = tmp_path / "lexicon"
    path.write_bytes(transducer.to_bytes(lexicon))
    mapped = transducer.open_mapped(str(path))
    assert all(np.array_equal(a, b) for a, b in zip(mapped, lexicon))
    assert transducer.word_numbers(mapped, pa.array([*sorted(words), b"other"])).tolist() == [*range(len(words)), -1]


def test_unfit_words_are_rejected():
    for words in ([b""], [b"a", b"a"]):
        with pytest.raises(ValueError):
            transducer.compile_lexicon(words, [[1]] * len(words))


@pytest.fixture(scope="module")
def encoder():
    some = [b" a", b"a", b"'s", b" aZ", b"\n"]
    return lexicon_bpe.Encoder(RULES, transducer.compile_lexicon(some, [lexicon_bpe.merge(RULES, word) for word in some]))


def test_words_are_cut_as_by_the_library(encoder, library):
    draw = random.Random(8)
    texts = ["".join(draw.choices(BITS, k=draw.randint(0, 20))) for _ in range(3_000)]
    for text, (ids, decoded) in zip(texts, encoder.encoded(texts, lexicon_bpe.Tokens)):
        assert (ids.tolist(), decoded) == expected(library, text), repr(text)


def test_all_ways_to_merge_agree():
    draw = random.Random(9)
    words = ["".join(draw.choices("aeinrst hé漢", k=draw.choice([1, 2, 5, 15, 40, 150, 700]))).encode() for _ in range(300)]
    together = lexicon_bpe.Merger(RULES).merge(words)
    assert together == [lexicon_bpe.merge(RULES, word) for word in words]
    assert together == [lexicon_bpe._merge_long(RULES, word) for word in words]


def test_very_long_texts(encoder, library, monkeypatch):
    texts = ["word after word, and don't stop  here\n" * 80_000, "x" * 300_000, " " * 700_000 + "a", "é 漢" * 200_000]
    for text, (ids, decoded) in zip(texts, encoder.encoded(texts, lexicon_bpe.Tokens)):
        assert (ids.tolist(), decoded) == expected(library, text)
    # Many cuts in one text change nothing.
    monkeypatch.setattr(lexicon_bpe, "CUT", 7)
    text = "it's a\n text of  many words<|endoftext|> , isn't it " * 30
    ((ids, decoded),) = encoder.encoded([text], lexicon_bpe.Tokens)
    assert (ids.tolist(), decoded) == expected(library, text)


@pytest.mark.parametrize("most", [50, lexicon_bpe.LEXICON_WORDS])
def test_documents_and_odd_texts(spark, documents, odd, library, most):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    vocabulary = lexicon_bpe.learn(docs, PATH, words=most)
    assert 0 < len(lexicon_bpe.frequent(lexicon_bpe.word_counts(docs, "text", []), most).collect()) <= most
    texts = docs.select("text").collect()
    want = []
    for row in texts:
        ids, decoded = expected(library, row["text"])
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((len(ids), digest(",".join(map(str, ids))), digest(decoded)))
    found = lexicon_bpe.encode(docs, ["doc_id"], vocabulary, output="digests").drop("doc_id").collect()
    assert sorted(map(tuple, found)) == sorted(want)


def test_encoding_and_decoding(spark, odd, library):
    vocabulary = lexicon_bpe.learn(odd, PATH)
    encoded = lexicon_bpe.encode(odd, ["doc_id", "text", "score", "kept"], vocabulary)
    for row in encoded.collect():
        assert (row["ids"], row["decoded"]) == expected(library, row["text"])
    again = lexicon_bpe.decode(encoded.drop("decoded"), ["doc_id", "text", "kept"], vocabulary)
    assert all(row["decoded"] == (row["text"] or "") for row in again.collect())
    # Ids whose bytes are no text of their own.
    broken = spark.createDataFrame([(1, library.encode("漢").ids[:1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    for row in lexicon_bpe.decode(broken, ["doc_id", "ids"], vocabulary).collect():
        assert row["decoded"] == library.decode(row["ids"] or [], skip_special_tokens=False)


def test_empty_table(spark, odd):
    vocabulary = lexicon_bpe.learn(odd.limit(0), PATH)
    assert lexicon_bpe.encode(odd.limit(0), ["doc_id"], vocabulary, output="digests").count() == 0
    # A lexicon of other texts, or of none, gives the same tokens.
    assert lexicon_bpe.encode(odd, ["doc_id"], vocabulary, output="digests").count() == odd.count()


def test_counts_cover_all_texts(documents):
    counts = {bytes(r["word"]): r["n"] for r in lexicon_bpe.word_counts(documents, "text", []).collect()}
    cut = lexicon_bpe.cut_words([r["text"] or "" for r in documents.select("text").collect()], lexicon_bpe.class_table())
    words, sizes = cut.words.to_pylist(), np.bincount(cut.codes)
    assert counts == {word: n for word, n in zip(words, sizes) if len(word) <= lexicon_bpe.LEXICON_BYTES}
