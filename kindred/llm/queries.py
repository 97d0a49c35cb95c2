"""The operators as queries on the given tables, with production parameters and over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from kindred.llm import bpe, cnn, decontaminate, lexicon_bpe, license_scan, lm, minhash, oracle, prefix_trie, quality_rules, ranked_search, sharding, token_counts, warc
from kindred.session import fresh_path


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(read(spark, folder, "documents"), ["doc_id"]).drop("detections")


SHARDS = [f"shard-{i:02d}" for i in range(16)]


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document."""
    documents = read(spark, folder, "documents").select("doc_id")
    return sharding.place(documents, "doc_id", SHARDS).select("doc_id", "slot", "shard")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge_with_measures(read(spark, folder, "documents"), ["doc_id"])
    base_failed = F.lit(False)
    for rule in quality_rules.BASE_RULES:
        base_failed = base_failed | rule.rejects({name: F.col(name) for name in judged.columns})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "kept",
    )


def byte_bpe(spark: SparkSession) -> bpe.Vocabulary:
    return bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write every page to archives in the shared folder and read them back."""
    path = fresh_path(spark, "warc")
    warc.write_archives(read(spark, folder, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(read(spark, folder, "documents"), ["doc_id"], byte_bpe(spark), output="digests")


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"), size=3, threshold=0.85)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document, from one encoding of the document."""
    return token_counts.count_by_section(read(spark, folder, "documents"), ["doc_id"], byte_bpe(spark))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(read(spark, folder, "documents"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    weights = cnn.fit(documents, read(spark, folder, "labels"))
    scored = cnn.classify(documents, weights, ["doc_id"])
    return scored.select("doc_id", cnn.held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, folder, "conversations"))


def op12_lexicon_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    vocabulary = lexicon_bpe.learn(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return lexicon_bpe.encode(documents, ["doc_id"], vocabulary, output="digests")


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_license_scan, op2_sharding, op3_quality_rules, op4_decontamination, op5_warc, op6_byte_bpe, op7_minhash, op8_token_counts, op9_lm_scoring,
        op10_quality_classifier, op11_prefix_trie, op12_lexicon_bpe, op13_ranked_search,
    )
}
#: Where SQL has no words for an operator (patterns with suppression, models, BPE merges), tests compare it with
#: brute force, the reference tokenizer or held-out accuracy.
SQL: dict[str, str] = {
    "op2_sharding": oracle.sharding(SHARDS),
    "op3_quality_rules": oracle.QUALITY,
    "op4_decontamination": oracle.DECONTAMINATION,
    "op5_warc": oracle.WARC,
    "op7_minhash": oracle.MINHASH,
    "op11_prefix_trie": oracle.TRIE,
    "op13_ranked_search": oracle.RANKED,
}
