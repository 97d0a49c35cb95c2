"""A training-data pipeline over ``documents``: each stage works on all that the one before it kept.

Documents that the quality classifier or the quality rules reject go, of every group of near-duplicates one stays,
documents that hold a passage of the benchmark go, and what is left is encoded. A stage's result is written to
the shared folder as Parquet and read back, so a lost executor costs at most a stage. What a stage writes on the way goes
with its end, its result once the next stage has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import bpe, cnn, decontaminate, minhash, quality_rules
from kindred.llm.queries import byte_bpe, read
from kindred.session import fresh_path, remove, scratch, written

#: The pipeline has operators that SQL cannot express.
ORACLE_SQL = None

#: Rows of a batch that goes to a Python worker at most: with long texts this bounds what a worker and the buffers beside
#: it hold. The setting of the session is put to it, as a stage is worked out after its function has returned; ``run``
#: sets it back.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return cnn.passing(docs, cnn.fit(docs, read(spark, sf_dir, "labels")))


def quality_rule_cascade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def byte_bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the bytes they decode to."""
    small_batches(spark)
    keep = [name for name in docs.columns if name in ("doc_id", "lang", "source", "n_chars")]
    return bpe.encode(docs, keep, byte_bpe(spark), output="both")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rule_cascade),
    ("minhash_dedup", minhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage makes of ``documents``."""
    docs, before, setting = read(spark, sf_dir, "documents"), None, spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            path = fresh_path(spark, name)
            with scratch(spark):
                docs = written(stage(spark, docs, sf_dir), path)
            if before is not None:
                remove(spark, before)
            before = path
    finally:
        spark.conf.set(BATCH_SETTING, setting)
    return docs
