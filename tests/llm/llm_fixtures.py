from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

FOLDER = "/root/testdata/sf0.001"

#: Texts that the operators have to bear: null, empty, blanks, one word, one byte, long words, repeats.
ODD_TEXTS = [None, "", " \n\t ", "word", "a", "x" * 5_000, "same line\n" * 40, "é" * 300, "\x00\x01 \x0b \x1f", "😀 " * 50]


@pytest.fixture(scope="session")
def table(spark):
    """Makes a table of ids and texts with a column that no operator asked for."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("text", StringType()),
        StructField("score", StringType()), StructField("kept", StringType()), StructField("class", StringType()),
    ])

    def make(rows, partitions: int = 3):
        rows = [(i, text, "s", "k", "c") for i, text in rows]
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd(table):
    """Odd texts, repeated rows and a null id."""
    rows = list(enumerate(ODD_TEXTS)) + [(3, "word"), (6, ODD_TEXTS[6]), (None, "word"), (None, None)]
    return table(rows)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
