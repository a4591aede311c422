from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from tests.conftest import TESTDATA

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

ODD_TEXTS = [
    None, "", " ", " \t\n ", "a", "A", "Ab c", "ab C", "two words", "one two three", "one two three four",
    "ONE two three four", "The quick brown fox jumps over the lazy dog. " * 30,
    "The quick brown fox jumps over the lazy dog. " * 30, "the QUICK brown fox jumps over the lazy dog. " * 30,
    "Éa é ß ñ ÉA", "éa é ß ñ éa", "漢字かな交じり文です。これは日本語の文章です。", "x" * 5000, "ab" * 3000 + " tail",
    "word " * 20000, "the the the the the the", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here',
    "<|endoftext|> and <|ENDOFTEXT|>", "1234567890123456 12345", "!!! ??? ***", "\x00 control \x1c\x1f sep",
    "é combining", "a b c", "don't I'LL we're",
]


@pytest.fixture(scope="session")
def odd_documents(spark, tmp_path_factory):
    """Nulls in every column, empty and long texts, equal texts, repeated rows, clashing extra columns."""
    rows = [(k, text, ("en", "fr", None)[k % 3], ("s0", None, "s1")[k % 3], len(text or "")) for k, text in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", None, None, None), (None, "no id", None, None, None), (None, None, None, None, None)]
    rows += [rows[12]] * 3 + [(7, "another text of an id", "en", "s0", 1)]
    extra = ["row", "score", "digit", "rest", "bucket", "ids", "found", "text_of_slice", "Fingerprint"]
    schema = T.StructType([*DOCUMENTS.fields, *(T.StructField(name, T.StringType()) for name in extra)])
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame([row + ("x",) * len(extra) for row in rows], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_documents(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCUMENTS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{TESTDATA}/{os.environ.get('LLM_SCALE', 'sf0.001')}/documents.parquet")


@pytest.fixture(scope="session")
def scale_dir():
    return f"{TESTDATA}/{os.environ.get('LLM_SCALE', 'sf0.001')}"
