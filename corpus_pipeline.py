"""A corpus from documents to packed sequences: every stage takes and returns a table.

Each stage's result is written as Parquet and read again as the next one's documents. All but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanrisk.llm import exact_dedup, langid, packing, secret_scan, simhash
from loanrisk.llm.common import read_table, shared_folder
from loanrisk.llm.queries import BPE_FILE, language_model


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language of at least even odds, go."""
    return langid.drop_unidentified(docs, language_model(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with the sequences they go to."""
    return packing.pack(docs, public_tokenizers.path(BPE_FILE))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Learnt models, bit fingerprints and tokenisation have no SQL; tests compare with brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is kept in the shared folder.

    A stage's table goes once the next one's is written whole; the last one stays, as the result reads it.
    After a failure the tables written so far remain.
    """
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4()}"
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            _remove(spark, before)
        before = path
    return docs
