"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk.llm import (
    bpe, exact_dedup, fingerprints, jaccard_join, langid, lexical_search, packing, quality, resampling, secret_scan,
    sharding, simhash, sql, token_counts, unigram,
)
from loanrisk.llm.common import crc_remainder, read_table

Query = Callable[[SparkSession, str], DataFrame]

BPE_FILE = "word_bpe_49k.json"
#: Only its pieces are used: the scores of this file are ranks of merges.
UNIGRAM_FILE = "piece_bpe_32k.model"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = crc_remainder(F.col("doc_id"), 3)
    scores = quality.quality_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), remainder != 1
    )
    return scores.select(
        "doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path(UNIGRAM_FILE)
    scores = unigram.learn(docs, token_counts.vocabulary_scores(path))
    return token_counts.token_counts(docs, path, scores)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    encoded = bpe.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    digested = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"), "ids"
    )
    return bpe.decode(digested, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    predicted = langid.predict(docs, language_model(docs))
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learnt from rows of remainder 1 to 4; those of remainder 1 set the temperature."""
    remainder = crc_remainder(F.col("doc_id"), 5)
    return langid.fit(docs, remainder != 0, remainder == 1)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read_table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.edited_likeness(read_table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.spelled(F.col("chosen")).alias("fingerprint"),
        fingerprints.spelled(F.col("edited_chosen")).alias("edited_fingerprint"), "near_edited", "near_next",
    )



def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_harmonic_packing": op2_harmonic_packing,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_token_counts": op4_token_counts,
        "op5_simhash_near_dedup": op5_simhash_near_dedup,
        "op6_sharding": op6_sharding,
        "op7_bpe": op7_bpe,
        "op8_language_id": op8_language_id,
        "op9_secret_scan": op9_secret_scan,
        "op10_document_fingerprints": op10_document_fingerprints,
        "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
        "op12_lexical_search": op12_lexical_search,
        "op13_importance_resampling": op13_importance_resampling,
    }


#: op3's rows in DuckDB. lower() there also folds other letters, so A-Z are translated one by one.
OP3_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS normal
  FROM documents
), g AS (
  SELECT normal, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY normal
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.normal) AS text_sha256
FROM d JOIN g USING (normal)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that DuckDB can express; the others are tested against brute force."""
    return {
        "op3_exact_dedup": OP3_SQL,
        "op11_ngram_jaccard_join": sql.JACCARD_JOIN,
        "op12_lexical_search": sql.LEXICAL_SEARCH,
        "op13_importance_resampling": sql.RESAMPLING,
    }
