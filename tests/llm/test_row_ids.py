"""Rows keep their ids, and no text is lost, when the number of executors changes between two reads."""

from __future__ import annotations

import pytest
from pyspark import SparkConf
from pyspark.sql import functions as F

from loanrisk.llm import exact_dedup, simhash
from loanrisk.llm.common import numbered, shared_folder

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"
FILES, COPIES, TEXTS = 24, 4, 300


@pytest.fixture
def many_files(spark, tmp_path):
    """24 files over which four copies of 300 texts are dealt, small enough to be read several at a time."""
    words = F.transform(F.sequence(F.lit(0), F.lit(60)), lambda k: F.md5(F.concat_ws("-", F.col("id") % TEXTS, k)))
    rows = spark.range(TEXTS * COPIES).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    rows.repartition(FILES).write.parquet(str(tmp_path / "documents.parquet"))
    yield spark.read.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.unset(PARALLELISM)



def test_ids_stay(spark, many_files):
    few = numbered(many_files, "row").select("doc_id", "row")
    spark.conf.set(PARALLELISM, "3")
    before = {tuple(row) for row in few.collect()}
    spark.conf.set(PARALLELISM, "17")
    assert {tuple(row) for row in numbered(many_files, "row").select("doc_id", "row").collect()} == before
    assert len({row for _, row in before}) == TEXTS * COPIES


@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, simhash.drop_near_copies])
def test_one_row_of_each_text_stays(spark, many_files, drop):
    spark.conf.set(PARALLELISM, "3")
    kept = drop(many_files)  # the copies are found while the plan is built ...
    spark.conf.set(PARALLELISM, "17")  # ... and the rows read again with other cores
    assert kept.count() == TEXTS and kept.select("text").distinct().count() == TEXTS


def test_rows_that_are_no_files(spark, many_files):
    joined = many_files.join(many_files.select("doc_id"), "doc_id")
    assert numbered(joined, "row").select("row").distinct().count() == TEXTS * COPIES
    assert exact_dedup.drop_copies(joined).count() == TEXTS


def test_several_machines_need_a_shared_folder():
    class Elsewhere:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return SparkConf(loadDefaults=False)

    class Session:
        sparkContext = Elsewhere()

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session())
