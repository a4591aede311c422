"""Batch table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loanrisk.sources.schemas import conform


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a parquet table under its declared schema, without a schema-inference job."""
    return conform(spark.read.schema(schema).parquet(path), schema)


def read_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """Read a catalog table under its declared schema."""
    return conform(spark.table(name), schema)
