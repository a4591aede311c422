"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it coalesces small shuffle partitions,
# splits skewed sides of shuffle joins, and drops branches whose input turns out empty.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Building a plan otherwise records the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("loanrisk")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
