"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; the fractional rank (rank - offset) / (rows
of the source) spreads every source evenly over 0 to 1. The offset lies between 0 and 1 and follows from
the seed and the source, so that sources of one size, above all of few rows, do not meet at the same
fractions. Sorted by it, any run of rows holds each source in proportion, so equal cuts give shards of the
corpus's mixture and of sizes at most one apart.

No rank is taken in one task. Hashes, and then fractional ranks, spread over their cells: rows are
counted by (source, cell of the hash), and by cell of the fractional rank; running sums over the cells'
counts (bounded by their number) give each cell its first rank, and rows are ranked within cells. A
source with a third of all rows is thus spread over all its cells.

Defined results: a null source is a source of its own; a null text has no bytes; rows that are the
same in id, source, size and digest are interchangeable; an empty table gives an empty table. Columns
besides doc_id, source and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.llm.common import checkpointed

SHARDS, SEED, CELLS = 8, 20240101, 4096
#: Different offsets of sources within a step of their fractional ranks.
OFFSETS = 65_536


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, cells: int = CELLS) -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, shard, slot (from 0 in its shard)."""
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = checkpointed(
        docs.select(
            "doc_id", "source",
            (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        )
        .withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "source", "size", "text_crc32"))
        .withColumn("cell", F.pmod(F.col("shuffle"), F.lit(cells)))
    )
    # Within a source: rows of earlier cells, then the place in the cell.
    of_source = Window.partitionBy("source")
    counts = (
        rows.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("held"))
        .withColumn("before", F.sum("held").over(of_source.orderBy("cell")) - F.col("held"))
        .withColumn("of_source", F.sum("held").over(of_source))
        .select(F.col("source").alias("its_source"), F.col("cell").alias("its_cell"), "before", "of_source")
    )
    in_cell = Window.partitionBy("source", "cell").orderBy("shuffle", "doc_id", "size", "text_crc32")
    offset = (F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), "source"), F.lit(OFFSETS)) + 0.5) / OFFSETS
    ranked = (
        rows.withColumn("place", F.row_number().over(in_cell))
        .join(counts, F.col("source").eqNullSafe(F.col("its_source")) & (F.col("cell") == F.col("its_cell")))
        .withColumn("fraction", (F.col("before") + F.col("place") - offset) / F.col("of_source"))
        .select(
            "doc_id", "source", "size", "text_crc32", "shuffle", "fraction",
            F.floor(F.col("fraction") * cells).alias("slice"),
        )
    )
    # Over all sources: the same with cells of the fractional rank.
    ranked = checkpointed(ranked)
    slices = ranked.groupBy("slice").agg(F.count(F.lit(1)).alias("held"))
    everything = Window.partitionBy(F.lit(0))
    slices = (
        slices.withColumn("before", F.sum("held").over(everything.orderBy("slice")) - F.col("held"))
        .withColumn("total", F.sum("held").over(everything))
        .drop("held")
    )
    in_slice = Window.partitionBy("slice").orderBy(
        "fraction", "source", "shuffle", "doc_id", "size", "text_crc32"
    )
    position = F.col("before") + F.col("place")
    shard = (position * shards - position * shards % F.col("total")) / F.col("total")
    return (
        ranked.withColumn("place", (F.row_number().over(in_slice) - 1).cast("long"))
        .join(slices, "slice")
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", position - F.ceil(F.col("shard") * F.col("total") / shards))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
