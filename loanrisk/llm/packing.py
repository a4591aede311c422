"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Classes are reciprocals of the capacity: class length c = capacity // j holds as many pieces to a
sequence as fit, count = capacity // c. Documents may be cut, so each is cut into pieces that have
exactly a class length: always the longest class that still fits the rest. Whole capacities come
first, short rests end quickly, as every length up to the root of the capacity is a class itself.
Sequences of a class get a fixed count of equal pieces, so only capacity - count * c ids are padding.

Every worker (a partition of the tokenised input) fills the sequences of its classes alone; a piece
of a (class, worker) goes by its rank there. What is left, fewer than count pieces of each, is pooled
over POOLED_WORKERS workers and filled the same way, what these groups leave over as many groups, and so
on until one group is left. Then fewer than count pieces remain of each class: at most the sum of all
counts, a constant (about 10,000 for 2,048) whatever the input. One task packs these by first fit
decreasing. No group of rows thus grows with a key, a length, a source or the number of workers: a
partition of the input bounds it at first, POOLED_WORKERS times count afterwards.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; equal
lengths rank by id, start and digest (what is still tied is the same row twice, which are
exchangeable); a text longer than the capacity spans sequences; an empty table gives an empty table.
Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.bpe import encoder
from loanrisk.llm.common import checkpointed, map_texts, with_package

CAPACITY, END_ID = 2048, 1
#: Workers that pool what each has left over, and groups of these that do in the next round.
POOLED_WORKERS = 256
#: The level of sequences that first fit decreasing packs; rounds of pooling end long before.
REST_LEVEL = 7

PIECE = T.StructType([
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
])


@lru_cache(maxsize=8)
def class_below(capacity: int) -> list[int]:
    """For each length from 0 to capacity, the longest class length within it."""
    classes = np.unique(capacity // np.arange(1, capacity + 1))
    lengths = np.arange(capacity + 1)
    return classes[np.maximum(np.searchsorted(classes, lengths, side="right") - 1, 0)].tolist()


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; each has a class length."""
    below = class_below(capacity)
    pieces = []
    start = 0
    while start < length:
        piece = below[min(length - start, capacity)]
        pieces.append((start, piece))
        start += piece
    return pieces


def cut_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, doc_tokens, worker, start, length, ids_crc32 and, if asked for, ids.

    ids are those of the tokenizers file at path, and end_id after them.
    """
    end = end_id.to_bytes(4, "little")

    def pieces_of(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        tokens, offsets, starts, lengths, digests, pieces = [], [0], [], [], [], []
        for ids in encoder(path).encode(texts):
            ids += end
            tokens.append(len(ids) // 4)
            for start, length in cut(len(ids) // 4, capacity):
                piece = ids[4 * start : 4 * (start + length)]
                starts.append(start)
                lengths.append(length)
                digests.append(zlib.crc32(piece))
                pieces.append(np.frombuffer(piece, "<i4") if with_ids else None)
            offsets.append(len(starts))
        rows = pa.StructArray.from_arrays(
            [
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(digests, pa.int64()), pa.array(pieces, pa.list_(pa.int32())),
            ],
            names=PIECE.names,
        )
        return [pa.array(tokens, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)]

    cut_up = map_texts(
        docs, [docs["doc_id"]], docs["text"], pieces_of,
        [T.StructField("doc_tokens", T.LongType()), T.StructField("pieces", T.ArrayType(PIECE))],
    ).withColumn("worker", F.spark_partition_id())
    columns = PIECE.names if with_ids else PIECE.names[:-1]
    return cut_up.select(
        "doc_id", "doc_tokens", "worker", F.explode("pieces").alias("piece")
    ).select("doc_id", "doc_tokens", "worker", *(f"piece.{name}" for name in columns))


def _filled(pieces: DataFrame, level: int, group: Column, capacity: int) -> DataFrame:
    """pieces with sequence_id and offset where its class and group has a full sequence for it."""
    of_group = Window.partitionBy("length", "group")
    in_order = of_group.orderBy("doc_id", "start", "ids_crc32")
    count = F.floor(F.lit(capacity) / F.col("length"))
    full = F.col("place") < F.col("held") - F.col("held") % count
    return (
        pieces.withColumn("group", group)
        .withColumn("place", (F.row_number().over(in_order) - 1).cast("long"))
        .withColumn("held", F.count(F.lit(1)).over(of_group))
        # Unique: the level, the class and the group tell apart what counts the same.
        .withColumn("sequence_id", F.when(full, _sequence_id(level, F.floor(F.col("place") / count))))
        .withColumn("offset", F.when(full, F.col("place") % count * F.col("length")))
        .drop("group", "place", "held")
    )


def _sequence_id(level: int, number: Column) -> Column:
    """level: 3 bits, class: 12 bits at most, group: 24 bits, number within: 24 bits."""
    prefix = F.lit(level).cast("long") * 4096 + F.col("length")
    return (prefix * (1 << 24) + F.col("group")) * (1 << 24) + number


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; for a bounded number of them."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    used = np.zeros(len(lengths), dtype=np.int64)
    opened = 0
    for item in np.argsort(-lengths, kind="stable"):
        fits = np.flatnonzero(used[:opened] + lengths[item] <= capacity)
        chosen = fits[0] if fits.size else opened
        opened = max(opened, chosen + 1)
        bins[item], offsets[item] = chosen, used[chosen]
        used[chosen] += lengths[item]
    return bins, offsets


def fill_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows of class lengths with worker numbers, each with a sequence_id and its offset there.

    pieces: stored rows (doc_id, start, length, ids_crc32, worker, ...), see cut_documents.
    """
    if not 1 < capacity < 4096:
        raise ValueError("capacity must be between 2 and 4095")
    columns = pieces.columns
    last = pieces.agg(F.max("worker")).first()[0] or 0
    full, left, pooled, level = [], pieces, 1, 0
    while True:
        group = F.floor(F.col("worker").cast("long") / pooled)
        filled = checkpointed(_filled(left, level, group, capacity))
        full.append(filled.filter("sequence_id is not null"))
        left = filled.filter("sequence_id is null").select(*columns)
        if pooled > last:  # all in one group
            break
        pooled, level = pooled * POOLED_WORKERS, level + 1
    if level >= REST_LEVEL:
        raise ValueError("too many workers for the bits of a sequence_id")

    out = T.StructType([
        *pieces.schema.fields,
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def pack_rest(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(rest["length"].to_numpy(), capacity)
        return rest.assign(sequence_id=bins + (REST_LEVEL << 60), offset=offsets)[out.names]

    with_package(pieces.sparkSession)
    packed = left.groupBy(F.lit(0).alias("all")).applyInPandas(pack_rest, out)
    return reduce(DataFrame.unionByName, [*full, packed])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """All pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    with_ids also gives each piece's ids, to write the sequences themselves.
    """
    pieces = checkpointed(cut_documents(docs, path, capacity, end_id, with_ids))
    return fill_sequences(pieces, capacity).drop("worker")
