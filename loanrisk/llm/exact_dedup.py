"""Exact deduplication by distributed most-significant-digit radix partitioning.

A text is the string of its length (8 bytes) and its normal bytes, with A-Z in lower case. Documents
are split by successive digits of that string: the first is the length and 64 bytes, each later one
64 times as long as all before. A round groups rows by (group, digit), counts them with map-side
aggregation, and joins count and top document back. A group of one row is done, and so is one whose
texts have ended; the rest goes on with the bytes that are left. Equal first digits imply equal
lengths, so all texts of a group end in the same round. Equality is thus decided on all bytes, with no
digest; the number of rounds is logarithmic in the longest text.

Bytes travel once for all rows and again only for rows that still share a prefix with another. No
round brings a group's rows together: copies shrink to one row per task before the count, and the
join of a hot group is one row against many, which adaptive execution splits.

Defined results: a null text counts as empty; a null doc_id ranks below all others; of rows with the
same id and text, the one last by file and place stays. Rows are told apart by these (see ``numbered``),
whatever executors come or go between two reads. An empty table gives an empty table. Columns
besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import checkpointed, map_texts, numbered, unused

FIRST_DIGIT, RADIX_GROWTH = 64, 64


def _first_digits(docs: DataFrame, row: str, full: bool) -> DataFrame:
    """row, doc_id, length and first bytes; full: also the other bytes and the output digest."""
    fields = [
        T.StructField("n_bytes", T.LongType()), T.StructField("digit", T.BinaryType()),
    ]
    if full:
        fields += [T.StructField("rest", T.BinaryType()), T.StructField("text_sha256", T.StringType())]

    def digits(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        normal = [text.lower() for text in texts]  # of bytes: A-Z only
        arrays = [
            pa.array([len(text) for text in normal], pa.int64()),
            pa.array([text[:FIRST_DIGIT] for text in normal], pa.binary()),
        ]
        if full:
            arrays.append(pa.array([text[FIRST_DIGIT:] for text in normal], pa.binary()))
            arrays.append(pa.array([hashlib.sha256(text).hexdigest() for text in normal]))
        return arrays

    return map_texts(docs, [docs[row].alias("row"), docs["doc_id"]], docs["text"], digits, fields)


def _groups(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Size and top row of each group of two rows or more; the top row also names the group.

    Stored, so that the join with the rows has a shuffle on either side and a hot group's rows can
    be split.
    """
    return checkpointed(
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("doc_id", "row")).alias("top"))
        .filter("size > 1")
    )


def exact_classes(docs: DataFrame, row: str) -> DataFrame:
    """One row per document: row, doc_id, text_sha256, keep_id, keep_row, group_size."""
    full = _first_digits(docs, row, full=True)
    groups = _groups(_first_digits(docs, row, full=False), "n_bytes", "digit")
    state = (
        full.join(groups, ["n_bytes", "digit"], "left")
        .select(
            "row", "doc_id", "text_sha256", "size", "top",
            F.when(F.col("size").isNotNull() & (F.length("rest") > 0), F.col("rest")).alias("rest"),
        )
    )
    done, known = [], FIRST_DIGIT
    while True:
        state = checkpointed(state)
        done.append(state.filter("rest is null").drop("rest"))
        left = state.filter("rest is not null")
        if left.isEmpty():
            break
        width = known * (RADIX_GROWTH - 1)
        known += width
        digit = F.substring("rest", 1, width).alias("digit")
        keyed = left.select(
            "row", "doc_id", "text_sha256", F.col("top.row").alias("group"), digit,
            F.substring("rest", width + 1, (1 << 31) - 1 - width).alias("rest"),
        )
        state = (
            keyed.join(_groups(keyed, "group", "digit"), ["group", "digit"], "left")
            .select(
                "row", "doc_id", "text_sha256", "size", "top",
                F.when(F.col("size").isNotNull() & (F.length("rest") > 0), F.col("rest")).alias("rest"),
            )
        )
    classes = done[0]
    for more in done[1:]:
        classes = classes.unionByName(more)
    top = F.coalesce(F.col("top"), F.struct("doc_id", "row"))
    return classes.select(
        "row", "doc_id", "text_sha256", top["doc_id"].alias("keep_id"), top["row"].alias("keep_row"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    row = unused(docs, "row")
    classes = exact_classes(numbered(docs, row), row)
    return classes.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    row = unused(docs, "row")
    rows = numbered(docs, row)
    kept = exact_classes(rows, row).filter("row = keep_row").select(F.col("row").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)
