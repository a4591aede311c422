"""Importance resampling towards a target distribution, by deduplicated segments.

Features are runs of one and two words, hashed into a fixed number of buckets. Separator newlines cut
texts into lines, and a line is reduced to its words. One pass writes, for every slice of documents, each
distinct line once with the documents that hold it, and of each document the pairs of words that
straddle two lines. Lines are then grouped over the corpus, so that the features of a distinct line are
hashed and counted once and multiplied by its occurrences; cross-line pairs are added separately. The
same is done with the target's texts, and the two histograms give a gain per bucket.

A document's sum of gains is put together from the sums of its lines, again one sum per distinct line.
A line that a third of all documents hold is one row per slice of 4 MB wherever it travels, and the join
that hands out its sum has a plain shuffle on either side, so adaptive execution can split it.

Drawn are the highest scores. Their ranks come from one sort by ranges of (score, doc_id, row), which no tie
can crowd, and the counts of these ranges; no task sees all rows.

Lines travel in full once; afterwards a line is named by 128 bits of its SHA-256. Gains are one number a
bucket, on the driver and in the tasks.

Defined results: a null or empty text has no features, weight 0 and is never drawn, and takes no part in
the counts; a null doc_id is hashed as empty text and ranks behind others of its score; repeated rows
count, score and rank each; an empty table gives an empty table, an empty target gains from T = 0. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import arrow_pass, slices, stored

#: Of bytes: letters and digits of ASCII (A-Z lowered), all beyond ASCII and newlines stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or c == 10 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 7, 25, 20
STEP = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("crossing", T.BinaryType()),
    T.StructField("name", T.BinaryType()), T.StructField("line", T.BinaryType()),
    T.StructField("rows", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType())),
])


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _packed(found: list[int], buckets: int) -> bytes:
    return np.array(found, dtype=_width(buckets)).tobytes()


def line_buckets(line: bytes, buckets: int = BUCKETS) -> list[int]:
    """The bucket of every word and every pair of neighbours of a line that is words and single spaces."""
    words = line.split(b" ")
    features = words + [a + b" " + b for a, b in zip(words, words[1:])]
    return [crc32(feature) % buckets for feature in features]


def segments(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A row per document (row, doc_id, n_words, crossing pairs' buckets), and a row per slice and distinct
    line (name, line, rows that hold it, times); stored, so that the numbers of rows are fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            for part, texts in slices(batch, 2):
                held: dict[bytes, dict[int, int]] = {}
                n_words, crossing = [], []
                for row, text in zip(part.column(0).to_pylist(), texts):
                    words, pairs, last = 0, [], None
                    for raw in text.translate(WORD_BYTES).split(b"\n"):
                        found = raw.split()
                        if not found:
                            continue
                        words += len(found)
                        if last is not None:
                            pairs.append(crc32(last + b" " + found[0]) % buckets)
                        last = found[-1]
                        of_line = held.setdefault(b" ".join(found), {})
                        of_line[row] = of_line.get(row, 0) + 1
                    n_words.append(words)
                    crossing.append(_packed(pairs, buckets))
                docs, lines = part.num_rows, len(held)
                yield [
                    pa.concat_arrays([part.column(0), pa.nulls(lines, pa.int64())]),
                    pa.concat_arrays([part.column(1), pa.nulls(lines, pa.int64())]),
                    pa.array(n_words + [None] * lines, pa.int64()),
                    pa.array(crossing + [None] * lines, pa.binary()),
                    pa.array([None] * docs + [hashlib.sha256(line).digest()[:16] for line in held], pa.binary()),
                    pa.array([None] * docs + list(held), pa.binary()),
                    pa.array([None] * docs + [list(of) for of in held.values()], pa.list_(pa.int64())),
                    pa.array([None] * docs + [list(of.values()) for of in held.values()], pa.list_(pa.int64())),
                ]

    source = docs.select(
        F.monotonically_increasing_id(), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return stored(arrow_pass(source, run, STEP))


def distinct_lines(parts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """name, occurrences and buckets of the features of each distinct line: hashed once, stored."""
    counted = parts.filter("line is not null").groupBy("name", "line").agg(
        F.sum(F.aggregate("times", F.lit(0).cast("long"), lambda total, count: total + count)).alias("occurrences")
    )
    schema = T.StructType([
        T.StructField("name", T.BinaryType()), T.StructField("occurrences", T.LongType()),
        T.StructField("buckets", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            for part, lines in slices(batch, 1):
                hashed = [_packed(line_buckets(line, buckets), buckets) for line in lines]
                yield [part.column(0), part.column(2), pa.array(hashed, pa.binary())]

    return stored(arrow_pass(counted, run, schema))


def _features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a column of packed ones, and how many each row has."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1])
    kind = np.dtype(_width(buckets))
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind), sizes // kind.itemsize


def _histogram(weighted: DataFrame, buckets: int) -> np.ndarray:
    """Sum over rows (times, packed buckets) of times per bucket; tasks send one number a bucket."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("held", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            found, sizes = _features(batch.column(1), buckets)
            np.add.at(counts, found, np.repeat(batch.column(0).to_numpy(), sizes))
        some = np.flatnonzero(counts)
        yield [pa.array(some, pa.int32()), pa.array(counts[some])]

    total = np.zeros(buckets, dtype=np.int64)
    for bucket, held in arrow_pass(weighted, run, schema).groupBy("bucket").agg(F.sum("held")).collect():
        total[bucket] = held
    return total


def bucket_counts(parts: DataFrame, lines: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all documents fall into each bucket."""
    inside = _histogram(lines.select("occurrences", "buckets"), buckets)
    crossing = parts.filter("crossing is not null").select(F.lit(1).cast("long"), "crossing")
    return inside + _histogram(crossing, buckets)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares in target and corpus, rounded down, per bucket."""
    buckets, total, wanted = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t + 1) * float(total + buckets)) / (float(s + 1) * float(wanted + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], dtype=np.int64)


def _gained(rows: DataFrame, packed: str, keep: list[str], gain: np.ndarray) -> DataFrame:
    """The kept columns and ``gained``, the sum of the gains of the packed buckets."""
    kept = rows.select(*keep)
    schema = T.StructType([*kept.schema.fields, T.StructField("gained", T.LongType())])
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    last = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            found, sizes = _features(batch.column(last), len(shared.value))
            sums = np.concatenate(([0], np.cumsum(shared.value[found])))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            yield [*batch.columns[:last], pa.array(sums[ends[1:]] - sums[ends[:-1]])]

    return arrow_pass(rows.select(*keep, packed), run, schema)


def weights(parts: DataFrame, lines: DataFrame, gain: np.ndarray) -> DataFrame:
    """row, doc_id, n_words, n_features and weight (the mean gain, rounded down) of each document."""
    of_docs = _gained(parts.filter("row is not null"), "crossing", ["row", "doc_id", "n_words"], gain)
    of_lines = _gained(lines, "buckets", ["name"], gain)
    held = (
        parts.filter("line is not null").select("name", "rows", "times").join(of_lines, "name")
        .select("gained", F.explode(F.arrays_zip("rows", "times")).alias("held"))
        .select(F.col("held.rows").alias("row"), (F.col("gained") * F.col("held.times")).alias("gained"))
    )
    nothing = F.lit(None).cast("long")
    # A document's own row and what its lines gained meet in one exchange.
    joined = of_docs.unionByName(held.select("row", nothing.alias("doc_id"), nothing.alias("n_words"), "gained"))
    totals = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("gained").alias("gained")
    )
    n_features = F.when(F.col("n_words") > 0, 2 * F.col("n_words") - 1).otherwise(0).cast("long")
    # div drops the fraction; what is left over goes first, so that negative means go down as well.
    mean = F.expr("(gained - pmod(gained, n_features)) div n_features")
    return totals.withColumn("n_features", n_features).select(
        "row", "doc_id", "n_words", "n_features",
        F.when(F.col("n_features") > 0, mean).otherwise(0).cast("long").alias("weight"),
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel number per id, in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def _in_order(rows: DataFrame) -> DataFrame:
    """rows with ``place``: 1, 2, 3 ... by descending score and ascending doc_id."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
    # Range and place in it are stored with the rows: read, never made again.
    dealt = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id())
        .select("*", F.shiftright("id", 33).alias("range"), F.expr("id & 8589934591").alias("inside")).drop("id")
    )
    before, offsets = 0, []
    for number, size in sorted(map(tuple, dealt.groupBy("range").count().collect())):  # one row a partition
        offsets.append((number, before))
        before += size
    starts = rows.sparkSession.createDataFrame(offsets, "range long, before long")
    return dealt.join(F.broadcast(starts), "range").withColumn("place", F.col("before") + F.col("inside") + 1)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null where not drawn).

    target: texts in a column ``text``. Drawn are ``percent`` of the documents with ``least_words``.
    """
    wanted = segments(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets)
    parts = segments(docs, buckets)
    lines = distinct_lines(parts, buckets)
    gain = gains(bucket_counts(parts, lines, buckets), bucket_counts(wanted, distinct_lines(wanted, buckets), buckets))
    scored = stored(weights(parts, lines, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    eligible = F.col("n_words") >= least_words
    drawn = scored.filter(eligible).count() * percent // 100
    placed = _in_order(scored.filter(eligible))
    rank = F.when(F.col("place") <= drawn, F.col("place")).cast("long")
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).select(*rest.columns).unionByName(rest).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
