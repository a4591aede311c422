"""SimHash near-duplicates by deletion-variant signatures of few segments.

Fingerprints that differ by at most four bits, cut into three segments, have a segment that differs by
at most one bit. Such a segment is found by its one-wildcard variants: each variant leaves out one
bit, and two values at most one bit apart agree in the variant of that bit. So every fingerprint is
filed under 64 keys (one per bit), rows with the same key meet, and a pair is verified on all bits.
A pair counts only under its first key, so it is verified once.

Equal fingerprints are one class from the start: copies cost one row. What can still be large is a
key shared by many different fingerprints of a crowd of near copies. Its size is known beforehand from
the counts of the segment values; a key over BLOCK rows is split into blocks, and each pair of blocks
meets in a task of its own. Within a task links are joined at once into a spanning forest, so at most
one edge per row comes out, never all pairs. Components come from rounds over those edges: a task joins
its edges into a forest, all tasks' edges of a node go to the least root, and nodes go on to their root's root.

Keys have 20 bits. The share of chance meetings is (distinct fingerprints) / 2**20 per key, checked at
a few nanoseconds each; ``segments`` and ``chosen`` make longer keys for larger corpora (5 and 2: 24
bits, 256 keys), with the same results.

Defined results: null and empty texts and texts of white space have fingerprint zero and link like any
other; fewer words than the shingle length make one shingle; a null doc_id never names a component
unless all of its ids are null; repeated rows share everything; an empty table gives an empty table.
Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from loanrisk.llm.common import arrow_pass, checkpointed, map_texts, numbered, stored, unused

SHINGLE_WORDS, MAX_BITS, SEED, BITS = 4, 4, 42, 64
SEGMENTS, CHOSEN = 3, 1
EDGE = T.StructType([T.StructField("source", T.LongType()), T.StructField("target", T.LongType())])
LABEL = T.StructType([T.StructField("node", T.LongType()), T.StructField("root", T.LongType())])
#: Shingles of a text whose bits are counted together.
SHINGLES_AT_ONCE = 1 << 15
#: Fingerprints under one key that one task may compare at once.
BLOCK = 2048
#: Edges that a task joins at once; nodes whose roots may be broadcast, at 16 bytes each, and steps up in a round then.
EDGES_AT_ONCE, BROADCAST_ROWS, STEPS = 1 << 20, 500_000, 4


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The majority, bit by bit, of the shingles' XXH64, as a signed 64-bit number."""
    words = text.lower().split()  # of bytes: A-Z, and the six white-space characters of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(words_per_shingle, len(words)) - 1  # fewer words make one shingle
    starts, ends = starts[: len(words) - last], ends[last:]
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = zip(starts[k : k + SHINGLES_AT_ONCE].tolist(), ends[k : k + SHINGLES_AT_ONCE].tolist())
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, row: str, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """row, doc_id and fingerprint (signed long) of each whole text."""
    return map_texts(
        docs, [docs[row].alias("row"), docs["doc_id"]], docs["text"],
        lambda _, texts: [pa.array([fingerprint(text, words_per_shingle) for text in texts], pa.int64())],
        [T.StructField("fingerprint", T.LongType(), False)],
    )


def key_masks(segments: int = SEGMENTS, chosen: int = CHOSEN, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(bits of the chosen segments, the wildcard bit) of each key, in the order that decides firsts."""
    # max_bits differences leave some choice with one difference at most: spread over as many
    # segments as there are, or several to a segment.
    if chosen > max(segments - max_bits + 1, 1) or segments < 2 or max_bits > 2 * segments - 1 and chosen == 1:
        raise ValueError(f"{chosen} of {segments} segments cannot find {max_bits} differing bits")
    edges = [BITS * k // segments for k in range(segments + 1)]
    bits = [sum(1 << b for b in range(low, high)) for low, high in zip(edges, edges[1:])]
    masks = [sum(bits[k] for k in choice) for choice in combinations(range(segments), chosen)]
    return [(mask, 1 << b) for mask in masks for b in range(BITS) if mask >> b & 1]


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def _keyed(classes: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """One row per fingerprint and key: key number, value without the wildcard bit."""
    kept = F.array(*(F.lit(_signed(mask & ~wildcard)) for mask, wildcard in masks))
    return classes.select("fingerprint", F.posexplode(kept).alias("key", "mask")).select(
        "fingerprint", "key", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("value")
    )


def _crowded(classes: DataFrame, masks: list[tuple[int, int]], block: int) -> DataFrame:
    """(key, value, blocks) of keys that may hold over ``block`` fingerprints.

    A key holds two segment values, with and without the wildcard bit; one of them is then over half.
    """
    segments = sorted({mask for mask, _ in masks})
    whole = F.array(*(F.lit(_signed(mask)) for mask in segments))
    wildcards = F.array(*(
        F.array(*(
            F.struct(F.lit(key).alias("key"), F.lit(_signed(~wildcard)).alias("kept"))
            for key, (mask, wildcard) in enumerate(masks) if mask == segment
        ))
        for segment in segments
    ))
    counts = (
        classes.select("fingerprint", F.posexplode(whole).alias("segment", "mask"))
        .groupBy("segment", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("whole"))
        .agg(F.count(F.lit(1)).alias("held"))
        .filter(F.col("held") > block // 2)
    )
    return (
        counts.select("whole", "held", F.explode(F.get(wildcards, F.col("segment"))).alias("cut"))
        .groupBy(F.col("cut.key").alias("key"), F.col("whole").bitwiseAND(F.col("cut.kept")).alias("value"))
        .agg(F.sum("held").alias("held"))
        .select("key", "value", F.ceil((F.col("held") + block // 2) / block).cast("int").alias("blocks"))
    )


def _spanning_edges(masks: list[tuple[int, int]], max_bits: int):
    """A function for sorted batches (key, value, pair, fingerprint) that yields linking edges."""
    kept = np.array([mask & ~wildcard for mask, wildcard in masks], dtype=np.uint64)

    def first_key(difference: np.ndarray) -> np.ndarray:
        """The first key under which a pair with these differing bits meets."""
        first = np.full(len(difference), len(masks))
        for key in range(len(masks) - 1, -1, -1):
            first[(difference & kept[key]) == 0] = key
        return first

    def edges_of(key: np.ndarray, group: np.ndarray, fingerprints: np.ndarray) -> list[pa.Array]:
        """Of whole groups: row i and row i + 1, then i + 2, ... as far as the longest group reaches."""
        rows = len(group)
        label = np.arange(rows)
        ends = np.searchsorted(group, group, side="right")
        near = np.arange(rows)
        step = 0
        while True:
            step += 1
            near = near[near + step < ends[near]]
            if not near.size:
                break
            difference = fingerprints[near] ^ fingerprints[near + step]
            close = np.flatnonzero((np.bitwise_count(difference) <= max_bits) & (label[near] != label[near + step]))
            if close.size:
                close = close[first_key(difference[close]) == key[near[close]]]
                _join(label, near[close], near[close] + step)
        joined = np.flatnonzero(label != np.arange(rows))
        ends_of = fingerprints.view(np.int64)
        return [pa.array(ends_of[joined]), pa.array(ends_of[label[joined]])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        held = None
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
            key, value, pair, _ = held
            new = (key[1:] != key[:-1]) | (value[1:] != value[:-1]) | (pair[1:] != pair[:-1])
            if not new.any():
                continue
            group = np.concatenate(([0], np.cumsum(new)))
            whole = np.flatnonzero(new)[-1] + 1  # the last group may go on in the next batch
            yield edges_of(key[:whole], group[:whole], held[3][:whole].view(np.uint64))
            held = [column[whole:] for column in held]
        if held is not None and len(held[0]):
            yield edges_of(held[0], np.zeros(len(held[0]), dtype=np.int64), held[3].view(np.uint64))

    return run


def _join(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked rows the same, least label; in place."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label[:] = label[label]


def links(
    classes: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, chosen: int = CHOSEN, block: int = BLOCK
) -> DataFrame:
    """Edges (source, target) between distinct fingerprints whose components are those of all links.

    classes: stored rows of distinct fingerprints.
    """
    masks = key_masks(segments, chosen, max_bits)
    crowded = _crowded(classes, masks, block)
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meeting = (
        _keyed(classes, masks).join(crowded, ["key", "value"], "left")
        .select("key", "value", "fingerprint", F.coalesce("blocks", F.lit(1)).alias("blocks"))
        .select("*", own.alias("own"), other.alias("other"))
        # A block meets every other block; alone it meets itself.
        .filter((F.col("own") != F.col("other")) | (F.col("blocks") == 1))
        .select(
            "key", "value",
            (F.least("own", "other") * F.lit(1 << 31).cast("long") + F.greatest("own", "other")).alias("pair"),
            "fingerprint",
        )
        .repartition("key", "value", "pair")
        .sortWithinPartitions("key", "value", "pair")
    )
    return arrow_pass(meeting, _spanning_edges(masks, max_bits), EDGE).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges but the roots; root is the least node of its component."""
    edges = edges.filter("source != target").select(
        F.greatest("source", "target").alias("node"), F.least("source", "target").alias("root")
    )
    while True:
        # A task has made one edge of a node at most, so that the roots of no node are too many for an array.
        around = _forest(edges).groupBy("node").agg(F.collect_set("root").alias("roots"))
        pointed = around.select("node", F.array_min("roots").alias("least"), F.explode("roots").alias("root"))
        own = F.col("root") == F.col("least")
        edges = stored(pointed.select(
            F.when(own, F.col("node")).otherwise(F.col("root")).alias("node"), F.col("least").alias("root"),
            own.alias("own"),
        ))
        # Stored, so that the join has a shuffle on either side and a hot root can be split.
        above = edges.filter("own").select(F.col("node").alias("root"), F.col("root").alias("above"))
        few = above.count() <= BROADCAST_ROWS
        if few:
            above = F.broadcast(above)
        if edges.filter("not own").isEmpty() and edges.join(above, "root", "left_semi").isEmpty():
            return edges.select("node", "root")
        # From root to root's root. Each step takes edges away or leads to lesser nodes, until every node has
        # one edge, to a root that has none.
        for _ in range(STEPS if few else 1):
            edges = edges.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))


def _forest(edges: DataFrame) -> DataFrame:
    """(node, root) edges that join what the edges of a partition join: from each node to the least it reaches."""

    def joined(node: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, place = np.unique(np.concatenate((node, root)), return_inverse=True)
        label = np.arange(len(nodes))
        _join(label, place[: len(node)], place[len(node) :])
        below = np.flatnonzero(label != np.arange(len(nodes)))
        return nodes[below], nodes[label[below]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        forest, held, rows = (np.empty(0, dtype=np.int64),) * 2, [], 0
        for batch in batches:
            held.append([column.to_numpy() for column in batch.columns])
            rows += len(batch)
            if rows > len(forest[0]) + EDGES_AT_ONCE:
                forest, held, rows = joined(*map(np.concatenate, zip(forest, *held))), [], 0
        node, root = joined(*map(np.concatenate, zip(forest, *held)))
        yield [pa.array(node), pa.array(root)]

    return arrow_pass(edges.select("node", "root"), run, LABEL)


def near_duplicates(
    docs: DataFrame, row: str, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **layout: int
) -> DataFrame:
    """One row per document: row, doc_id, fingerprint, root (of the component), component_id."""
    prints = checkpointed(fingerprints(docs, row, words_per_shingle))
    classes = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = components(links(classes.select("fingerprint"), max_bits, **layout))
    rooted = (
        classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    )
    # Stored, so that either side of the join by root is a plain shuffle and a giant component can be split.
    rooted = checkpointed(rooted)
    names = checkpointed(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = rooted.join(names, "root")
    return prints.join(named.drop("first"), "fingerprint").select(
        "row", "doc_id", "fingerprint", "root", "component_id"
    )


def simhash_components(docs: DataFrame, **parameters: int) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    row = unused(docs, "row")
    found = near_duplicates(numbered(docs, row), row, **parameters)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, **parameters: int) -> DataFrame:
    """The rows of docs that stay: of each component the smallest doc_id, with all its columns."""
    row = unused(docs, "row")
    rows = numbered(docs, row)
    found = near_duplicates(rows, row, **parameters)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias(row)
    )
    return rows.join(kept.select(row), row, "left_semi").drop(row)
