"""Ranked lexical search by dense blocked matrix multiplication.

Items are short queries. The distinct terms of a block of items are its compact vocabulary. One pass
over the documents keeps, of each whole text, its length in terms and its counts of vocabulary terms;
document frequencies, the number of documents and the total length are aggregated from that. A second
pass multiplies: a tile of document impacts (documents x terms) times a tile of item weights (terms x
items), in float64 by BLAS. All numbers are integers. Terms are dealt into tiles so that no sum of a
tile can reach 2**53 (a larger single weight is cut over several tiles); every product and partial sum
is then exact, and tiles are added up as 64-bit integers.

The best of a document tile are all that reach its k-th score, ties included; only then are they ordered
by (score, document) and cut, so a tie never costs the smaller doc_id its place. A task keeps the best k
of its own documents per item, and only these are shuffled: first to salted groups, then by item.

Items beyond ``items_at_once`` are worked off in blocks, each with a vocabulary and passes of its own, so
what the tasks are sent follows the block, not the table of items.

Defined results: null texts and texts without a term count for nothing; an item without a term, or none
of whose terms occurs with a weight above zero, has no row; repeated items are ranked each; repeated
terms of an item count as often as they occur; a null doc_id ranks behind others of its score; repeated
rows rank each; empty tables give an empty table. doc_id is an integer. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanrisk.llm.common import arrow_pass, map_texts, stored

#: Of bytes: letters and digits of ASCII (A-Z lowered) and all beyond ASCII stay, the rest separates.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
TOP = 10
ITEMS_AT_ONCE = 1000
#: Sides of the tiles.
TERMS, DOCUMENTS = 2048, 512
IMPACT = 1_000_000  # tf * 10**9 over 1000 * tf and more is below this
#: What the weights of an item may add up to within a tile.
MOST_WEIGHT = (2**53 - 1) // IMPACT
SALTS = 64


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number per row), item_id, term, times: stored."""
    fields = [
        T.StructField("found", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.LongType())),
    ]

    def count(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        counted = [Counter(terms(text)) for text in texts]
        return [
            pa.array([[term.decode() for term in counts] for counts in counted], pa.list_(pa.string())),
            pa.array([list(counts.values()) for counts in counted], pa.list_(pa.int64())),
        ]

    # Numbered and stored in one job: the numbers are read, never made again.
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    counted = map_texts(numbered, ["item", "item_id"], F.col("text"), count, fields)
    pairs = F.explode(F.arrays_zip("found", "times")).alias("pair")
    return stored(counted.select("item", "item_id", pairs).select(
        "item", "item_id", F.col("pair.found").alias("term"), F.col("pair.times").alias("times")
    ))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms and the vocabulary's terms with their occurrences, of documents with a term: stored."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [
        T.StructField("n_terms", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ]

    def count(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        known = shared.value
        lengths, columns, times, ends = [], [], [], [0]
        for text in texts:
            words = terms(text)
            counts = Counter(words)
            held = [(known[term], counts[term]) for term in counts.keys() & known.keys()]
            lengths.append(len(words))
            columns += [column for column, _ in held]
            times += [count for _, count in held]
            ends.append(len(columns))
        offsets = pa.array(ends, pa.int32())
        return [
            pa.array(lengths, pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(columns, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
        ]

    counted = map_texts(docs, [F.col("doc_id").cast("long").alias("doc_id")], F.col("text"), count, fields)
    return stored(counted.filter("n_terms > 0"))


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def weight_tiles(
    weights: list[tuple[int, int, int]], most_weight: int = MOST_WEIGHT, most_terms: int = TERMS
) -> list[dict[int, list[tuple[int, int]]]]:
    """(term, item, weight) dealt into tiles {term: [(item, weight)]}; an item's weights in one tile add
    up to ``most_weight`` at most."""
    by_term: dict[int, list[tuple[int, int]]] = {}
    for term, item, value in weights:
        by_term.setdefault(term, []).append((item, value))
    tiles, tile, held = [], {}, Counter()
    left = sorted(by_term.items(), reverse=True)
    while left:
        term, of_items = left.pop()
        piece = [(item, min(value, most_weight)) for item, value in of_items]
        rest = [(item, value - most_weight) for item, value in of_items if value > most_weight]
        if tile and (len(tile) == most_terms or any(held[item] + value > most_weight for item, value in piece)):
            tiles.append(tile)
            tile, held = {}, Counter()
        tile[term] = piece
        held.update(dict(piece))
        if rest:
            tiles.append(tile)
            tile, held = {}, Counter()
            left.append((term, rest))
    return tiles + [tile] if tile else tiles


class _Best:
    """The best k documents of each item so far, in order."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, dtype=np.int64)  # what a score must reach
        self.item = np.empty(0, dtype=np.int64)
        self.score, self.order, self.doc = self.item, self.item, self.item

    def take(self, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        """scores: documents x items."""
        least = self.least
        if len(scores) > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=0)[-self.top])
        row, item = np.nonzero(scores >= least)
        if not row.size:
            return
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, scores[row, item]))
        doc, null = np.concatenate((self.doc, docs[row])), np.concatenate((self.order, nulls[row]))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        starts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        kept = rank < self.top
        self.item, self.score, self.doc, self.order = item[kept], score[kept], doc[kept], null[kept]
        full = rank == self.top - 1
        self.least[item[full]] = np.maximum(self.least[item[full]], score[full])


def _impacts(times: np.ndarray, lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    damping = 25 + 75 * lengths * n_docs // total
    return 1_000_000_000 * times // (1000 * times + 8 * damping)


def _multiply(tiles, n_items: int, n_docs: int, total: int, top: int):
    """A function that turns batches of counted documents into the task's best (item, doc_id, score)."""
    shared = tiles

    def matrices() -> list[tuple[np.ndarray, np.ndarray]]:
        made = []
        for tile in shared.value:
            matrix = np.zeros((len(tile), n_items))
            for at, of_items in enumerate(tile.values()):
                for item, value in of_items:
                    matrix[at, item] = value
            made.append((np.fromiter(tile, dtype=np.int64), matrix))
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        made = matrices()
        places = np.full(1 + max((int(terms.max()) for terms, _ in made), default=0), -1)
        best = _Best(n_items, top)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                doc_ids, lengths, term_lists, time_lists = part.columns
                nulls = doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                docs = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
                counts = np.diff(term_lists.offsets.to_numpy())
                term, times = term_lists.flatten().to_numpy(), time_lists.flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), counts)
                impact = _impacts(times, np.repeat(lengths.to_numpy(), counts), n_docs, total)
                scores = np.zeros((part.num_rows, n_items), dtype=np.int64)
                for columns, matrix in made:
                    places[columns] = np.arange(len(columns))
                    inside = term < len(places)
                    at = np.where(inside, places[np.where(inside, term, 0)], -1)
                    places[columns] = -1
                    held = at >= 0
                    # The tile holds only the terms that occur in these documents.
                    used, compact = np.unique(at[held], return_inverse=True)
                    dense = np.zeros((part.num_rows, len(used)))
                    dense[row[held], compact] = impact[held]
                    scores += (dense @ matrix[used]).astype(np.int64)
                best.take(scores, docs, nulls)
        yield [
            pa.array(best.item, pa.int32()), pa.array(best.doc, pa.int64(), mask=best.order.astype(bool)),
            pa.array(best.score, pa.int64()),
        ]

    return run


def _search_block(docs: DataFrame, found: list, top: int) -> DataFrame:
    """found: rows (item, item_id, term, times) of the block's items."""
    spark = docs.sparkSession
    items = sorted({row["item"]: row["item_id"] for row in found}.items())
    place = {item: at for at, (item, _) in enumerate(items)}
    vocabulary = {term.encode(): at for at, term in enumerate(sorted({row["term"] for row in found}))}
    counted = term_counts(docs, vocabulary)
    n_docs, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    # One number per term of the block's vocabulary.
    frequency = dict(map(tuple, counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
    weights = [
        (column, place[row["item"]], row["times"] * weight(n_docs, frequency[column]))
        for row in found
        if (column := vocabulary[row["term"].encode()]) in frequency
    ]
    tiles = spark.sparkContext.broadcast(weight_tiles([entry for entry in weights if entry[2] > 0]))
    schema = T.StructType([
        T.StructField("place", T.IntegerType()), T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ])
    multiply = _multiply(tiles, len(items), n_docs, max(total, 1), top)
    best = arrow_pass(counted.filter(F.size("terms") > 0), multiply, schema)
    ids = spark.createDataFrame([(at, item_id) for at, (_, item_id) in enumerate(items)], "place int, item_id long")
    return _ranked(best.withColumn("salt", F.spark_partition_id() % SALTS), top).join(F.broadcast(ids), "place")


def _ranked(best: DataFrame, top: int) -> DataFrame:
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salted = Window.partitionBy("place", "salt").orderBy(*order)
    fewer = best.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    of_item = Window.partitionBy("place").orderBy(*order)
    return fewer.withColumn("rank", F.row_number().over(of_item)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents."""
    found = item_terms(items)
    n_items = found.select("item").distinct().count()
    blocks = max(math.ceil(n_items / items_at_once), 1)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    ranked = reduce(DataFrame.unionByName, (
        _search_block(docs, found.filter(block == number).collect(), top) for number in range(blocks)
    ))
    return ranked.select("item_id", "rank", "doc_id", "score")
