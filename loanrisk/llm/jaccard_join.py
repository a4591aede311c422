"""N-gram Jaccard join by signature trees.

A document is the set of its distinct word shingles, as 64-bit numbers. Equal sets are one class from the
start, so copies cost one row. Two classes link when their intersection is at least PERCENT of their
union, which is always decided on the whole sets, in integers.

Where a pair may meet: a set of n shingles that links shares at least PERCENT of n with its partner, so
the first (100 - PERCENT) % of n + k of its shingles, in any order common to all sets, hold k of the
partner's first ones. k is 1 + n / COMMON_EVERY (for a pair the lesser of both), and pairs that meet in fewer
groups than that are no candidates. The order is by a fixed-size table of how often shingles occur, rare ones first, so
that passages which many documents share come last and hardly ever bring unrelated sets together. Classes
that share such a shingle form a group; a shingle of one class alone is gone after one counting.

Within a group a signature tree is built: a leaf holds a class, a node the OR of its children's bitmaps,
their range of sizes and their largest excess (shingles beyond bits). Two trees, or one and itself, are
descended together, and a pair of nodes is dropped as soon as no pair of sets below can link: sizes too
far apart, common bits plus excess too few for the overlap that is needed, or all of it linked already.

Linked already: classes next to each other by least shingle and size propose each other first, which joins
most of a crowd of near copies. Components of the links so far are then given to the groups, and those
of one component are not read at all. Each class proposes its few best partners outside of its component,
and proposals are verified; groups in which a class has more of them are taken up again with larger numbers,
on what is not yet linked. Sets travel only to verify a proposal, and are made anew from the texts for it. So the work is about linear in the members of groups, and nothing is left out: the
last round is one that had no more to propose. A group over BLOCK classes is cut into blocks, and every
pair of blocks meets in a task of its own.

Defined results: texts without words (and nulls) have the empty set and link with nothing; fewer words than
a shingle has make one; a null doc_id never names a component unless all of its ids are null; repeated rows
share everything; an empty table gives an empty table. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from loanrisk.llm.common import arrow_pass, map_texts, numbered, slices, stored, unused
from loanrisk.llm.simhash import EDGE, components

SHINGLE_WORDS, PERCENT = 4, 85
#: Counters of the table that orders shingles, and words of that which tells shared ones: 2**18, two
#: megabytes, whatever the corpus.
SKETCH_BITS = 18
BITMAP_WORDS = 16  # of 64 bits
#: One more shingle that must be shared for so many of a set.
COMMON_EVERY = 25
FANOUT = 8
#: Classes of a group that one task may hold; pairs of nodes that are looked at together.
BLOCK, PAIRS_AT_ONCE = 2048, 8192
#: Partners that a class proposes in the first round, and how that number grows.
NEAREST, MORE = 8, 64
#: Rows of a table that may be broadcast, at 40 bytes each.
BROADCAST_ROWS = 500_000
_MULTIPLIER, _FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_NOTHING = np.empty(0, dtype=np.uint64)


def shingle_set(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit numbers."""
    words = text.lower().split()  # of bytes: A-Z, and the six white-space characters of ASCII
    if not words:
        return _NOTHING
    hashes = np.array([xxh64_intdigest(word) for word in words], dtype=np.uint64)
    width = min(words_per_shingle, len(words))
    mixed = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        mixed = mixed * _MULTIPLIER + hashes[k : k + len(mixed)]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _FINISH
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def wanted_in_common(n: int) -> int:
    """How many of its rarest shingles a set of n must share with a partner's."""
    return 1 + n // COMMON_EVERY


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many of n shingles must be looked at: a partner has all but (100 - percent) % of them."""
    return min(n, n - -(-percent * n // 100) + wanted_in_common(n))


def linked(left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (len(left) + len(right) - common)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP_WORDS * 64, dtype=np.uint8)
    bits[shingles % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.uint64)


def _frequencies(docs: DataFrame, words_per_shingle: int) -> np.ndarray:
    """How many shingles of all documents fall into each counter of the table."""
    schema = T.StructType([T.StructField("counter", T.IntegerType()), T.StructField("held", T.LongType())])
    shift = np.uint64(64 - SKETCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for _, texts in slices(batch, 0):
                found = [shingle_set(text, words_per_shingle) >> shift for text in texts]
                counts += np.bincount(np.concatenate(found).astype(np.int64), minlength=len(counts))
        some = np.flatnonzero(counts)
        yield [pa.array(some, pa.int32()), pa.array(counts[some])]

    total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    counted = arrow_pass(docs.select(F.col("text").cast("string")), run, schema)
    for counter, held in counted.groupBy("counter").agg(F.sum("held")).collect():
        total[counter] = held
    return total


def _prints(rows: DataFrame, row: str, words_per_shingle: int, percent: int) -> DataFrame:
    """row, doc_id, n, a 128-bit digest of the set, its least shingle, its bitmap and its rarest ones: stored.

    Of equal sets of a slice only the first brings its bitmap and rarest shingles.
    """
    table = rows.sparkSession.sparkContext.broadcast(_frequencies(rows, words_per_shingle))
    shift = np.uint64(64 - SKETCH_BITS)
    fields = [
        T.StructField("n", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()),
        T.StructField("least", T.LongType()), T.StructField("excess", T.LongType()),
        T.StructField("bits", T.BinaryType()), T.StructField("prefix", T.ArrayType(T.LongType())),
    ]

    def prints(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        frequencies = table.value
        seen, sizes, digests, least, excess, maps, prefixes = set(), [], [], [], [], [], []
        for text in texts:
            shingles = shingle_set(text, words_per_shingle)
            digest = blake2b(shingles.tobytes(), digest_size=16).digest()
            sizes.append(len(shingles))
            digests.append(digest)
            least.append(int(shingles[:1].view(np.int64).sum()))
            if digest in seen or not len(shingles):
                for column in (excess, maps, prefixes):
                    column.append(None)
                continue
            seen.add(digest)
            bits = bitmap(shingles)
            excess.append(len(shingles) - int(np.bitwise_count(bits).sum()))
            maps.append(bits.tobytes())
            order = np.lexsort((shingles, frequencies[(shingles >> shift).astype(np.int64)]))
            prefixes.append(shingles[order[: prefix_length(len(shingles), percent)]].view(np.int64))
        halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        return [
            pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(least, pa.int64()),
            pa.array(excess, pa.int64()), pa.array(maps, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
        ]

    return stored(map_texts(rows, [rows[row].alias("row"), rows["doc_id"]], rows["text"], prints, fields))


def _meetings(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, cls) of the rare shingles that several classes share: stored.

    Which are shared is counted. Of the others nearly all are then left out where they are read, by a table
    of bits of fixed size, so that next to nothing of them is shuffled a second time.
    """
    rare = prints.filter("prefix is not null").select("lo", "prefix")
    rows = rare.select("lo", F.explode("prefix").alias("token"))
    counted = rows.groupBy("token").agg(F.min("lo").alias("least"), F.max("lo").alias("most"))
    several = stored(counted.filter("least < most").select("token"))
    word = F.col("token").bitwiseAND(F.lit((1 << SKETCH_BITS) - 1))
    bit = F.expr(f"shiftleft(1L, cast(shiftright(token, {SKETCH_BITS}) & 63 as int))")
    table = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for place, bits in several.groupBy(word.cast("int")).agg(F.bit_or(bit)).collect():
        table[place] = bits
    shared = prints.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([T.StructField("lo", T.LongType()), T.StructField("token", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bits = shared.value
        for batch in batches:
            token = batch.column(1).flatten().to_numpy()
            lo = np.repeat(batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy()))
            set_bits = bits[token & ((1 << SKETCH_BITS) - 1)] >> ((token >> SKETCH_BITS) & 63) & 1 == 1
            yield [pa.array(lo[set_bits]), pa.array(token[set_bits])]

    return stored(
        arrow_pass(rare, run, schema)
        .join(several, "token", "left_semi").join(classes.select("lo", "cls"), "lo")
        .select("token", "cls").distinct()
    )


def _few(rows: DataFrame) -> DataFrame:
    """rows, to be broadcast if a count says that they are few."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def _edges(pairs: list[tuple[int, int]]) -> list[pa.Array]:
    return [pa.array([pair[side] for pair in pairs], pa.int64()) for side in (0, 1)]


def _neighbours(classes: DataFrame, percent: int) -> DataFrame:
    """Proposals of classes next to each other by least shingle and size; stored.

    Dealt by ranges down to the class, so that no least shingle is too frequent for a task. A pair that
    is not found here, as at the end of a range, is found later.
    """
    order = ("least", "n", "cls")
    dealt = classes.select(*order, "excess", "bits").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        held = None
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            if held is not None:
                columns = [np.concatenate(both) for both in zip(held, columns)]
            held = [column[-1:] for column in columns]
            least, size, cls, excess, bits = columns
            level = _Level(least, size, size, excess, _bitmaps(bits), cls, cls)
            first = np.arange(len(cls) - 1)
            first = first[least[first] == least[first + 1]]
            kept, _ = level.may_link(first, first + 1, percent)
            yield [pa.array(cls[first[kept]]), pa.array(cls[first[kept] + 1])]

    return stored(arrow_pass(dealt, run, EDGE))


def _bitmaps(packed: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=np.uint64).reshape(-1, BITMAP_WORDS)


class _Level:
    """Nodes of one height of the trees of all groups, in the order of their children."""

    def __init__(self, group, low, high, excess, bits, first, last):
        self.group, self.low, self.high, self.excess, self.bits = group, low, high, excess, bits
        self.first, self.last = first, last  # least and greatest component below
        self.starts = self.ends = None  # children

    def parents(self) -> _Level:
        group = self.group
        opens = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        place = np.arange(len(group)) - np.repeat(opens, np.diff(np.append(opens, len(group))))
        starts = np.flatnonzero(place % FANOUT == 0)
        above = _Level(
            group[starts], np.minimum.reduceat(self.low, starts), np.maximum.reduceat(self.high, starts),
            np.maximum.reduceat(self.excess, starts), np.bitwise_or.reduceat(self.bits, starts, axis=0),
            np.minimum.reduceat(self.first, starts), np.maximum.reduceat(self.last, starts),
        )
        above.starts, above.ends = starts, np.append(starts[1:], len(group))
        return above

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most that a set below a and one below b can have in common."""
        common = np.bitwise_count(self.bits[a] & self.bits[b]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(self.excess[a], self.excess[b])
        return np.minimum(most, np.minimum(self.high[a], self.high[b]))

    def may_link(self, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of nodes may hold a link between different components, and their most overlap."""
        low_a, low_b = self.low[a], self.low[b]
        kept = np.flatnonzero(
            (100 * self.high[a] >= percent * low_b) & (100 * self.high[b] >= percent * low_a)
            & ((self.first[a] != self.last[b]) | (self.first[b] != self.last[a]))
        )
        overlap = self.overlap(a[kept], b[kept])
        enough = (100 + percent) * overlap >= percent * (low_a[kept] + low_b[kept])
        return kept[enough], overlap[enough]


def _below(level: _Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of a and a child of b; of a node with itself each pair once."""
    width_a, width_b = level.ends[a] - level.starts[a], level.ends[b] - level.starts[b]
    sizes = width_a * width_b
    pair = np.repeat(np.arange(len(a)), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = level.starts[a][pair] + inside // width_b[pair]
    right = level.starts[b][pair] + inside % width_b[pair]
    once = left <= right
    return left[once], right[once]


def tree_pairs(
    group: np.ndarray, size: np.ndarray, excess: np.ndarray, bits: np.ndarray, component: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (i, j) of sets of one group and of different components that may link, and their most overlap.

    Rows are sorted by group and size. All trees are descended side by side, pairs of nodes in portions.
    """
    levels = [_Level(group, size, size, excess, bits, component, component)]
    while (levels[-1].group[1:] == levels[-1].group[:-1]).any():
        levels.append(levels[-1].parents())
    roots = np.arange(len(levels[-1].group))
    found = []
    portions = [(len(levels) - 1, roots, roots)]
    while portions:
        height, a, b = portions.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            portions += [(height, a[half:], b[half:]), (height, a[:half], b[:half])]
            continue
        level = levels[height]
        if height == 0:
            a, b = a[a != b], b[a != b]
        kept, overlap = level.may_link(a, b, percent)
        if height == 0:
            found.append((a[kept], b[kept], overlap))
        elif kept.size:
            portions.append((height - 1, *_below(level, a[kept], b[kept])))
    return tuple(np.concatenate(column) for column in zip(*found)) if found else (_NOTHING.view(np.int64),) * 3


def nearest_pairs(
    left: np.ndarray, right: np.ndarray, likeness: np.ndarray, nearest: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are among the ``nearest`` best of either side, and which sides had more."""
    side, pair = np.concatenate((left, right)), np.tile(np.arange(len(left)), 2)
    order = np.lexsort((pair, -likeness[pair], side))
    side, pair = side[order], pair[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(side), 1), dtype=bool), side[1:] != side[:-1])))
    rank = np.arange(len(side)) - np.repeat(starts, np.diff(np.append(starts, len(side))))
    return np.unique(pair[rank < nearest]), np.unique(pair[rank >= nearest])


#: Proposals, and one row with nothing but the token for each group that has more of them.
PROPOSED = T.StructType([
    *EDGE.fields, T.StructField("wanted", T.LongType()), T.StructField("more", T.LongType())
])


def _propose(percent: int, nearest: int):
    """A function for sorted batches (token, pair, n, cls, component, excess, bits) that yields proposals."""

    def of_groups(columns: list) -> list[pa.Array]:
        token, pair, size, cls, component, excess, bits = columns
        new = (token[1:] != token[:-1]) | (pair[1:] != pair[:-1])
        group = np.concatenate(([0], np.cumsum(new)))
        left, right, overlap = tree_pairs(group, size, excess, _bitmaps(bits), component, percent)
        likeness = overlap / (size[left] + size[right])
        some, more = nearest_pairs(left, right, likeness, nearest)
        a, b = cls[left[some]], cls[right[some]]
        wanted = wanted_in_common(np.minimum(size[left[some]], size[right[some]]))
        cut = np.unique(token[left[more]])
        nothing = pa.nulls(len(cut), pa.int64())
        return [
            *(pa.concat_arrays([pa.array(found), nothing]) for found in (np.minimum(a, b), np.maximum(a, b), wanted)),
            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cut)]),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        held = None
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            held = columns if held is None else [np.concatenate(both) for both in zip(held, columns)]
            new = (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])
            if not new.any():
                continue
            whole = np.flatnonzero(new)[-1] + 1  # the last group may go on in the next batch
            yield of_groups([column[:whole] for column in held])
            held = [column[whole:] for column in held]
        if held is not None and len(held[0]):
            yield of_groups(held)

    return run


def _proposals(
    meetings: DataFrame, roots: DataFrame, classes: DataFrame, percent: int, nearest: int, block: int
) -> DataFrame:
    """Rows of PROPOSED: the best partners of classes outside of their components, once for every group in
    which they meet; stored."""
    placed = meetings.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "token", "cls", F.coalesce("root", "cls").alias("component")
    )
    mixed = (
        placed.groupBy("token")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"), F.count(F.lit(1)).alias("held"))
        .filter("first < last")
        .select("token", F.ceil(F.col("held") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    meeting = (
        placed.join(mixed, "token")
        .select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        # A block meets every other block; alone it meets itself.
        .filter((F.col("own") != F.col("other")) | (F.col("blocks") == 1))
        .select(
            "token", "cls", "component",
            (F.least("own", "other") * F.lit(1 << 31).cast("long") + F.greatest("own", "other")).alias("pair"),
        )
        .join(classes.select("cls", "n", "excess", "bits"), "cls")
        .select("token", "pair", "n", "cls", "component", "excess", "bits")
        .repartition("token", "pair")
        .sortWithinPartitions("token", "pair", "n", "cls")
    )
    return stored(arrow_pass(meeting, _propose(percent, nearest), PROPOSED))


def _sets(rows: DataFrame, row: str, wanted: DataFrame, words_per_shingle: int) -> DataFrame:
    """cls and the whole set of each wanted class (cls, row), from the text of one of its rows: stored."""
    wanted = stored(wanted.select("cls", F.col("row").alias(row)))
    texts = rows.select(row, "text").join(_few(wanted), row)

    def whole(_: pa.RecordBatch, texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([shingle_set(text, words_per_shingle).tobytes() for text in texts], pa.binary())]

    return stored(map_texts(texts, ["cls"], texts["text"], whole, [T.StructField("shingles", T.BinaryType())]))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Linking pairs that join what all pairs join whose whole sets link; stored.

    A task verifies no pair that the links it has found connect already."""
    both = (
        pairs.select("source", "target")
        .join(sets.toDF("source", "left"), "source")
        .join(sets.toDF("target", "right"), "target")
        .select("source", "target", "left", "right")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        above: dict[int, int] = {}

        def top(node: int) -> int:
            while (over := above.get(node, node)) != node:
                above[node] = node = above.get(over, over)
            return node

        for batch in batches:
            found = []
            for source, target, left, right in zip(*(column.to_pylist() for column in batch.columns)):
                a, b = top(source), top(target)
                if a == b:
                    continue
                if linked(np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64), percent):
                    above[max(a, b)] = min(a, b)
                    found.append((source, target))
            yield _edges(found)

    return stored(arrow_pass(both, run, EDGE))


def class_links(
    rows: DataFrame, row: str, prints: DataFrame, classes: DataFrame, words_per_shingle: int = SHINGLE_WORDS,
    percent: int = PERCENT, nearest: int = NEAREST, block: int = BLOCK,
) -> DataFrame:
    """(node, root) of all classes that link with another; root is the least class of the component."""

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("source", "target")).alias("cls")).distinct()
        wanted = classes.select("cls", "row").join(ends, "cls", "left_semi")
        return _verified(pairs, _sets(rows, row, wanted, words_per_shingle), percent)

    meetings = _meetings(prints, classes)
    asked = _neighbours(classes, percent)
    roots, complete = components(verified(asked)), True
    while True:
        proposed = _proposals(meetings, roots, classes, percent, nearest, block)
        pairs = proposed.filter("source is not null").groupBy("source", "target").agg(
            F.count(F.lit(1)).alias("groups"), F.max("wanted").alias("wanted")
        )
        if complete:
            # All groups are looked at: too few in common says that a pair does not link, or that it is left
            # out of a group that has more and comes back with it.
            pairs = pairs.filter("groups >= wanted")
        new = stored(pairs.select("source", "target").join(asked, ["source", "target"], "left_anti"))
        if not new.isEmpty():
            links = verified(new)
            if not links.isEmpty():
                roots = components(links.union(roots))
        cut = proposed.filter("more is not null").select(F.col("more").alias("token"))
        if cut.isEmpty():
            return roots
        # What all groups but these had to propose has been verified.
        meetings, complete = stored(meetings.join(cut, "token", "left_semi")), False
        asked = asked.unionByName(new)
        nearest *= MORE


def jaccard_classes(
    docs: DataFrame, row: str, words_per_shingle: int = SHINGLE_WORDS, percent: int = PERCENT, **limits: int
) -> DataFrame:
    """One row per document: row, doc_id, n_shingles, root (null without words) and component_id."""
    prints = _prints(docs, row, words_per_shingle, percent)
    classes = stored(
        prints.filter("n > 0").groupBy("hi", "lo")
        .agg(
            F.min("doc_id").alias("first"), F.min("row").alias("row"), F.any_value("n").alias("n"),
            F.any_value("least").alias("least"), F.any_value("excess", True).alias("excess"),
            F.any_value("bits", True).alias("bits"),
        )
        # Numbered and stored in one job: the numbers are read, never made again.
        .withColumn("cls", F.monotonically_increasing_id())
    )
    roots = class_links(docs, row, prints, classes, words_per_shingle, percent, **limits)
    rooted = stored(
        classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("hi", "lo", "first", F.coalesce("root", "cls").alias("root"))
    )
    # Stored, so that either side of the joins is a plain shuffle and what is hot can be split.
    names = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = stored(rooted.join(names, "root").select("hi", "lo", "root", "component_id"))
    alone = F.col("n") == 0
    return prints.select("row", "doc_id", "n", "hi", "lo").join(named, ["hi", "lo"], "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "root",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def jaccard_components(docs: DataFrame, **parameters: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    row = unused(docs, "row")
    return jaccard_classes(numbered(docs, row), row, **parameters).select("doc_id", "n_shingles", "component_id")
