"""Document fingerprints by winnowing, in DataFrame functions only.

The units of a text are its runs of characters that are not white space. Letters of scripts without
spaces (ideographs, kana, Thai, Lao, Khmer and others) are units singly, and so are all characters of
a run over 64: no unit depends on where a run starts, so that text without spaces matches too. Every k
successive units have a rolling hash (cyclic polynomial: the units' hashes, each rotated by its
distance from the last, joined by exclusive or). Of every window of w successive hashes the least is
chosen, the rightmost of equal ones. The fingerprint is the set of chosen hashes with their positions.
Texts that share w + k - 1 successive units share a chosen hash; passages under k units cannot match.

A chosen hash is one long: 35 bits of the hash, then the position counted down in 28 bits, so the
least long is the least hash and, among equals, the rightmost. (Spark's arrays hold fewer than
2**28 longs, so a position always fits.) Both the rolling hash and the least of a window are built by
doubling: two neighbours, then pairs of these, and so on, one pass over the array each.

Defined results: null and empty texts and white space have an empty fingerprint; a text of fewer than
k units has the hash of all of them, one of fewer than w hashes the least of all; two empty
fingerprints are alike by 1. The next document is that of the next smaller doc_id, after the smallest
the largest; a null id comes after the smallest; rows of one id follow each other by text and share a bucket, ids
being keys. An empty table gives an empty table. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 4, 8
POSITION_BITS = 28
LAST_POSITION = (1 << POSITION_BITS) - 1
SINGLE = "".join(rf"\p{{Is{script}}}" for script in (
    "Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan", "Javanese", "Balinese",
    "Tai_Le", "New_Tai_Lue", "Tai_Tham", "Tai_Viet",
))
# Java looks a character's script up for every script named. Ranges without any of these scripts, put
# first, spare that for nearly all characters; the rest of each class alone would match the same.
ALONE = rf"[\x{{E00}}-\x{{10FFFF}}&&[{SINGLE}]]"
# The ideograph beyond 16 bits, named once more, has Java look behind by whole characters.
IN_RUN = rf"[!-\x{{DFF}}\x{{1C00}}-\x{{2E7F}}\x{{AC00}}-\x{{D7A3}}[^\s{SINGLE}" + "\U00020000]]"
UNIT = rf"{ALONE}|(?<!{IN_RUN}){IN_RUN}{{1,64}}+(?!{IN_RUN})|{IN_RUN}"


def _let(value: Column, body) -> Column:
    """body of value, which is evaluated once per row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _doubled(values: Column, distance: int, join) -> Column:
    """join of each element and the one ``distance`` later, as far as there is one."""
    return _let(values, lambda v: F.zip_with(
        F.slice(v, 1, F.size(v) - distance), F.slice(v, distance + 1, F.size(v) - distance), join
    ))


def _rotated(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _packed(hashes: Column) -> Column:
    """Hash and position of each element as one long that sorts by hash, then from the right."""
    return F.transform(hashes, lambda h, place: F.shiftleft(
        F.shiftrightunsigned(h, POSITION_BITS + 1), POSITION_BITS
    ).bitwiseOR((F.lit(LAST_POSITION) - place).cast("long")))


def _grams(units: Column, gram: int) -> Column:
    """Rolling hashes of ``gram`` successive unit hashes (a power of two); all of them if fewer."""

    def roll(hashes: Column) -> Column:
        distance = 1
        while distance < gram:
            step = distance
            hashes = _doubled(hashes, step, lambda a, b: _rotated(a, step).bitwiseXOR(b))
            distance *= 2
        return hashes

    return _let(units, lambda u: F.when(F.size(u) >= gram, roll(u)).when(
        F.size(u) > 0, F.array(F.xxhash64(F.concat_ws(",", u.cast("array<string>"))))
    ).otherwise(F.array().cast("array<long>")))


def _least(packed: Column, window: int) -> Column:
    """The least of each ``window`` successive values (a power of two), once each, in order."""

    def slide(values: Column) -> Column:
        distance = 1
        while distance < window:
            values = _doubled(values, distance, lambda a, b: F.least(a, b))
            distance *= 2
        return F.array_distinct(values)

    return _let(packed, lambda p: F.when(F.size(p) >= window, slide(p)).when(
        F.size(p) > 0, F.array(F.array_min(p))
    ).otherwise(p))


def winnowed(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen hashes of a text, each with its position, as an array of longs."""
    if any(n < 1 or n & (n - 1) for n in (gram, window)):
        raise ValueError("gram and window must be powers of two")
    units = F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(UNIT), F.lit(0))
    return _least(_packed(_grams(F.transform(units, lambda unit: F.xxhash64(unit)), gram)), window)


def hashes(chosen: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(chosen, lambda v: F.shiftright(v, POSITION_BITS)))


def spelled(chosen: Column) -> Column:
    """A fingerprint as text: hash:position, in the order of the text."""
    return F.array_join(F.transform(chosen, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, POSITION_BITS))), F.lit(":"),
        (F.lit(LAST_POSITION) - v.bitwiseAND(F.lit(LAST_POSITION))).cast("string"),
    )), " ")


def likeness(one: Column, other: Column) -> Column:
    """Common over all distinct hashes; 1 if there are none."""
    return F.when((F.size(one) == 0) & (F.size(other) == 0), 1.0).otherwise(
        F.size(F.array_intersect(one, other)) / F.greatest(F.size(F.array_union(one, other)), F.lit(1))
    )


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id and its chosen hashes and positions as structs."""
    chosen = docs.select("doc_id", winnowed(docs["text"], gram, window).alias("chosen"))
    return chosen.select("doc_id", F.transform("chosen", lambda v: F.struct(
        F.shiftright(v, POSITION_BITS).alias("hash"),
        (F.lit(LAST_POSITION) - v.bitwiseAND(F.lit(LAST_POSITION))).alias("position"),
    )).alias("fingerprint"))


def _bounds(docs: DataFrame, buckets: int) -> list[int]:
    """Ids that cut the table into about equal buckets; a fixed number of them reaches the driver."""
    cuts = [k / buckets for k in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text and next_text, with rows kept in buckets of neighbouring ids.

    Whole texts are shuffled once. A bucket gets the first row of the next bucket as a guest, so each
    row finds its follower at home; ``guest`` marks such rows, which are to be dropped in the end.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, buckets)
    # Two steps to a row's bucket: the run of bounds, then the place within the run.
    width = max(1, int(len(bounds) ** 0.5))
    runs = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    doc_id = F.col("doc_id")

    def reached(values: list[int]) -> Column:
        return F.array(*(F.lit(value).cast("long") for value in values))

    def number(values: Column) -> Column:
        return F.size(F.filter(values, lambda bound: bound <= F.coalesce(doc_id, F.lit(-(1 << 63)).cast("long"))))

    if runs:
        run = number(reached([run[0] for run in runs]))
        place = number(F.get(F.array(*map(reached, runs)), F.greatest(run - 1, F.lit(0))))
        bucket = F.greatest(run - 1, F.lit(0)) * width + place
    else:
        bucket = F.lit(0)
    rows = docs.select(
        "doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    ).withColumn("bucket", bucket)
    # The first row of each bucket that has any, and the bucket that is to see it: the next larger one.
    firsts = rows.select("bucket", F.struct(doc_id, F.xxhash64("text").alias("tie")).alias("first"))
    firsts = firsts.groupBy("bucket").agg(F.max("first").alias("first"))
    largest = Window.partitionBy(F.lit(0))
    hosts = firsts.select(
        F.col("bucket").alias("own"), "first",
        F.coalesce(
            F.lead("bucket").over(largest.orderBy("bucket")), F.min("bucket").over(largest)
        ).alias("host"),
    )
    guests = (
        rows.join(F.broadcast(hosts), F.col("bucket") == F.col("own"))  # one row per bucket
        .filter(F.struct(doc_id, F.xxhash64("text").alias("tie")).eqNullSafe(F.col("first")))
        .select("doc_id", "text", F.col("host").alias("bucket"), F.lit(True).alias("guest"))
    )
    return rows.withColumn("guest", F.lit(False)).unionByName(guests)


def in_bucket():
    """Rows of a bucket from the largest id down, its guests last."""
    return Window.partitionBy("bucket").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()
    )


def edited_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document against its edited text and the next document.

    The edited text has the last half of the characters replaced by the first ones of the next
    document's text. One row per document: doc_id, n_chars, edited, chosen, edited_chosen, near_edited
    and near_next.
    """
    rows = with_next(docs).withColumn("next_text", F.lead("text").over(in_bucket()))
    n_chars = F.char_length("text")
    half = F.floor(n_chars / 2).cast("int")
    rows = rows.select(
        "doc_id", "bucket", "guest", "text", n_chars.cast("long").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), n_chars - half), F.substring(F.coalesce("next_text", "text"), F.lit(1), half)
        ).alias("edited"),
        winnowed(F.col("text"), gram, window).alias("chosen"),
        F.when(~F.col("guest"), F.lit(0)).alias("home"),
    )
    rows = rows.withColumn("next_chosen", F.lead("chosen").over(in_bucket())).filter(~F.col("guest"))
    rows = rows.select(
        "doc_id", "n_chars", "edited", "chosen", winnowed(F.col("edited"), gram, window).alias("edited_chosen"),
        F.coalesce("next_chosen", "chosen").alias("next_chosen"),
    )
    return rows.select(
        "doc_id", "n_chars", "edited", "chosen", "edited_chosen",
        likeness(hashes(F.col("chosen")), hashes(F.col("edited_chosen"))).alias("near_edited"),
        likeness(hashes(F.col("chosen")), hashes(F.col("next_chosen"))).alias("near_next"),
    )
