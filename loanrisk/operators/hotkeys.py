"""Operators that need a key's rows in order, for keys of any size.

A plain window by key is the cheapest plan as long as no key is large. The keys that hold very many
rows are therefore found first, in a job of its own over the key and the row id; their rows take a
plan that never brings them together, all others the plain window. Usually no key is hot, and the
plain window is then the whole plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotKeyLimits:
    """A key is hot above ``rows`` rows, whatever the size of the table.

    Sizes are estimated from one row in ``draw_one_in``, drawn by hash of the row id. The
    estimate only picks the plan for a key: both plans are exact for every key and every row
    passes through one of them. Up to ``broadcast_keys`` hot keys are handed to the tasks that
    read the rows; more are met by a shuffle join in which ``salts`` tasks share a key.
    """

    rows: int = 1_000_000
    draw_one_in: int = 64
    broadcast_keys: int = 10_000
    salts: int = 64


@dataclass(frozen=True)
class Split:
    ordinary: DataFrame
    hot: DataFrame | None


def split_by_size(rows: DataFrame, key: str, row_id: str, limits: HotKeyLimits) -> Split:
    """Separate the rows of hot keys from all others; ``hot`` is None if no key is hot.

    Runs the sizing job. At most ``broadcast_keys`` + 1 keys reach the driver.
    """
    drawn = rows.filter(F.pmod(F.xxhash64(row_id), F.lit(limits.draw_one_in)) == 0)
    sizes = drawn.groupBy(key).agg((F.count(F.lit(1)) * limits.draw_one_in).alias("size"))
    hot_keys = sizes.filter(F.col("size") > limits.rows).select(key)
    found = hot_keys.limit(limits.broadcast_keys + 1).collect()
    if not found:
        return Split(rows, None)
    if len(found) <= limits.broadcast_keys:
        few = F.broadcast(rows.sparkSession.createDataFrame(found, hot_keys.schema))
        return Split(rows.join(few, key, "left_anti"), rows.join(few, key, "left_semi"))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(limits.salts - 1).cast("long"))
    many = hot_keys.select(key, F.explode(salts).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(row_id), F.lit(limits.salts)))
    return Split(
        salted.join(many, [key, "salt"], "left_anti").select(*rows.columns),
        salted.join(many, [key, "salt"], "left_semi").select(*rows.columns),
    )


def _halving(cuts: Column) -> Column:
    """Sorted cuts with the strides of a search by halves: powers of two down from their number."""
    exponents = F.sequence(F.floor(F.log2(F.size(cuts))).cast("int"), F.lit(0), F.lit(-1))
    strides = F.transform(exponents, lambda exponent: F.pow(F.lit(2), exponent).cast("int"))
    return F.struct(cuts.alias("cuts"), strides.alias("strides"))


def _reached(search: Column, value: Column) -> Column:
    """How many cuts are not above ``value``, by halves; 0 without any cut."""
    cuts = search["cuts"]
    found = F.aggregate(
        search["strides"],
        F.lit(0),
        # Beyond the last cut there is NULL, which is not reached.
        lambda passed, stride: F.when(
            F.get(cuts, passed + stride - 1) <= value, passed + stride
        ).otherwise(passed),
    )
    return F.coalesce(found, F.lit(0))


def with_chunk(rows: DataFrame, cuts: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """rows with ``chunk``, how many of the ``cuts`` (a sorted array per keys) their id reaches.

    A joined row carries an array with it, so the cuts come in two levels of about the square
    root of their number: first the run of cuts is found, then the place in that run.
    """
    width = F.ceil(F.sqrt(F.size("cuts"))).cast("int")
    sized = cuts.withColumn("width", width).withColumn(
        "starts", F.sequence(F.lit(1), F.size("cuts"), F.col("width"))
    )
    firsts = F.transform("starts", lambda at: F.element_at("cuts", at))
    coarse = sized.select(*keys, "width", _halving(firsts).alias("firsts"))
    runs = F.transform("starts", lambda at: F.slice("cuts", at, F.col("width")))
    fine = sized.select(*keys, F.posexplode(runs).alias("before", "run_cuts")).select(
        *keys, (F.col("before") + 1).alias("run"), _halving(F.col("run_cuts")).alias("run_cuts")
    )
    placed = rows.join(coarse, keys, "left").select(
        *rows.columns, "width", _reached(F.col("firsts"), F.col(row_id)).alias("run")
    )
    inside = _reached(F.col("run_cuts"), F.col(row_id))
    chunk = F.when(F.col("run") == 0, 0).otherwise((F.col("run") - 1) * F.col("width") + inside)
    return placed.join(fine, [*keys, "run"], "left").select(*rows.columns, chunk.alias("chunk"))


def with_previous(
    rows: DataFrame,
    key: str,
    day: str,
    row_id: str,
    carried: tuple[str, ...],
    limits: HotKeyLimits,
) -> DataFrame:
    """Add ``previous``: the ``carried`` columns of the key's preceding row by (day, id).

    The rows of a hot key are cut into chunks that keep the order: one per day, and a day is
    cut again at ids drawn by hash, about one per ``limits.rows`` rows. A row finds its chunk
    among n cuts with about log2(n) comparisons. Each chunk is a window of its own, and only
    its last row takes part in the window that links a key's chunks.
    """
    split = split_by_size(rows, key, row_id, limits)
    carry = F.struct(*carried)

    plain = Window.partitionBy(key).orderBy(day, row_id)
    ordinary = split.ordinary.select("*", F.lag(carry).over(plain).alias("previous"))
    if split.hot is None:
        return ordinary

    cuts = (
        split.hot.filter(F.pmod(F.xxhash64(day, row_id), F.lit(limits.rows)) == 0)
        .groupBy(key, day)
        .agg(F.sort_array(F.collect_set(row_id)).alias("cuts"))
    )
    chunked = with_chunk(split.hot, cuts, [key, day], row_id)
    chunk_key = [key, day, "chunk"]
    link = Window.partitionBy(key).orderBy(day, "chunk")
    before_chunk = (
        chunked.groupBy(*chunk_key)
        .agg(F.max_by(carry, row_id).alias("last"))
        .select(*chunk_key, F.lag("last").over(link).alias("before_chunk"))
    )
    inside = Window.partitionBy(*chunk_key).orderBy(row_id)
    linked = (
        chunked.withColumn("in_chunk", F.lag(carry).over(inside))
        .join(before_chunk, chunk_key)
        .select(*rows.columns, F.coalesce("in_chunk", "before_chunk").alias("previous"))
    )
    return ordinary.unionByName(linked)
