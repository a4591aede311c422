"""Constraint checks that return the offending rows; none of them changes data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanrisk.policy import DOMAINS, RANGES
from loanrisk.sources.schemas import required_columns


@dataclass(frozen=True)
class Rule:
    """A condition on one column that a violating row fulfils."""

    name: str
    column: str
    broken: Column


def range_rules(*columns: str) -> list[Rule]:
    """Range checks; NULL passes, as in a SQL CHECK."""
    return [Rule("RANGE", c, ~F.col(c).between(*RANGES[c])) for c in columns]


def domain_rules(*columns: str) -> list[Rule]:
    """Domain checks; NULL passes, the not-null check reports it."""
    return [Rule("DOMAIN", c, ~F.col(c).isin(*DOMAINS[c])) for c in columns]


def not_null_rules(*columns: str) -> list[Rule]:
    return [Rule("NOT_NULL", c, F.col(c).isNull()) for c in columns]


def violations(df: DataFrame, table: str, key: str, rules: list[Rule]) -> DataFrame:
    """One row per (row, broken rule), from a single scan without a shuffle."""
    found = F.array(
        *(
            F.when(
                rule.broken,
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.column).alias("column_name"),
                    F.col(rule.column).cast("string").alias("value"),
                ),
            )
            for rule in rules
        )
    )
    return df.select(
        F.lit(table).alias("table_name"),
        F.col(key).alias("row_key"),
        F.inline(F.array_compact(found)),
    )


@dataclass(frozen=True)
class Contract:
    """What the rows of a table must keep: rules on a row, a key, and parents that must exist."""

    rules: tuple[Rule, ...] = ()
    key: str | None = None
    parents: tuple[tuple[DataFrame, str], ...] = ()


def contract_rules(schema: StructType) -> tuple[Rule, ...]:
    """The row rules of a table's schema: required columns, and ranges and domains of the known ones."""
    names = schema.names
    return (
        *not_null_rules(*required_columns(schema)),
        *range_rules(*(c for c in names if c in RANGES)),
        *domain_rules(*(c for c in names if c in DOMAINS)),
    )


#: The column in which ``flagged_rows`` says which rules a row breaks.
FLAGS = "broken__"


def flagged_rows(df: DataFrame, contract: Contract) -> tuple[DataFrame, list[str]]:
    """The rows with an array of whether they break each rule, and the rules' names in its order.

    A key adds a window by it, a parent a join; both share the partitioning that an upsert or a
    deduplication by the same key has left behind. Of the copies of a key all but one break it.
    """
    names, checked = df.columns, df
    broken = {f"{rule.name}:{rule.column}": rule.broken for rule in contract.rules}
    if contract.key is not None:
        copies = Window.partitionBy(contract.key).orderBy(contract.key)
        checked = checked.withColumn("copy__", F.row_number().over(copies))
        broken[f"PRIMARY_KEY:{contract.key}"] = F.col("copy__") > 1
    for number, (parent, column) in enumerate(contract.parents):
        known = parent.select(column).distinct().withColumn(f"parent__{number}", F.lit(True))
        checked = checked.join(known, column, "left")
        orphan = F.col(column).isNotNull() & F.col(f"parent__{number}").isNull()
        broken[f"FOREIGN_KEY:{column}"] = orphan
    flags = F.array(*broken.values()) if broken else F.array().cast("array<boolean>")
    return checked.withColumn(FLAGS, flags).select(*names, FLAGS), list(broken)


def observed(
    df: DataFrame, contract: Contract, span: str | None = None
) -> tuple[DataFrame, Observation]:
    """The same rows, and what a write of them will have counted: ``rows`` and every broken rule.

    With ``span``, also the ``least`` and the ``most`` of that column.

    Nothing is scanned for it. The count belongs to the last stage, whose tasks count once whatever
    has to be run again; so nothing may be shuffled between this and the write.
    """
    flagged, names = flagged_rows(df, contract)
    observation = Observation()
    counted = (F.count_if(F.get(FLAGS, F.lit(k))).alias(name) for k, name in enumerate(names))
    ends = [] if span is None else [F.min(span).alias("least"), F.max(span).alias("most")]
    watched = flagged.observe(observation, F.count(F.lit(1)).alias("rows"), *counted, *ends)
    return watched.drop(FLAGS), observation


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def primary_key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """Key values that occur more than once; copies are counted on the map side."""
    counts = df.groupBy(F.col(key).alias("key_value")).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter(F.col("copies") > 1).select(
        F.lit(table).alias("table_name"), "key_value", "copies"
    )


def foreign_key_violations(
    child: DataFrame, table: str, key: str, parent: DataFrame, column: str
) -> DataFrame:
    """Child rows whose parent is missing.

    One parent may own a large share of the child rows; nothing after the join needs its
    partitioning, so adaptive execution can split such a partition.
    """
    orphans = child.filter(F.col(column).isNotNull()).join(
        parent.select(column), column, "left_anti"
    )
    return orphans.select(
        F.lit(table).alias("table_name"),
        F.col(key).alias("row_key"),
        F.col(column).alias("missing_parent"),
    )


def not_null_violations(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULL count per required column that has any, from one aggregation."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    as_rows = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns)
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(as_rows)).filter(
        F.col("null_rows") > 0
    )
