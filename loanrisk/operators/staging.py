"""Staging and load: normalise, deduplicate, split rejects, upsert and append."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType

from loanrisk.functions.text import canonical
from loanrisk.operators.quality import Rule, domain_rules, not_null_rules, range_rules
from loanrisk.policy import DOMAINS
from loanrisk.sources.schemas import CREDIT_SCORES, MORTGAGE_ACCOUNTS, required_columns, staged


ARRIVAL = "ingest_seq"


def normalize(df: DataFrame) -> DataFrame:
    """Bring coded columns to the domain's spelling; unknown values are left to the checks."""
    coded = {c: canonical(F.col(c), DOMAINS[c]) for c in df.columns if c in DOMAINS}
    return df.withColumns(coded) if coded else df


def deduplicate(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the last to arrive.

    The remaining columns break ties, so the result never depends on the order of reading.
    The rank filter runs before the exchange as well: any number of copies of a key leaves
    each map task as one row. A table without arrival numbers counts as arrived at once.
    """
    others = [c for c in df.columns if c not in (key, ARRIVAL)]
    arrival = [F.desc(ARRIVAL)] if ARRIVAL in df.columns else []
    order = Window.partitionBy(key).orderBy(*arrival, *map(F.desc, others))
    return (
        df.withColumn("position", F.row_number().over(order))
        .filter(F.col("position") == 1)
        .drop("position")
    )


def score_rules() -> list[Rule]:
    """What a staged observation must satisfy; scoring also needs the utilization."""
    return [
        *not_null_rules(*required_columns(CREDIT_SCORES), "credit_utilization_pct"),
        *range_rules("credit_score", "payment_history_score", "credit_utilization_pct"),
        *domain_rules("score_source"),
    ]


def account_rules() -> list[Rule]:
    """What a staged account must satisfy; scoring also needs a property value."""
    return [
        *not_null_rules(*required_columns(MORTGAGE_ACCOUNTS)),
        Rule("POSITIVE", "property_value", F.col("property_value") <= 0),
        *domain_rules("property_province", "property_type", "employment_status"),
    ]


def with_reasons(
    df: DataFrame,
    rules: list[Rule],
    parent: DataFrame | None = None,
    parent_key: str = "account_id",
) -> DataFrame:
    """Add ``reasons``: the rules a row breaks, empty for a valid row.

    With ``parent`` given, a row without a parent breaks the foreign key.
    """
    reasons = [F.when(r.broken, F.lit(f"{r.name}:{r.column}")) for r in rules]
    if parent is None:
        return df.withColumn("reasons", F.array_compact(F.array(*reasons)))
    # A parent that occurs twice is one parent: a child row stays one row.
    known = parent.select(parent_key).distinct().withColumn("has_parent", F.lit(True))
    reasons.append(
        F.when(F.col("has_parent").isNull(), F.lit(f"FOREIGN_KEY:{parent_key}"))
    )
    return (
        df.join(known, parent_key, "left")
        .withColumn("reasons", F.array_compact(F.array(*reasons)))
        .select(*df.columns, "reasons")
    )


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejects with their reasons."""
    valid = df.filter(F.size("reasons") == 0).drop("reasons")
    return valid, df.filter(F.size("reasons") > 0)


def upsert(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``existing`` with the rows of ``batch`` replacing or joining it by key.

    Of several rows of a key in ``batch`` the last to arrive counts. Where ``existing`` keeps
    arrival numbers, a row that arrived later than the batch's stays: replaying an old batch
    changes nothing. Only the batch's keys meet ``existing``; a batch below the broadcast
    threshold leaves the existing table unshuffled.
    """
    batch = deduplicate(batch, key)
    if ARRIVAL in existing.columns and ARRIVAL in batch.columns:
        stored = existing.select(key, F.col(ARRIVAL).alias("stored_arrival"))
        later = batch.join(stored, key).filter(F.col("stored_arrival") > F.col(ARRIVAL))
        batch = batch.join(later.select(key).distinct(), key, "left_anti")
    kept = existing.join(batch.select(key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(batch.select(*existing.columns))


def unseen(
    existing: DataFrame, batch: DataFrame, key: str, batch_keys: DataFrame | None = None
) -> DataFrame:
    """Rows of ``batch`` whose key ``existing`` lacks, one per key: what an append may add.

    Running the same batch again therefore adds nothing. The existing keys are cut down to
    the batch's own first: a batch below the broadcast threshold then leaves the existing
    table unshuffled. ``batch_keys`` may name a cheaper source of (at least) those keys, such
    as the staged table the batch comes from.
    """
    keys = (batch if batch_keys is None else batch_keys).select(key).distinct()
    already = existing.select(key).join(keys, key, "left_semi")
    return deduplicate(batch, key).join(already, key, "left_anti")


@dataclass(frozen=True)
class Loaded:
    """Both tables after a load, the new observations in it, and what was rejected."""

    accounts: DataFrame
    scores: DataFrame
    new_scores: DataFrame
    rejected_accounts: DataFrame
    rejected_scores: DataFrame


#: When a row that is still rejected was rejected first.
REJECTED_ON = "rejected_on"


def rejected(schema: StructType) -> StructType:
    """The form in which rejects of a contract are kept: the staged row, its reasons, the first date."""
    return StructType([
        *staged(schema).fields,
        StructField("reasons", ArrayType(StringType()), True, {"comment": "Rules that the row breaks"}),
        StructField(REJECTED_ON, DateType(), True, {"comment": "Date of the run that rejected it first"}),
    ])


def with_rejects(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """A raw batch together with rows that earlier ones had rejected, to be judged again.

    A row of the batch that arrived later than the rejected one of its key takes its place; the
    same row handed in again stays rejected since the first time.
    """
    fresh = raw.withColumn(REJECTED_ON, F.lit(None).cast("date"))
    if ARRIVAL in raw.columns:
        return fresh.unionByName(kept.select(*fresh.columns))
    return fresh.unionByName(kept.drop("reasons", ARRIVAL).select(*fresh.columns))


def since(rejects: DataFrame, as_of: date) -> DataFrame:
    """Rejects with the date of their first rejection, which is ``as_of`` for new ones."""
    return rejects.withColumn(REJECTED_ON, F.coalesce(REJECTED_ON, F.lit(as_of)))


def stage_accounts(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid accounts and rejects of a raw batch, one row per account."""
    clean = deduplicate(normalize(raw), "account_id")
    return split(with_reasons(clean, account_rules()))


def stage_scores(
    raw: DataFrame, loaded: DataFrame, accounts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Valid new observations and rejects of a raw batch; ``accounts`` are those loaded."""
    clean = deduplicate(normalize(raw), "score_id")
    new = unseen(loaded, clean, "score_id", batch_keys=raw)
    return split(with_reasons(new, score_rules(), accounts))


def load(
    accounts: DataFrame, scores: DataFrame, raw_accounts: DataFrame, raw_scores: DataFrame
) -> Loaded:
    """Bring a raw batch into the loaded tables.

    Observations are checked against the accounts as they are after the upsert, so none is
    stored without its account.
    """
    valid_accounts, rejected_accounts = stage_accounts(raw_accounts)
    # An upsert removes no key: the foreign key needs the keys of both sides, not their rows.
    keys = accounts.select("account_id").unionByName(valid_accounts.select("account_id"))
    new, rejected_scores = stage_scores(raw_scores, scores, keys)
    new = new.select(*scores.columns)
    accounts = upsert(accounts, valid_accounts, "account_id")
    return Loaded(accounts, scores.unionByName(new), new, rejected_accounts, rejected_scores)
