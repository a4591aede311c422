"""Databases, typed tables, views and writes. The only module that starts jobs.

Every write can be run again after a failure: a snapshot and a date partition are
overwritten whole, and an append adds only keys the table lacks. A table's old content goes
only once the new one is written.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loanrisk.operators.carried import SCORE_STATE, advance, metrics_from_state, pending, profiles
from loanrisk.operators.metrics import rejects_of
from loanrisk.operators.quality import FLAGS, Contract, contract_rules, flagged_rows, observed
from loanrisk.operators.reports import SUMMARY, high_risk_alerts, load_counts
from loanrisk.operators.rollup import ROLLED_UP, summary_parts
from loanrisk.operators.staging import (
    rejected, since, stage_accounts, stage_scores, unseen, upsert, with_rejects,
)
from loanrisk.policy import CONTRACT, RiskPolicy
from loanrisk.sources.schemas import (
    CREDIT_SCORES,
    HIGH_RISK_ALERTS,
    MORTGAGE_ACCOUNTS,
    REJECTED_METRICS,
    RISK_METRICS,
    SUMMARY_PARTS,
    TABLES,
    conform,
    staged,
)

HISTORY_PARTITION = "calculation_date"
#: Partition of the stored observations: which load brought them.
LOAD = "load"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_text(comment)}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    comment: str,
    partition_by: str | None = None,
) -> None:
    """Create a typed parquet table with column comments, unless it exists."""
    partitioning = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}) "
        f"USING parquet {partitioning} COMMENT {_text(comment)}"
    )


def create_tables(spark: SparkSession, database: str) -> None:
    """The three contract tables; the metrics table is partitioned by calculation date."""
    for name, (schema, comment) in TABLES.items():
        partition = HISTORY_PARTITION if HISTORY_PARTITION in schema.names else None
        create_table(spark, f"{database}.{name}", schema, comment, partition)


class ContractBroken(ValueError):
    """Rows that break a table's contract; nothing of them has become visible."""

    def __init__(self, table: str, broken: dict[str, int]):
        super().__init__(f"{table} not written, rows that break its contract: {broken}")
        self.broken = broken


def _refuse_broken(table: str, counted: dict[str, int]) -> int:
    """The number of rows, unless some break a rule."""
    broken = {name: count for name, count in counted.items() if name != "rows" and count}
    if broken:
        raise ContractBroken(table, broken)
    return counted.get("rows", 0)


#: Row counts are kept as properties of the table, one for each part of it that was written.
_ROWS = "loanrisk.rows."


#: So are the least and the greatest key of a load.
_LEAST, _MOST = "loanrisk.least.", "loanrisk.most."


def _note_rows(spark: SparkSession, table: str, part: str, rows: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_text(_ROWS + part)} = {_text(str(rows))})")


def noted_rows(spark: SparkSession, table: str) -> int:
    """Rows of a table as its writes have counted them; no data is read."""
    pointed = _pointed_to(spark, table)
    properties = spark.sql(f"SHOW TBLPROPERTIES {pointed or table}").collect()
    return sum(int(row["value"]) for row in properties if row["key"].startswith(_ROWS))


def _pointed_to(spark: SparkSession, name: str) -> str | None:
    """The table that the view ``name`` reads, None if it is no view."""
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    text = described.filter("col_name = 'View Text'").first()
    return text and text["data_type"].rsplit(" ", 1)[-1]


def _write_version(df: DataFrame, version: str, schema: StructType, contract: Contract) -> int:
    """Write a table that no one reads yet, counting rows and broken rules on the way."""
    spark = df.sparkSession
    rows, counted = observed(conform(df, schema), contract)
    rows.write.mode("overwrite").format("parquet").saveAsTable(version)
    try:
        written = _refuse_broken(version, counted.get)
    except ContractBroken:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    _note_rows(spark, version, "all", written)
    return written


def _point(spark: SparkSession, name: str, version: str) -> None:
    """Let ``name`` read ``version``: one statement of the catalog, so readers see the old or the new."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def overwrite_table(
    df: DataFrame, table: str, schema: StructType, contract: Contract = Contract()
) -> int:
    """Replace a table's content and schema; returns the rows now stored, as the write counted them.

    The name is a view of the current version, a table of its own. The new version is written beside
    it and checked against the contract; only then the view is pointed at it. Whatever fails, the name
    reads the old version or the new one. The version before the last is dropped, so that readers that
    have begun can end. A plain table found under the name becomes version 0 first.
    """
    spark = df.sparkSession
    current = _pointed_to(spark, table)
    if current is None and spark.catalog.tableExists(table):
        current = f"{table}__v0"
        spark.sql(f"ALTER TABLE {table} RENAME TO {current}")
        try:
            _point(spark, table, current)
        except BaseException:
            spark.sql(f"ALTER TABLE {current} RENAME TO {table}")
            raise
    number = 0 if current is None else int(current.rsplit("__v", 1)[-1])
    written = _write_version(df, f"{table}__v{number + 1}", schema, contract)
    _point(spark, table, f"{table}__v{number + 1}")
    if number:
        spark.sql(f"DROP TABLE IF EXISTS {table}__v{number - 1}")
    return written


def write_history(
    rows: DataFrame,
    table: str,
    schema: StructType,
    dates: Collection[date],
    contract: Contract = Contract(),
) -> int:
    """Replace the rows of the given calculation dates; keep all other dates.

    A date for which there is no row is left empty. Rows of other dates, and rows that break the
    contract, are refused before anything is written. The rows are computed once, to disk, as they
    are needed for the checks as well as for the write; the rebalance hint lets adaptive execution
    size the files per date, splitting a date that is too large for one task and merging small
    pieces. Returns the number of rows written.
    """
    spark = rows.sparkSession
    columns = spark.table(table).columns
    flagged, rules = flagged_rows(conform(rows, schema).select(*columns), contract)
    stored = flagged.persist(StorageLevel.DISK_ONLY)
    try:
        counted = stored.groupBy(HISTORY_PARTITION).agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.count_if(F.get(FLAGS, F.lit(k))).alias(f"rule{k}") for k in range(len(rules))),
        ).collect()
        found = {row[HISTORY_PARTITION]: row["rows"] for row in counted}
        if set(found) - set(dates):
            raise ValueError(f"rows of dates that are not to be written: {set(found) - set(dates)}")
        _refuse_broken(
            table, {rule: sum(row[f"rule{k}"] for row in counted) for k, rule in enumerate(rules)}
        )
        if found:
            (
                stored.drop(FLAGS).hint("rebalance", HISTORY_PARTITION)
                .write.option("partitionOverwriteMode", "dynamic")
                .insertInto(table, overwrite=True)
            )
        for day in sorted(set(dates) - set(found)):
            spark.sql(
                f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({HISTORY_PARTITION} = DATE '{day}')"
            )
        for day in sorted(set(dates)):
            _note_rows(spark, table, str(day), found.get(day, 0))
    finally:
        stored.unpersist()
    spark.catalog.refreshTable(table)
    return sum(found.values())


def write_alerts(
    spark: SparkSession, alerts: DataFrame, table: str, dates: Collection[date]
) -> None:
    """Store the alerts of the given calculation dates in place of what these dates had."""
    create_table(spark, table, HIGH_RISK_ALERTS, "High-risk account alerts", HISTORY_PARTITION)
    write_history(alerts, table, HIGH_RISK_ALERTS, dates)


def latest_date(spark: SparkSession, table: str) -> date | None:
    """The latest calculation date of a stored table, from its list of partitions."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.to_date(F.substring_index("partition", "=", -1)).alias("day")
    )
    return listed.agg(F.max("day")).first()[0]


def append_new(batch: DataFrame, table: str, key: str) -> None:
    """Append the rows of ``batch`` whose key the table lacks, one per key.

    Of a table that ``overwrite_table`` has written, the current version is appended to.
    """
    table = _pointed_to(batch.sparkSession, table) or table
    existing = batch.sparkSession.table(table)
    unseen(existing, batch, key).select(*existing.columns).write.insertInto(table)


def publish_snapshot(
    df: DataFrame,
    database: str,
    name: str,
    snapshot: str,
    schema: StructType,
    contract: Contract = Contract(),
) -> int:
    """Write a new snapshot table and point the view ``name`` at it; returns its rows.

    A table cannot be overwritten by a query that reads it, so a new version gets a table
    of its own. Readers switch in one step, once it is complete and keeps its contract.
    """
    version = _version(database, name, snapshot)
    written = _write_version(df, version, schema, contract)
    _point(df.sparkSession, f"{database}.{name}", version)
    return written


def _version(database: str, name: str, snapshot: str) -> str:
    return f"{database}.{name}__{snapshot}"


def _published(spark: SparkSession, database: str, name: str) -> str | None:
    """The snapshot table that the view ``name`` reads."""
    return _pointed_to(spark, f"{database}.{name}")


def _other_version(spark: SparkSession, database: str, name: str) -> str:
    """The other of two alternating versions, so that the one being read stays as it is."""
    published = _published(spark, database, name)
    return "even" if published is not None and published.endswith("__odd") else "odd"


def upsert_snapshot(
    batch: DataFrame, database: str, name: str, snapshot: str, schema: StructType, key: str
) -> None:
    """Upsert ``batch`` into the published table as a new snapshot.

    A snapshot that is published already is complete: running it again changes nothing.
    """
    spark = batch.sparkSession
    if _published(spark, database, name) == _version(database, name, snapshot):
        return
    existing = spark.table(f"{database}.{name}")
    publish_snapshot(upsert(existing, batch, key), database, name, snapshot, schema)


def _parts(spark: SparkSession, table: str) -> list[str]:
    """The values of a table's partitions, from the catalog."""
    return [row["partition"].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def create_loads(spark: SparkSession, database: str) -> str:
    """The stored observations, partitioned by load, and the view ``credit_scores`` over all of them.

    What is newer than a load can be read without what is older. A plain table of that name becomes
    load 0.
    """
    view, loads = f"{database}.credit_scores", f"{database}.credit_scores__loads"
    schema = StructType([*CREDIT_SCORES.fields, StructField(LOAD, LongType(), False, {"comment": "Number of the load"})])
    create_table(spark, loads, schema, TABLES["credit_scores"][1], LOAD)
    if spark.catalog.tableExists(view) and _pointed_to(spark, view) is None:
        if "0" not in _parts(spark, loads):
            append_load(spark.table(view), loads, 0)
        spark.sql(f"ALTER TABLE {view} RENAME TO {view}__before")
    columns = ", ".join(CREDIT_SCORES.names)
    if not spark.catalog.tableExists(view):
        spark.sql(f"CREATE VIEW {view} AS SELECT {columns} FROM {loads}")
    return loads


def append_load(rows: DataFrame, loads: str, number: int, contract: Contract = Contract()) -> int:
    """Add rows as the load of this number; returns how many.

    The files are written first and count what breaks the contract; the catalog then learns of them in
    one statement, so readers see all of a load or nothing. A load that has failed can be written again.
    The write also notes between which keys the load lies, see ``loads_with``.
    """
    spark = rows.sparkSession
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {loads}").filter("col_name = 'Location'")
    place = f"{described.first()['data_type'].rstrip('/')}/{LOAD}={number}"
    checked, observation = observed(conform(rows, CREDIT_SCORES), contract, span="score_id")
    checked.write.mode("overwrite").parquet(place)
    counted = dict(observation.get)
    ends = counted.pop("least"), counted.pop("most")
    written = _refuse_broken(loads, counted)
    if written:
        spark.sql(f"ALTER TABLE {loads} ADD PARTITION ({LOAD} = {number}) LOCATION {_text(place)}")
        _note_rows(spark, loads, str(number), written)
        noted = ", ".join(
            f"{_text(kind + str(number))} = {_text(end)}" for kind, end in zip((_LEAST, _MOST), ends)
        )
        spark.sql(f"ALTER TABLE {loads} SET TBLPROPERTIES ({noted})")
        spark.catalog.refreshTable(loads)
    return written


def loads_with(keys: DataFrame, loads: str) -> list[int]:
    """Numbers of the loads that may hold some of ``keys`` (a column ``score_id``).

    A load does if a key lies between its least and its greatest, as its write has noted; one without
    such a note always does. The keys are read once and aggregated, the loads not at all.
    """
    spark = keys.sparkSession
    noted = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {loads}").collect()}
    numbers = _parts(spark, loads)
    spans = {n: (noted[_LEAST + n], noted[_MOST + n]) for n in numbers if {_LEAST + n, _MOST + n} <= set(noted)}
    if not spans:
        return sorted(map(int, numbers))
    key = F.col("score_id")
    met = keys.agg(*(F.bool_or(key.between(*span)).alias(n) for n, span in spans.items())).first()
    return sorted(int(n) for n in numbers if n not in spans or met[n])


def carry_state(
    spark: SparkSession, database: str, as_of: date, policy: RiskPolicy, keep: int = 8
) -> DataFrame:
    """Bring the accounts' state to ``as_of`` and store it; observations of earlier loads stay unread.

    It is made from the latest earlier state, the loads that state has not seen and what was pending
    then; from all loads if there is no earlier state. Of the dates' states the last ``keep`` stay.
    """
    loads = f"{database}.credit_scores__loads"
    states, waiting = f"{database}.score_state", f"{database}.score_pending"
    create_table(spark, states, SCORE_STATE, "What an account's past leaves to later dates", HISTORY_PARTITION)
    pending_schema = StructType([*CREDIT_SCORES.fields, SCORE_STATE[HISTORY_PARTITION]])
    create_table(spark, waiting, pending_schema, "Observations dated after the date", HISTORY_PARTITION)

    earlier = [day for day in _parts(spark, states) if day < str(as_of)]
    arrived, before, through = spark.table(loads), None, -1
    if earlier:
        at = F.col(HISTORY_PARTITION) == F.lit(max(earlier)).cast("date")
        before = spark.table(states).filter(at)
        through = before.agg(F.min("through_load")).first()[0]
        unseen_loads = arrived.filter(F.col(LOAD) > through).drop(LOAD)
        arrived = unseen_loads.unionByName(spark.table(waiting).filter(at).drop(HISTORY_PARTITION))
    last = max([through, *map(int, _parts(spark, loads))])
    state = advance(before, arrived, as_of, policy, last)
    later = pending(arrived, as_of).withColumn(HISTORY_PARTITION, F.lit(as_of))
    write_history(later, waiting, pending_schema, [as_of])
    write_history(state, states, SCORE_STATE, [as_of])
    for day in sorted(_parts(spark, states))[:-keep]:
        for table in (states, waiting):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({HISTORY_PARTITION} = DATE '{day}')")
    return spark.table(states).filter(F.col(HISTORY_PARTITION) == F.lit(as_of))


def write_summary(spark: SparkSession, database: str, dates: Collection[date]) -> int:
    """Sum up the stored metrics of the given dates into ``risk_summary_parts``, in place of what these
    dates had. To be called after their metrics are written; other dates stay unread."""
    table = f"{database}.risk_summary_parts"
    create_table(spark, table, SUMMARY_PARTS, "Sums and counts per date, tier and province", HISTORY_PARTITION)
    metrics = spark.table(f"{database}.risk_metrics").filter(F.col(HISTORY_PARTITION).isin(list(dates)))
    parts = summary_parts(metrics, spark.table(f"{database}.mortgage_accounts"))
    return write_history(parts, table, SUMMARY_PARTS, dates)


def create_summary_view(spark: SparkSession, database: str) -> None:
    """``vw_risk_summary`` over the stored tables, on the latest calculation date stored now.

    The date is a literal, so that readers open one partition; create the view again after
    a new date is written. If the date has been summed up by ``write_summary``, readers open its few
    parts only; otherwise the metrics and the accounts.
    """
    latest = latest_date(spark, f"{database}.risk_metrics")
    day = "CAST(NULL AS DATE)" if latest is None else f"DATE '{latest}'"
    parts, made_of = f"{database}.risk_summary_parts", SUMMARY
    source = f"{database}.risk_metrics JOIN {database}.mortgage_accounts USING (account_id)"
    if spark.catalog.tableExists(parts) and str(latest) in _parts(spark, parts):
        source, made_of = parts, ROLLED_UP
    columns = ", ".join(f"{sql} AS {name}" for name, sql in made_of.items())
    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.vw_risk_summary AS
        SELECT risk_category, {columns}
        FROM {source}
        WHERE {HISTORY_PARTITION} = {day}
        GROUP BY risk_category
    """)


def stored_counts(spark: SparkSession, database: str) -> dict[str, int]:
    """Row count of each contract table, read from what was written."""
    stored = {name: spark.table(f"{database}.{name}") for name in TABLES}
    return {row["table_name"]: row["row_count"] for row in load_counts(stored).collect()}


def _kept_rejects(spark: SparkSession, database: str, name: str, schema: StructType) -> DataFrame:
    """The rows still rejected; the table is created empty."""
    if _published(spark, database, name) is None:
        publish_snapshot(spark.createDataFrame([], schema), database, name, "even", schema)
    return spark.table(f"{database}.{name}")


def _store_accounts(spark: SparkSession, database: str, raw: DataFrame, as_of: date) -> None:
    """Upsert a batch's valid accounts and keep its rejects until a valid version of them arrives."""
    versioned, rejects = staged(MORTGAGE_ACCOUNTS), rejected(MORTGAGE_ACCOUNTS)
    if _published(spark, database, "mortgage_accounts") is None:
        nothing = spark.createDataFrame([], versioned)
        publish_snapshot(nothing, database, "mortgage_accounts", "initial", versioned)
    kept = _kept_rejects(spark, database, "rejected_accounts", rejects)
    valid, refused = stage_accounts(with_rejects(raw, kept))
    publish_snapshot(
        upsert(spark.table(f"{database}.mortgage_accounts"), valid, "account_id"),
        database, "mortgage_accounts", _other_version(spark, database, "mortgage_accounts"), versioned,
        Contract(contract_rules(MORTGAGE_ACCOUNTS), key="account_id"),
    )
    publish_snapshot(
        since(refused, as_of), database, "rejected_accounts",
        _other_version(spark, database, "rejected_accounts"), rejects,
    )


def _store_scores(spark: SparkSession, database: str, raw: DataFrame, as_of: date) -> None:
    """Add a batch's valid new observations as a load, and those of earlier batches that are valid now;
    keep what is still rejected."""
    loads, rejects = create_loads(spark, database), rejected(CREDIT_SCORES)
    kept = _kept_rejects(spark, database, "rejected_scores", rejects)
    accounts = spark.table(f"{database}.mortgage_accounts").select("account_id")
    number = 1 + max(map(int, _parts(spark, loads)), default=0)
    batch = with_rejects(raw, kept)
    # Only loads that may hold a key of the batch are opened to tell which rows are new.
    stored = spark.table(loads).filter(F.col(LOAD).isin(loads_with(batch, loads)))
    valid, refused = stage_scores(batch, stored, accounts)
    contract = Contract(contract_rules(CREDIT_SCORES), "score_id", ((accounts, "account_id"),))
    append_load(valid, loads, number, contract)
    publish_snapshot(
        since(refused, as_of), database, "rejected_scores",
        _other_version(spark, database, "rejected_scores"), rejects,
    )


def run_cycle(
    spark: SparkSession,
    database: str,
    raw_accounts: DataFrame,
    raw_scores: DataFrame,
    as_of: date,
    policy: RiskPolicy = CONTRACT,
) -> dict[str, int]:
    """One scheduled run: stage, upsert, append, metrics, history, summary and alerts.

    Accounts are snapshots behind the view ``mortgage_accounts``, with the arrival numbers
    that decide which version of an account is the newest. Observations are loads behind the view
    ``credit_scores``; metrics come from the state carried from the last date and the loads since.
    Rejected rows are kept with their reasons and judged again by the next run, so an observation
    whose account arrives later is loaded then. Every table is checked as it is written. Running a
    cycle again gives the same tables. Returns the rows of the contract tables, as counted by writes.
    """
    create_database(spark, database, "Loan portfolio risk")
    metrics_table = f"{database}.risk_metrics"
    create_table(spark, metrics_table, *TABLES["risk_metrics"], HISTORY_PARTITION)
    _store_accounts(spark, database, raw_accounts, as_of)
    _store_scores(spark, database, raw_scores, as_of)

    accounts = spark.table(f"{database}.mortgage_accounts")
    state = carry_state(spark, database, as_of, policy)
    built = metrics_from_state(accounts, state, as_of, policy)
    write_history(built, metrics_table, RISK_METRICS, [as_of], metrics_contract(policy, accounts))
    refused = rejects_of(accounts, profiles(state), policy) if policy.documented_rules else None
    if refused is not None:
        table = f"{database}.rejected_metrics"
        create_table(spark, table, REJECTED_METRICS, "Accounts without metrics at a date", HISTORY_PARTITION)
        dated = refused.withColumn(HISTORY_PARTITION, F.lit(as_of))
        write_history(dated, table, REJECTED_METRICS, [as_of])
    write_summary(spark, database, [as_of])
    create_summary_view(spark, database)
    alerts = high_risk_alerts(spark.table(metrics_table), as_of)
    write_alerts(spark, alerts, f"{database}.high_risk_alerts", [as_of])
    return {
        "mortgage_accounts": noted_rows(spark, f"{database}.mortgage_accounts"),
        "credit_scores": noted_rows(spark, f"{database}.credit_scores__loads"),
        "risk_metrics": noted_rows(spark, metrics_table),
    }


def metrics_contract(policy: RiskPolicy, accounts: DataFrame) -> Contract:
    """What stored metrics keep. Scores as coded go beyond 100, so their range holds for the
    documented rules only."""
    rules = contract_rules(RISK_METRICS)
    if not policy.documented_rules:
        rules = tuple(rule for rule in rules if rule.column != "risk_score_normalized" or rule.name != "RANGE")
    return Contract(rules, "metric_id", ((accounts, "account_id"),))
