"""A scheduled run: contracts kept while writing, replacement in one step, rejects tried again, state carried."""

from __future__ import annotations

import uuid
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanrisk.operators import metrics
from loanrisk.operators.quality import Contract, contract_rules
from loanrisk.policy import CONTRACT
from loanrisk.sinks import catalog
from loanrisk.sources.schemas import CREDIT_SCORES, MORTGAGE_ACCOUNTS, RISK_METRICS, staged
from tests.conftest import rows_of
from tests.test_plans import records_read

DAY = date(2023, 1, 2)


@pytest.fixture
def database(spark):
    name = f"cycle_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, name, "Runs")
    return name


def stamped(df, number=0):
    return df.withColumn("ingest_seq", F.lit(number))


def ids(spark, table, column="account_id"):
    return sorted(row[0] for row in spark.table(table).select(column).collect())


def test_a_batch_that_breaks_a_rule_leaves_the_table(spark, database, make_accounts, make_scores):
    table = f"{database}.mortgage_accounts"
    contract = Contract(contract_rules(MORTGAGE_ACCOUNTS), key="account_id")
    good = make_accounts(("A", "1.00", "2.00"), ("B", "1.00", "2.00"))
    assert catalog.overwrite_table(good, table, MORTGAGE_ACCOUNTS, contract) == 2

    loose = staged(MORTGAGE_ACCOUNTS)
    plain = make_accounts(("C", "1.00", "2.00"), ("D", "1.00", "2.00"))
    for bad, rule in (
        (plain.withColumn("property_type", F.lit("Houseboat")), "DOMAIN:property_type"),
        (plain.withColumn("customer_id", F.lit(None).cast("string")), "NOT_NULL:customer_id"),
        (plain.unionByName(plain), "PRIMARY_KEY:account_id"),
    ):
        with pytest.raises(catalog.ContractBroken) as refused:
            catalog.overwrite_table(stamped(bad), table, loose, contract)
        assert refused.value.broken == {rule: 2}
        assert ids(spark, table) == ["A", "B"] and spark.table(table).columns == MORTGAGE_ACCOUNTS.names
    assert catalog.overwrite_table(plain, table, MORTGAGE_ACCOUNTS, contract) == 2
    assert ids(spark, table) == ["C", "D"] and catalog.noted_rows(spark, table) == 2


def test_loads_and_dates_are_refused_as_a_whole(spark, database, make_accounts, make_scores):
    accounts = make_accounts(("A", "80.00", "100.00"))
    loads = catalog.create_loads(spark, database)
    contract = Contract(contract_rules(CREDIT_SCORES), "score_id", ((accounts, "account_id"),))
    good = make_scores({"score_id": "S1", "score_date": DAY})
    bad = make_scores({"score_id": "S2"}, {"score_id": "S3", "account_id": "X"}, {"score_id": "S4", "credit_score": 901})
    assert catalog.append_load(good, loads, 1, contract) == 1
    with pytest.raises(catalog.ContractBroken) as refused:
        catalog.append_load(bad, loads, 2, contract)
    assert refused.value.broken == {"FOREIGN_KEY:account_id": 1, "RANGE:credit_score": 1}
    assert ids(spark, f"{database}.credit_scores", "score_id") == ["S1"]
    # The same load, mended, can be written again.
    assert catalog.append_load(make_scores({"score_id": "S2"}), loads, 2, contract) == 1
    assert ids(spark, f"{database}.credit_scores", "score_id") == ["S1", "S2"]

    catalog.create_table(spark, f"{database}.risk_metrics", RISK_METRICS, "Metrics", "calculation_date")
    built = metrics.build_risk_metrics(accounts, good, DAY, CONTRACT)
    contract = catalog.metrics_contract(CONTRACT, accounts)
    assert catalog.write_history(built, f"{database}.risk_metrics", RISK_METRICS, [DAY], contract) == 1
    with pytest.raises(catalog.ContractBroken) as refused:
        orphans = built.withColumns({"account_id": F.lit("X"), "risk_category": F.lit("Some Risk")})
        catalog.write_history(orphans, f"{database}.risk_metrics", RISK_METRICS, [DAY], contract)
    assert refused.value.broken == {"DOMAIN:risk_category": 1, "FOREIGN_KEY:account_id": 1}
    assert rows_of(spark.table(f"{database}.risk_metrics").select("account_id")) == [("A",)]


@pytest.mark.parametrize("plain_table", [False, True])
def test_a_failure_at_any_step_leaves_the_old_or_the_new_table(
    spark, database, make_accounts, monkeypatch, plain_table
):
    table = f"{database}.mortgage_accounts"
    old, new = make_accounts(("A", "1.00", "2.00")), make_accounts(("B", "1.00", "2.00"))
    if plain_table:
        old.write.saveAsTable(table)
    else:
        catalog.overwrite_table(old, table, MORTGAGE_ACCOUNTS)
    run = type(spark).sql
    for step in range(20):
        calls = iter(range(100))

        def failing(self, *args, **kwargs):
            if args[0].split()[0] in ("CREATE", "ALTER", "DROP") and next(calls) == step:
                raise RuntimeError("no more")
            return run(self, *args, **kwargs)

        monkeypatch.setattr(type(spark), "sql", failing)
        try:
            catalog.overwrite_table(new, table, MORTGAGE_ACCOUNTS)
            break
        except RuntimeError:
            assert ids(spark, table) in (["A"], ["B"])
        finally:
            monkeypatch.setattr(type(spark), "sql", run)
    assert step >= 2 and ids(spark, table) == ["B"]


def test_counts_come_from_the_write(spark, database, make_accounts):
    table = f"{database}.mortgage_accounts"
    accounts = make_accounts(*((f"A{k}", "1.00", "2.00") for k in range(50)))
    accounts.write.parquet(path := f"{spark.conf.get('spark.sql.warehouse.dir')}/{database}_in")
    source = spark.read.parquet(path)
    contract = Contract(contract_rules(MORTGAGE_ACCOUNTS))
    read = records_read(spark, lambda: catalog.overwrite_table(source, table, MORTGAGE_ACCOUNTS, contract))
    assert read == 50
    assert records_read(spark, lambda: catalog.noted_rows(spark, table)) == 0


def test_an_observation_waits_for_its_account(spark, database, make_accounts, make_scores):
    """staged = stored + rejected after every run; what was rejected for its account is loaded with it."""
    scores = stamped(make_scores(
        {"score_id": "S1", "account_id": "A", "score_date": DAY},
        {"score_id": "S2", "account_id": "B", "score_date": DAY},
        {"score_id": "S3", "account_id": "B", "score_date": DAY, "credit_score": 950},
    ))
    none = stamped(make_scores().limit(0))

    def run(accounts, batch, day):
        catalog.run_cycle(spark, database, stamped(make_accounts(*((a, "80.00", "100.00") for a in accounts))), batch, day)
        open_rejects = spark.table(f"{database}.rejected_scores").select("score_id", "reasons", "rejected_on")
        return ids(spark, f"{database}.credit_scores", "score_id"), rows_of(open_rejects)

    out_of_range, orphan = "RANGE:credit_score", "FOREIGN_KEY:account_id"
    assert run(["A"], scores, DAY) == (
        ["S1"], [("S2", [orphan], DAY), ("S3", [out_of_range, orphan], DAY)]
    )
    second = DAY + timedelta(days=14)
    for _ in range(2):
        assert run(["B"], none, second) == (["S1", "S2"], [("S3", [out_of_range], DAY)])
    assert ids(spark, f"{database}.risk_metrics") == ["A", "A", "B"]
    mended = stamped(make_scores({"score_id": "S3", "account_id": "B", "score_date": DAY}), 1)
    assert run([], mended, second) == (["S1", "S2", "S3"], [])


def test_a_rejected_account_stays_listed_until_it_is_valid(spark, database, make_accounts, make_scores):
    none = stamped(make_scores().limit(0))
    bad = stamped(make_accounts(("A", "80.00", "0.00")))
    catalog.run_cycle(spark, database, bad, none, DAY)
    later = DAY + timedelta(days=14)
    catalog.run_cycle(spark, database, bad.limit(0), none, later)
    listed = spark.table(f"{database}.rejected_accounts").select("account_id", "reasons", "rejected_on")
    assert rows_of(listed) == [("A", ["POSITIVE:property_value"], DAY)]
    catalog.run_cycle(spark, database, stamped(make_accounts(("A", "80.00", "100.00")), 1), none, later)
    assert spark.table(f"{database}.rejected_accounts").isEmpty() and ids(spark, f"{database}.mortgage_accounts") == ["A"]


def test_metrics_that_cannot_be_stored_are_listed(spark, database, make_accounts, make_scores):
    accounts = stamped(make_accounts(("A", "80.00", "100.00"), ("B", "99999999.00", "0.01")))
    scores = stamped(make_scores({"score_id": "S1", "account_id": "A"}, {"score_id": "S2", "account_id": "B"}))
    catalog.run_cycle(spark, database, accounts, scores, date(2024, 1, 1))
    refused = spark.table(f"{database}.rejected_metrics").select("account_id", "score_id", "reasons")
    assert rows_of(refused) == [("B", "S2", ["LTV_OUT_OF_RANGE"])]


def test_cycles_over_carried_state_equal_metrics_from_scratch(spark, database, make_accounts, make_scores):
    """Rows that arrive late or early included; and the old observations are not read again."""
    accounts = make_accounts(*((f"A{k}", "80.00", "100.00") for k in range(20)))
    batches = [
        make_scores(*(
            {
                "score_id": f"S{batch}{k:04d}", "account_id": f"A{k % 20}",
                "score_date": DAY + timedelta(days=(k * 37 + batch * 11) % 120 - 100),
                "credit_score": 560 + (k * 53 + batch * 7) % 240, "derogatory_marks": (k + batch) % 4,
                "credit_utilization_pct": Decimal((k * 7) % 100),
            }
            for k in range(1000 if batch == 0 else 40)
        ))
        for batch in range(3)
    ]
    known = None
    for number, batch in enumerate(batches):
        as_of = DAY + timedelta(days=28 * number)
        known = batch if known is None else known.unionByName(batch)
        catalog.run_cycle(spark, database, stamped(accounts), stamped(batch), as_of)
        stored = spark.table(f"{database}.risk_metrics").filter(F.col("calculation_date") == F.lit(as_of))
        expected = metrics.build_risk_metrics(accounts, known, as_of, CONTRACT)
        assert rows_of(stored.select(*expected.columns)) == rows_of(expected)
    # An earlier date than all states, and one between two of them.
    for as_of in (DAY - timedelta(days=10), DAY + timedelta(days=14)):
        catalog.carry_state(spark, database, as_of, CONTRACT)
        state = spark.table(f"{database}.score_state").filter(F.col("calculation_date") == F.lit(as_of))
        built = catalog.metrics_from_state(accounts, state, as_of, CONTRACT)
        assert rows_of(built) == rows_of(metrics.build_risk_metrics(accounts, known, as_of, CONTRACT))

    # One state row per account and whatever is new or was pending: the 1,000 old rows stay unread.
    late = DAY + timedelta(days=56)
    waiting = spark.table(f"{database}.score_pending").filter(F.col("calculation_date") == F.lit(late)).count()
    read = records_read(
        spark, lambda: catalog.carry_state(spark, database, late + timedelta(days=14), CONTRACT)
    )
    assert waiting == 0 and 20 <= read < 200


def test_states_beyond_the_kept_ones_go(spark, database, make_accounts, make_scores):
    loads = catalog.create_loads(spark, database)
    catalog.append_load(make_scores({"score_date": DAY}), loads, 1)
    for k in range(4):
        catalog.carry_state(spark, database, DAY + timedelta(days=k), CONTRACT, keep=2)
    kept = spark.table(f"{database}.score_state").select("calculation_date")
    assert rows_of(kept) == [(DAY + timedelta(days=2),), (DAY + timedelta(days=3),)]


def test_observations_stored_before_become_the_first_load(spark, database, make_scores):
    catalog.create_tables(spark, database)
    table = f"{database}.credit_scores"
    catalog.append_new(make_scores({"score_id": "S1"}), table, "score_id")
    for _ in range(2):
        loads = catalog.create_loads(spark, database)
        assert ids(spark, table, "score_id") == ["S1"] and spark.table(loads).first()["load"] == 0
