from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest

from loanrisk.session import local_session
from loanrisk.sources.schemas import CREDIT_SCORES, MORTGAGE_ACCOUNTS

TESTDATA = os.environ.get("LOANRISK_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        4,
        4,
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.ui.showConsoleProgress": "false",
            # Some tests count what tasks read.
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": str(tmp_path_factory.mktemp("events")),
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def make_accounts(spark):
    """Accounts from (id, loan, value); a plain account apart from these."""

    def make(*rows, schema=MORTGAGE_ACCOUNTS):
        return spark.createDataFrame(
            [
                (i, f"CUST{i}", Decimal(value), Decimal(loan), Decimal("4.500"), 300,
                 date(2020, 1, 1), "ON", "Condo", "Full-Time", Decimal("90000.00"))
                for i, loan, value in rows
            ],
            schema,
        )

    return make


@pytest.fixture(scope="session")
def make_scores(spark):
    """Observations from dicts with the columns that matter; the rest are unremarkable."""

    def make(*rows, schema=CREDIT_SCORES):
        defaults = {
            "account_id": "A",
            "score_date": date(2024, 1, 1),
            "credit_score": 700,
            "score_source": "Equifax",
            "payment_history_score": 90,
            "credit_utilization_pct": Decimal("30.00"),
            "total_accounts": 5,
            "derogatory_marks": 0,
        }
        full = [
            {**defaults, "score_id": f"S{number:04d}", **row} for number, row in enumerate(rows)
        ]
        return spark.createDataFrame(
            [tuple(row[name] for name in schema.names) for row in full], schema
        )

    return make


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())
