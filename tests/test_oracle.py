"""Every registered query against its SQL on the given tables, value by value."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from loanrisk.plans import oracle, registry
from tests.conftest import TESTDATA

SCALES = os.environ.get("LOANRISK_SCALES", "sf0.001").split(",")
SPARK_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


@pytest.fixture(scope="module", params=SCALES)
def scale(request):
    connection = duckdb.connect()
    directory = f"{TESTDATA}/{request.param}"
    for table in ("customer", "orders"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'"
        )
    return directory, connection


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_sql(spark, scale, name):
    directory, connection = scale
    df = entry_point.queries()[name](spark, directory)
    columns = sorted(df.columns)

    relation = connection.sql(entry_point.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert [SPARK_TYPES[types[c]] for c in columns] == [
        df.schema[c].dataType.simpleString() for c in columns
    ]

    expected = sorted(map(repr, relation.select(*map(duckdb.ColumnExpression, columns)).fetchall()))
    actual = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    assert actual == expected
    # A load leaves none; the smallest tables have too few accounts for the other.
    empty = {"load_orphans"} | ({"append_orphans"} if directory.endswith("sf0.001") else set())
    assert bool(actual) == (name not in empty)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 5


def test_portfolio_report_is_ordered_by_tier(spark, sf_dir):
    report = entry_point.queries()["portfolio_risk_summary"](spark, sf_dir).collect()
    assert [row["risk_category"] for row in report] == [
        "Very Low Risk", "Low Risk", "Medium Risk", "High Risk", "Very High Risk",
    ]


def test_ranked_reports_are_ordered(spark, sf_dir):
    top = entry_point.queries()["high_risk_accounts_top10"](spark, sf_dir).collect()
    risk = [row["risk_score"] for row in top]
    assert risk == sorted(risk, reverse=True) and len(top) == 10
    trend = entry_point.queries()["credit_score_trends_top5"](spark, sf_dir).collect()
    assert [r["account_id"] for r in trend] == sorted(r["account_id"] for r in trend)
    for before, after in zip(trend, trend[1:]):
        if before["account_id"] == after["account_id"]:
            assert before["score_date"] >= after["score_date"]
