"""The domain tables derived lazily from the given ``customer`` and ``orders`` tables.

One customer becomes one account and one order one credit observation. Only integer
arithmetic is used, so every engine derives identical rows. The ``raw`` variants carry
deliberate defects for the staging and data-quality operators.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loanrisk.policy import DOMAINS
from loanrisk.sources.schemas import CREDIT_SCORES, MORTGAGE_ACCOUNTS, staged

ANCHOR = date(2024, 1, 1)

_CUSTOMER = "c_custkey bigint, c_nationkey int, c_mktsegment string"
_ORDERS = "o_orderkey bigint, o_custkey bigint"
# Moves the years of the orders' own dates to those of the observations.
_MONTHS_LATER = 269


def _key(prefix: str, number: str, width: int) -> str:
    """Zero-padded key; keys longer than ``width`` stay whole."""
    digits = f"CAST({number} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"array({listed})[CAST({index} AS INT)]"


def _scaled(number: str, unit: str) -> str:
    return f"CAST({number} AS DECIMAL(18,0)) * {unit}BD"


def _days_before_anchor(days: str) -> str:
    return f"date_sub(DATE '{ANCHOR}', CAST({days} AS INT))"


_VALUE = "(300000 + (c_custkey * 7919 + 13) % 1200001)"
_BASIS_POINTS = "(5000 + (c_custkey * 104729 + 7) % 4501)"

_ACCOUNT = {
    "account_id": _key("MTG", "c_custkey", 8),
    "customer_id": "concat('CUST', CAST(c_custkey % 9000 + 1000 AS STRING))",
    "property_value": _VALUE,
    "loan_amount": _scaled(f"{_VALUE} * {_BASIS_POINTS} div 100", "0.01"),
    "interest_rate": _scaled("(2500 + (c_custkey * 1597) % 4001)", "0.001"),
    "loan_term_months": "180 + 60 * (c_custkey % 4)",
    "origination_date": _days_before_anchor("(c_custkey * 2741) % 3651"),
    "property_province": _pick(DOMAINS["property_province"], "c_nationkey % 10"),
    "property_type": _pick(DOMAINS["property_type"], "(c_custkey * 13 + c_nationkey) % 4"),
    "employment_status": """CASE c_mktsegment
        WHEN 'AUTOMOBILE' THEN 'Full-Time' WHEN 'BUILDING' THEN 'Part-Time'
        WHEN 'FURNITURE' THEN 'Self-Employed' WHEN 'HOUSEHOLD' THEN 'Retired'
        ELSE 'Contract' END""",
    "annual_income": "50000 + (c_custkey * 15485863) % 200001",
}

_SCORE = {
    "score_id": _key("SCR", "o_orderkey", 10),
    "account_id": _key("MTG", "o_custkey", 8),
    "score_date": _days_before_anchor("(o_orderkey * 7907 + o_custkey * 31) % 731"),
    "credit_score": """greatest(300, least(900,
        550 + (o_custkey * 613) % 301 + (o_orderkey * 389) % 61 - 30))""",
    "score_source": "CASE WHEN o_orderkey % 2 = 0 THEN 'Equifax' ELSE 'TransUnion' END",
    "payment_history_score": "50 + (o_orderkey * 17) % 51",
    "credit_utilization_pct": _scaled("(1000 + (o_orderkey * 4013) % 8001)", "0.01"),
    "total_accounts": "3 + (o_orderkey * 23) % 18",
    "derogatory_marks": "(o_orderkey * 101 + o_custkey) % 6",
}


def _typed(expressions: dict[str, str], schema: StructType) -> list[str]:
    return [
        f"CAST({expressions[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema
    ]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_CUSTOMER).parquet(f"{sf_dir}/customer.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")


def mortgage_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).selectExpr(*_typed(_ACCOUNT, MORTGAGE_ACCOUNTS))


def credit_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(*_typed(_SCORE, CREDIT_SCORES))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as events of their account, on their own dates moved by a fixed number of months."""
    orders = spark.read.schema(f"{_ORDERS}, o_orderdate timestamp").parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(
        "o_orderkey AS order_id",
        f"{_SCORE['account_id']} AS account_id",
        f"add_months(CAST(o_orderdate AS DATE), {_MONTHS_LATER}) AS order_date",
    )


def credit_scores_misfiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All observations, those of every 131st account filed under the account after it."""
    filed = "o_custkey + CASE WHEN o_custkey % 131 = 0 THEN 1 ELSE 0 END"
    columns = {**_SCORE, "account_id": _key("MTG", f"({filed})", 8)}
    return _orders(spark, sf_dir).selectExpr(*_typed(columns, CREDIT_SCORES))


def _with_versions(df: DataFrame, second: str) -> DataFrame:
    """Arrival number 0 for every row, and a second version, 1, where ``second`` holds."""
    return df.selectExpr(
        "*", f"explode(CASE WHEN {second} THEN array(0, 1) ELSE array(0) END) AS ingest_seq"
    )


def _with_defects(
    clean: dict[str, str],
    key: str,
    defects: dict[str, list[tuple[int, str]]],
    later: dict[str, str],
) -> dict[str, str]:
    """First versions take a column's defect on every n-th key, the first one listed that
    applies; second ones are clean but for the ``later`` value."""
    columns = {"ingest_seq": "ingest_seq"}
    for name, value in clean.items():
        branches = ""
        for every, broken in defects.get(name, []):
            branches += f" WHEN ingest_seq = 0 AND {key} % {every} = 0 THEN {broken}"
        if name in later:
            branches += f" WHEN ingest_seq = 1 THEN {later[name]}"
        columns[name] = f"CASE{branches} ELSE {value} END" if branches else value
    return columns


def credit_scores_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged observations with broken keys, ranges, spellings and duplicates."""
    score = _SCORE["credit_score"]
    columns = _with_defects(
        _SCORE,
        "o_orderkey",
        defects={
            "account_id": [(103, f"concat('X', substring({_SCORE['account_id']}, 2))")],
            "credit_score": [(101, f"{score} + 600"), (79, "NULL")],
            "payment_history_score": [(83, f"{_SCORE['payment_history_score']} + 100")],
            "credit_utilization_pct": [(107, "NULL")],
            "score_source": [(89, f"concat(' ', lower({_SCORE['score_source']}))")],
            "derogatory_marks": [(73, "NULL")],
        },
        later={"credit_score": f"least(900, {score} + 1)"},
    )
    rows = _with_versions(_orders(spark, sf_dir), "o_orderkey % 97 = 0")
    return rows.selectExpr(*_typed(columns, staged(CREDIT_SCORES)))


def mortgage_accounts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged account versions with broken values, spellings and updates."""
    columns = _with_defects(
        _ACCOUNT,
        "c_custkey",
        defects={
            "property_value": [(113, "0"), (109, f"-{_VALUE}"), (107, "0.01")],
            "property_province": [
                (89, f"concat(' ', lower({_ACCOUNT['property_province']}), ' ')")
            ],
            "property_type": [(97, "'Houseboat'")],
            "employment_status": [(101, "NULL")],
        },
        later={"property_value": f"{_VALUE} + 25000"},
    )
    rows = _with_versions(_customers(spark, sf_dir), "c_custkey % 103 = 0")
    return rows.selectExpr(*_typed(columns, staged(MORTGAGE_ACCOUNTS)))
