"""DuckDB SQL giving the same rows as the registered queries.

Written independently of the operators, in the most direct form: plain windows over whole
accounts, an inequality join for the point-in-time rows, integer half-up averages. Output
types match ``registry.comparable``: decimals as DOUBLE, dates and arrays as text.
"""

from __future__ import annotations


def _padded(expr: str, width: int) -> str:
    digits = f"CAST({expr} AS VARCHAR)"
    return f"lpad({digits}, CAST(greatest({width}, length({digits})) AS INTEGER), '0')"


# The codes a column may take, and how its values are spelt.
_ACCOUNT_BASE = f"""
account_base AS (
  SELECT c_custkey AS k,
         'MTG' || {_padded("c_custkey", 8)} AS account_id,
         'CUST' || CAST(c_custkey % 9000 + 1000 AS VARCHAR) AS customer_id,
         CAST(300000 + (c_custkey * 7919 + 13) % 1200001 AS BIGINT) AS pv,
         CAST(5000 + (c_custkey * 104729 + 7) % 4501 AS BIGINT) AS bp,
         CAST(2500 + (c_custkey * 1597) % 4001 AS DECIMAL(8,0)) * 0.001 AS interest_rate,
         CAST(180 + 60 * (c_custkey % 4) AS INTEGER) AS loan_term_months,
         DATE '2024-01-01' - CAST((c_custkey * 2741) % 3651 AS INTEGER) AS origination_date,
         ['ON','QC','BC','AB','MB','SK','NS','NB','PE','NL'][c_nationkey % 10 + 1]
           AS property_province,
         ['Single Family','Condo','Townhouse','Multi-Family'][(c_custkey * 13 + c_nationkey) % 4 + 1]
           AS property_type,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Full-Time' WHEN 'BUILDING' THEN 'Part-Time'
              WHEN 'FURNITURE' THEN 'Self-Employed' WHEN 'HOUSEHOLD' THEN 'Retired'
              ELSE 'Contract' END AS employment_status,
         CAST(50000 + (c_custkey * 15485863) % 200001 AS DECIMAL(15,2)) AS annual_income
  FROM customer
),
accounts AS (
  SELECT k, account_id, customer_id, CAST(pv AS DECIMAL(15,2)) AS property_value,
         CAST(CAST((pv * bp) // 100 AS DECIMAL(15,0)) * 0.01 AS DECIMAL(15,2)) AS loan_amount,
         interest_rate, loan_term_months, origination_date, property_province, property_type,
         employment_status, annual_income
  FROM account_base
),
scores AS (
  SELECT o_orderkey AS q,
         'SCR' || {_padded("o_orderkey", 10)} AS score_id,
         'MTG' || {_padded("o_custkey", 8)} AS account_id,
         DATE '2024-01-01' - CAST((o_orderkey * 7907 + o_custkey * 31) % 731 AS INTEGER)
           AS score_date,
         CAST(greatest(300, least(900,
           550 + (o_custkey * 613) % 301 + (o_orderkey * 389) % 61 - 30)) AS INTEGER) AS credit_score,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Equifax' ELSE 'TransUnion' END AS score_source,
         CAST(50 + (o_orderkey * 17) % 51 AS INTEGER) AS payment_history_score,
         CAST(CAST(1000 + (o_orderkey * 4013) % 8001 AS DECIMAL(8,0)) * 0.01 AS DECIMAL(5,2))
           AS credit_utilization_pct,
         CAST(3 + (o_orderkey * 23) % 18 AS INTEGER) AS total_accounts,
         CAST((o_orderkey * 101 + o_custkey) % 6 AS INTEGER) AS derogatory_marks
  FROM orders
)"""

# The same codes, and the allowed ranges.
_RAW = """
accounts_raw AS (
  SELECT * REPLACE (
           CASE WHEN k % 113 = 0 THEN 0 WHEN k % 109 = 0 THEN -property_value
                WHEN k % 107 = 0 THEN 0.01 ELSE property_value END AS property_value,
           CASE WHEN k % 89 = 0 THEN ' ' || lower(property_province) || ' '
                ELSE property_province END AS property_province,
           CASE WHEN k % 97 = 0 THEN 'Houseboat' ELSE property_type END AS property_type,
           CASE WHEN k % 101 = 0 THEN NULL ELSE employment_status END AS employment_status),
         0 AS ingest_seq
  FROM accounts
  UNION ALL
  SELECT * REPLACE (property_value + 25000 AS property_value), 1 FROM accounts WHERE k % 103 = 0
),
scores_raw AS (
  SELECT * REPLACE (
           CASE WHEN q % 103 = 0 THEN 'X' || substr(account_id, 2) ELSE account_id END AS account_id,
           CASE WHEN q % 101 = 0 THEN credit_score + 600 WHEN q % 79 = 0 THEN NULL
                ELSE credit_score END AS credit_score,
           CASE WHEN q % 83 = 0 THEN payment_history_score + 100
                ELSE payment_history_score END AS payment_history_score,
           CASE WHEN q % 107 = 0 THEN NULL ELSE credit_utilization_pct END AS credit_utilization_pct,
           CASE WHEN q % 89 = 0 THEN ' ' || lower(score_source) ELSE score_source END AS score_source,
           CASE WHEN q % 73 = 0 THEN NULL ELSE derogatory_marks END AS derogatory_marks),
         0 AS ingest_seq
  FROM scores
  UNION ALL
  SELECT * REPLACE (least(900, credit_score + 1) AS credit_score), 1 FROM scores WHERE q % 97 = 0
),
accounts_normal AS (
  SELECT * REPLACE (
    CASE WHEN upper(trim(property_province)) IN
              ('ON','QC','BC','AB','MB','SK','NS','NB','PE','NL')
         THEN upper(trim(property_province)) ELSE trim(property_province) END AS property_province,
    CASE lower(trim(property_type)) WHEN 'single family' THEN 'Single Family'
         WHEN 'condo' THEN 'Condo' WHEN 'townhouse' THEN 'Townhouse'
         WHEN 'multi-family' THEN 'Multi-Family' ELSE trim(property_type) END AS property_type,
    CASE lower(trim(employment_status)) WHEN 'full-time' THEN 'Full-Time'
         WHEN 'part-time' THEN 'Part-Time' WHEN 'self-employed' THEN 'Self-Employed'
         WHEN 'retired' THEN 'Retired' WHEN 'contract' THEN 'Contract'
         ELSE trim(employment_status) END AS employment_status)
  FROM accounts_raw
),
scores_normal AS (
  SELECT * REPLACE (
    CASE lower(trim(score_source)) WHEN 'equifax' THEN 'Equifax'
         WHEN 'transunion' THEN 'TransUnion' ELSE trim(score_source) END AS score_source)
  FROM scores_raw
),
scores_clean AS (
  SELECT * FROM scores_normal
  QUALIFY row_number() OVER (PARTITION BY score_id ORDER BY ingest_seq DESC) = 1
),
scores_judged AS (
  SELECT s.*, concat_ws('|',
    CASE WHEN credit_score IS NULL THEN 'NOT_NULL:credit_score' END,
    CASE WHEN derogatory_marks IS NULL THEN 'NOT_NULL:derogatory_marks' END,
    CASE WHEN credit_utilization_pct IS NULL THEN 'NOT_NULL:credit_utilization_pct' END,
    CASE WHEN credit_score NOT BETWEEN 300 AND 900 THEN 'RANGE:credit_score' END,
    CASE WHEN payment_history_score NOT BETWEEN 0 AND 100 THEN 'RANGE:payment_history_score' END,
    CASE WHEN credit_utilization_pct NOT BETWEEN 0 AND 100 THEN 'RANGE:credit_utilization_pct' END,
    CASE WHEN score_source NOT IN ('Equifax','TransUnion') THEN 'DOMAIN:score_source' END,
    CASE WHEN account_id NOT IN (SELECT account_id FROM accounts)
         THEN 'FOREIGN_KEY:account_id' END) AS reasons
  FROM scores_clean s
),
accounts_valid AS (
  SELECT * FROM (
    SELECT * FROM accounts_normal
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY ingest_seq DESC) = 1)
  WHERE property_value > 0 AND employment_status IS NOT NULL
    AND property_type IN ('Single Family','Condo','Townhouse','Multi-Family')
),
accounts_loaded AS (
  SELECT account_id FROM accounts_valid
  UNION SELECT account_id FROM accounts WHERE origination_date < DATE '2023-01-01'
),
scores_unloaded AS (
  SELECT * FROM scores_judged WHERE score_id NOT IN
    (SELECT score_id FROM scores WHERE score_date < DATE '2023-07-01')
),
coded_raw AS (
  SELECT s.*, s.credit_score IS NULL OR derogatory_marks IS NULL
           OR credit_utilization_pct IS NULL AS score_unknown
  FROM (SELECT * FROM scores_clean
        QUALIFY row_number() OVER (PARTITION BY account_id
                                   ORDER BY score_date DESC, score_id DESC) = 1) s
  JOIN accounts USING (account_id)
)"""

# Tiers with score cut, default probability and action texts.
_TIERS = """
         CASE WHEN credit_score >= 750 THEN 'Very Low Risk' WHEN credit_score >= 700 THEN 'Low Risk'
              WHEN credit_score >= 650 THEN 'Medium Risk' WHEN credit_score >= 600 THEN 'High Risk'
              ELSE 'Very High Risk' END AS risk_category,
         CASE WHEN credit_score >= 750 THEN 0.005 WHEN credit_score >= 700 THEN 0.02
              WHEN credit_score >= 650 THEN 0.05 WHEN credit_score >= 600 THEN 0.11
              ELSE 0.2 END AS default_probability,
         CASE WHEN credit_score >= 700 THEN 'Continue routine monitoring'
              WHEN credit_score >= 650 THEN 'Standard monitoring with monthly reviews'
              WHEN credit_score >= 600 THEN 'Enhanced monitoring - Weekly check-ins'
              ELSE 'Immediate review required - Consider workout options' END AS recommended_action"""

# Every observation with its history; ``seen`` holds one row per (account, date) in force.
_HISTORY = """
observed AS (
  SELECT *, lag(derogatory_marks) OVER ordered AS previous_marks,
         lag(credit_score) OVER ordered AS previous_score,
         lag(score_date) OVER ordered AS previous_date,
         max(credit_score) OVER (PARTITION BY account_id ORDER BY score_date
           RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW) AS window_high,
         row_number() OVER (PARTITION BY account_id ORDER BY score_date DESC, score_id DESC)
           AS recency
  FROM scores
  WINDOW ordered AS (PARTITION BY account_id ORDER BY score_date, score_id)
),
newest AS (SELECT *, DATE '2024-01-01' AS as_of FROM observed WHERE recency = 1)"""

_SEEN = """
dates AS (SELECT DATE '2023-01-02' + CAST(14 * i AS INTEGER) AS as_of FROM range(27) r(i)),
newest AS (
  SELECT o.*, d.as_of FROM dates d JOIN observed o ON o.score_date <= d.as_of
  QUALIFY row_number() OVER (PARTITION BY o.account_id, d.as_of
                             ORDER BY o.score_date DESC, o.score_id DESC) = 1
)"""

_ASSESSED = f"""
assessed AS (
  SELECT n.*, a.customer_id, a.property_province, a.loan_amount,
         CAST(a.loan_amount AS DOUBLE) / CAST(a.property_value AS DOUBLE) * 100 AS ltv,
         (1 - CAST(credit_score AS DOUBLE) / 900) * 40
           + (CAST(a.loan_amount AS DOUBLE) / CAST(a.property_value AS DOUBLE) * 100) / 100 * 35
           + CAST(derogatory_marks AS DOUBLE) / 10 * 15
           + CAST(credit_utilization_pct AS DOUBLE) / 100 * 10 AS composite,
         {_TIERS.strip()}
  FROM newest n JOIN accounts a ON a.account_id = n.account_id
),
coded AS (
  SELECT *, CAST(ltv AS DECIMAL(6,2)) AS current_ltv,
         CAST(composite * 100 AS DECIMAL(6,2)) AS risk_score,
         concat_ws('|', CASE WHEN ltv > 80 THEN 'HIGH_LTV' ELSE 'NULL' END,
           CASE WHEN credit_score < 650 THEN 'LOW_CREDIT' ELSE 'NULL' END,
           CASE WHEN derogatory_marks > 0 THEN 'DEROGATORY_MARKS' ELSE 'NULL' END,
           CASE WHEN credit_utilization_pct > 75 THEN 'HIGH_UTILIZATION' ELSE 'NULL' END) AS risk_flags
  FROM assessed
),
contract AS (
  SELECT *, CAST(ltv AS DECIMAL(6,2)) AS current_ltv,
         CAST(greatest(0, least(100, composite)) AS DECIMAL(5,2)) AS risk_score,
         concat_ws('|', CASE WHEN ltv > 80 THEN 'HIGH_LTV' END,
           CASE WHEN credit_score < 650 THEN 'LOW_CREDIT' END,
           CASE WHEN window_high - credit_score > 50 THEN 'SCORE_DECLINE' END,
           CASE WHEN derogatory_marks > coalesce(previous_marks, 0) THEN 'DEROGATORY_MARKS' END,
           CASE WHEN credit_utilization_pct > 75 THEN 'HIGH_UTILIZATION' END,
           CASE WHEN payment_history_score < 60 THEN 'PAYMENT_ISSUES' END) AS risk_flags
  FROM assessed
)"""

_BASE = f"WITH {_ACCOUNT_BASE.strip()},{_RAW},{_HISTORY},{_ASSESSED}"
_DATED = (
    f"WITH {_ACCOUNT_BASE.strip()},{_HISTORY.replace('newest AS (SELECT', 'unused AS (SELECT')},"
    f"{_SEEN},{_ASSESSED}"
)

_METRICS = """
SELECT 'RISK' || strftime(as_of, '%Y%m%d') || account_id AS metric_id, account_id,
       CAST(as_of AS VARCHAR) AS calculation_date, CAST(current_ltv AS DOUBLE) AS current_ltv,
       credit_score AS latest_credit_score, CAST(risk_score AS DOUBLE) AS risk_score_normalized,
       risk_category, CAST(default_probability AS DOUBLE) AS default_probability,
       recommended_action, risk_flags
FROM {source}"""

_ACCOUNT_COLUMNS = """account_id, customer_id, CAST(property_value AS DOUBLE) AS property_value,
       CAST(loan_amount AS DOUBLE) AS loan_amount, CAST(interest_rate AS DOUBLE) AS interest_rate,
       loan_term_months, CAST(origination_date AS VARCHAR) AS origination_date,
       property_province, property_type, employment_status,
       CAST(annual_income AS DOUBLE) AS annual_income"""

_SCORE_COLUMNS = """score_id, account_id, CAST(score_date AS VARCHAR) AS score_date, credit_score,
       score_source, payment_history_score,
       CAST(credit_utilization_pct AS DOUBLE) AS credit_utilization_pct, total_accounts,
       derogatory_marks"""


def _average(column: str) -> str:
    """Average in hundredths, rounded half up in integers."""
    return f"((2 * CAST(sum({column}) * 100 AS BIGINT) + count(*)) // (2 * count(*)))"


def _summary(
    source: str, flagged: str, shown: str = "risk_category", by: str = "risk_category"
) -> str:
    return f"""
SELECT {shown}, count(*) AS account_count,
       CAST(sum(loan_amount) AS DOUBLE) AS total_loan_amount,
       {_average("credit_score")} / 100 AS avg_credit_score,
       {_average("current_ltv")} / 100 AS avg_ltv,
       {_average("risk_score")} / 100 AS avg_risk_score,
       CAST(sum(CASE WHEN {flagged} THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_flags
FROM {source} GROUP BY {by}"""


def _violations(table: str, key: str, rule: str, column: str, source: str, broken: str) -> str:
    return f"""
SELECT '{table}' AS table_name, {key} AS row_key, '{rule}' AS rule, '{column}' AS column_name,
       CAST({column} AS VARCHAR) AS value
FROM {source} WHERE {broken}"""


def _nulls(table: str, column: str, source: str) -> str:
    return f"""
SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS null_rows
FROM {source} WHERE {column} IS NULL HAVING count(*) > 0"""


def _copies(table: str, key: str, source: str) -> str:
    return f"""
SELECT '{table}' AS table_name, {key} AS key_value, count(*) AS copies
FROM {source} GROUP BY ALL HAVING count(*) > 1"""


def _orphans(table: str, key: str, source: str) -> str:
    return f"""
SELECT '{table}' AS table_name, {key} AS row_key, account_id AS missing_parent
FROM {source} c WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = c.account_id)"""


_DATED_ORDERS = f"""
SELECT o_orderkey AS order_id, 'MTG' || {_padded("o_custkey", 8)} AS account_id,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 269 MONTH AS DATE) AS order_date
FROM orders"""

_UNION = "\nUNION ALL\n"
_CODED_ROWS = f"({_METRICS.format(source='coded').strip()})"
_CONTRACT_ROWS = f"({_METRICS.format(source='contract').strip()})"


# Fixed values in the queries below: flag actions, tier ranges and portfolio actions, loan-to-value
# bands, allowed codes and ranges.
def _bodies() -> dict[str, str]:
    required_accounts = (
        "account_id", "customer_id", "property_value", "loan_amount", "interest_rate",
        "loan_term_months", "origination_date", "property_province", "property_type",
        "employment_status", "annual_income",
    )
    required_scores = (
        "score_id", "account_id", "score_date", "credit_score", "score_source",
        "total_accounts", "derogatory_marks",
    )
    return {
        "mortgage_accounts": f"SELECT {_ACCOUNT_COLUMNS} FROM accounts",
        "credit_scores": f"SELECT {_SCORE_COLUMNS} FROM scores",
        "latest_scores": """
SELECT account_id, credit_score AS latest_credit_score, derogatory_marks,
       CAST(credit_utilization_pct AS DOUBLE) AS credit_utilization_pct FROM newest""",
        "risk_metrics_as_coded": _METRICS.format(source="coded"),
        "risk_metrics": _METRICS.format(source="contract"),
        "risk_summary_as_coded": _summary("coded", "TRUE"),
        "risk_summary": _summary("contract", "risk_flags <> ''"),
        "portfolio_risk_summary": f"""
SELECT risk_category, account_count, format('${{:,.2f}}', total_loan_amount) AS total_loan_amount,
       avg_credit_score, format('{{:.2f}}%', avg_ltv) AS avg_ltv, avg_risk_score, high_risk_flags
FROM ({_summary("coded", "TRUE")})""",
        "high_risk_accounts_top10": """
SELECT account_id, customer_id, property_province,
       format('${:,.2f}', CAST(loan_amount AS DOUBLE)) AS loan_amount,
       credit_score AS latest_credit_score,
       CAST(CAST(round(current_ltv, 1) AS DECIMAL(6,1)) AS VARCHAR) || '%' AS current_ltv,
       CAST(round(risk_score, 1) AS DOUBLE) AS risk_score, risk_category, risk_flags,
       recommended_action
FROM coded x WHERE risk_category IN ('High Risk', 'Very High Risk')
ORDER BY x.risk_score DESC, account_id LIMIT 10""",
        "credit_score_trends_top5": """
SELECT account_id, score_id, CAST(score_date AS VARCHAR) AS score_date, credit_score, score_source,
       derogatory_marks,
       CAST(CAST(round(credit_utilization_pct, 1) AS DECIMAL(5,1)) AS VARCHAR) || '%'
         AS credit_utilization
FROM scores WHERE account_id IN
  (SELECT account_id FROM coded ORDER BY risk_score DESC, account_id LIMIT 5)""",
        "load_counts": """
SELECT 'mortgage_accounts' AS table_name, count(*) AS row_count FROM accounts
UNION ALL SELECT 'credit_scores', count(*) FROM scores
UNION ALL SELECT 'risk_metrics', count(*) FROM coded""",
        "ltv_bands": """
SELECT CASE WHEN ltv < 65 THEN 'excellent' WHEN ltv <= 80 THEN 'standard'
            WHEN ltv <= 95 THEN 'elevated' WHEN ltv > 95 THEN 'high' END AS ltv_band,
       count(*) AS account_count, CAST(sum(loan_amount) AS DOUBLE) AS total_loan_amount
FROM (SELECT loan_amount,
             CAST(loan_amount AS DOUBLE) / CAST(property_value AS DOUBLE) * 100 AS ltv FROM accounts)
GROUP BY ltv_band""",
        "risk_flag_counts": """
SELECT risk_flag, count(*) AS account_count
FROM (SELECT unnest(string_split(risk_flags, '|')) AS risk_flag FROM contract
      WHERE risk_flags <> '')
GROUP BY risk_flag""",
        "flag_actions": """
SELECT account_id, CAST(as_of AS VARCHAR) AS calculation_date, risk_flag,
       CASE risk_flag WHEN 'HIGH_LTV' THEN 'Enhanced monitoring'
            WHEN 'LOW_CREDIT' THEN 'Credit counseling referral'
            WHEN 'SCORE_DECLINE' THEN 'Risk review'
            WHEN 'DEROGATORY_MARKS' THEN 'Account investigation'
            WHEN 'HIGH_UTILIZATION' THEN 'Financial stress indicator'
            WHEN 'PAYMENT_ISSUES' THEN 'Collections alert' END AS flag_action
FROM (SELECT account_id, as_of, unnest(string_split(risk_flags, '|')) AS risk_flag FROM contract
      WHERE risk_flags <> '')""",
        "tier_policy_lookup": """
SELECT account_id, c.risk_category, tier_rank,
       CAST(default_probability AS DOUBLE) AS default_probability,
       CAST(pd_low AS DOUBLE) AS pd_low, CAST(pd_high AS DOUBLE) AS pd_high, portfolio_action
FROM contract c JOIN (VALUES
  ('Very Low Risk', 1, 0.0, 0.01, 'Standard monitoring'),
  ('Low Risk', 2, 0.01, 0.03, 'Quarterly review'),
  ('Medium Risk', 3, 0.03, 0.07, 'Monthly review + enhanced monitoring'),
  ('High Risk', 4, 0.07, 0.15, 'Weekly review + intervention planning'),
  ('Very High Risk', 5, 0.15, 1.0, 'Daily monitoring + immediate action'))
  t(risk_category, tier_rank, pd_low, pd_high, portfolio_action)
  ON t.risk_category = c.risk_category""",
        "score_decline_90d": """
SELECT account_id, CAST(score_date AS VARCHAR) AS score_date, credit_score AS latest_credit_score,
       window_high, window_high - credit_score AS score_drop
FROM newest WHERE window_high - credit_score > 50""",
        "new_derogatory_marks": """
SELECT account_id, CAST(score_date AS VARCHAR) AS score_date, derogatory_marks, previous_marks,
       derogatory_marks - coalesce(previous_marks, 0) AS new_marks
FROM newest WHERE derogatory_marks > coalesce(previous_marks, 0)""",
        "payment_issues": """
SELECT account_id, score_id, CAST(score_date AS VARCHAR) AS score_date, payment_history_score
FROM newest WHERE payment_history_score < 60""",
        "score_trend": """
SELECT account_id, observations, first_score, latest_score,
       latest_score - first_score AS score_change,
       CASE WHEN latest_score > first_score THEN 'improving'
            WHEN latest_score < first_score THEN 'deteriorating' ELSE 'stable' END AS trend
FROM (SELECT account_id, count(*) AS observations,
             first(credit_score ORDER BY score_date, score_id) AS first_score,
             last(credit_score ORDER BY score_date, score_id) AS latest_score
      FROM scores GROUP BY account_id)""",
        "score_progression": """
SELECT account_id, score_id, CAST(score_date AS VARCHAR) AS score_date, credit_score,
       previous_score, credit_score - previous_score AS score_change,
       CAST(score_date - previous_date AS INTEGER) AS days_since_previous
FROM observed""",
        "high_risk_alerts": """
SELECT CAST(as_of AS VARCHAR) AS calculation_date, account_id, risk_category,
       credit_score AS latest_credit_score, CAST(risk_score AS DOUBLE) AS risk_score_normalized,
       recommended_action, risk_flags
FROM contract WHERE risk_category IN ('High Risk', 'Very High Risk')""",
        "accounts_without_scores": """
SELECT account_id, customer_id FROM accounts
WHERE k NOT IN (SELECT o_custkey + CASE WHEN o_custkey % 131 = 0 THEN 1 ELSE 0 END FROM orders)""",
        "normalize_staging": """
SELECT account_id, ingest_seq, property_province, property_type, employment_status
FROM accounts_normal""",
        "normalize_staging_scores": "SELECT score_id, ingest_seq, score_source FROM scores_normal",
        "dedupe_scores": f"SELECT {_SCORE_COLUMNS}, ingest_seq FROM scores_clean",
        "staging_quarantine": """
SELECT score_id, account_id, ingest_seq,
       CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS status, reasons
FROM scores_judged""",
        "metric_rejects": """
SELECT account_id, score_id, concat_ws('|',
         CASE WHEN property_value <= 0 THEN 'LTV_UNDEFINED' END,
         CASE WHEN property_value > 0 AND
                CAST(loan_amount AS DOUBLE) / CAST(property_value AS DOUBLE) * 100 >= 9999.995
              THEN 'LTV_OUT_OF_RANGE' END,
         CASE WHEN credit_score IS NULL THEN 'SCORE_MISSING' END,
         CASE WHEN derogatory_marks IS NULL THEN 'MARKS_MISSING' END,
         CASE WHEN credit_utilization_pct IS NULL THEN 'UTILIZATION_MISSING' END) AS reasons
FROM (SELECT * FROM accounts_raw
      QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY ingest_seq DESC) = 1) a
JOIN (SELECT account_id, score_id, credit_score, derogatory_marks, credit_utilization_pct
      FROM scores_clean
      QUALIFY row_number() OVER (PARTITION BY account_id
                                 ORDER BY score_date DESC, score_id DESC) = 1) s
  USING (account_id)
WHERE reasons <> ''""",
        "dq_primary_key_violations": _UNION.join([
            _copies("mortgage_accounts", "account_id", "accounts_raw"),
            _copies("credit_scores", "score_id", "scores_raw"),
            _copies("risk_metrics", "metric_id", _CODED_ROWS),
        ]),
        "dq_foreign_key_violations": _UNION.join([
            _orphans("credit_scores", "score_id", "scores_raw"),
            _orphans("risk_metrics", "metric_id", _CODED_ROWS),
        ]),
        "dq_check_violations": _UNION.join(
            _violations("credit_scores", "score_id", "RANGE", column, "scores_raw",
                        f"{column} NOT BETWEEN {low} AND {high}")
            for column, low, high in (
                ("credit_score", 300, 900),
                ("payment_history_score", 0, 100),
                ("credit_utilization_pct", 0, 100),
            )
        ),
        "dq_metric_check_violations": _UNION.join(
            _violations(name, "metric_id", "RANGE", column, source,
                        f"{column} NOT BETWEEN 0 AND {high}")
            for name, source in (
                ("as_coded", _CODED_ROWS.replace("CAST(risk_score AS DOUBLE)", "risk_score")),
                ("contract", _CONTRACT_ROWS.replace("CAST(risk_score AS DOUBLE)", "risk_score")),
            )
            for column, high in (("risk_score_normalized", 100), ("default_probability", 1))
        ),
        "dq_not_null_violations": _UNION.join(
            [_nulls("mortgage_accounts", c, "accounts_raw") for c in required_accounts]
            + [_nulls("credit_scores", c, "scores_raw") for c in required_scores]
            + ["""
SELECT 'risk_metrics' AS table_name, 'latest_credit_score' AS column_name, count(*) AS null_rows
FROM coded_raw WHERE credit_score IS NULL HAVING count(*) > 0""", """
SELECT 'risk_metrics' AS table_name, 'risk_score_normalized' AS column_name, count(*) AS null_rows
FROM coded_raw WHERE score_unknown HAVING count(*) > 0"""]
        ),
        "dq_domain_violations": _UNION.join([
            _violations("mortgage_accounts", "account_id", "DOMAIN", "property_province",
                        "accounts_raw", "property_province NOT IN "
                        "('ON','QC','BC','AB','MB','SK','NS','NB','PE','NL')"),
            _violations("mortgage_accounts", "account_id", "DOMAIN", "property_type",
                        "accounts_raw", "property_type NOT IN "
                        "('Single Family','Condo','Townhouse','Multi-Family')"),
            _violations("mortgage_accounts", "account_id", "DOMAIN", "employment_status",
                        "accounts_raw", "employment_status NOT IN "
                        "('Full-Time','Part-Time','Self-Employed','Retired','Contract')"),
            _violations("credit_scores", "score_id", "DOMAIN", "score_source", "scores_raw",
                        "score_source NOT IN ('Equifax','TransUnion')"),
            _violations("risk_metrics", "metric_id", "DOMAIN", "risk_category", _CODED_ROWS,
                        "risk_category NOT IN ('Very Low Risk','Low Risk','Medium Risk',"
                        "'High Risk','Very High Risk')"),
        ]),
        "risk_metrics_carried": _METRICS.format(source="contract"),
        "orders_as_of_scores": f"""
SELECT order_id, o.account_id, CAST(order_date AS VARCHAR) AS order_date, score_id,
       CAST(score_date AS VARCHAR) AS score_date, credit_score
FROM ({_DATED_ORDERS}) o LEFT JOIN scores s ON s.account_id = o.account_id AND score_date <= order_date
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY score_date DESC, score_id DESC) = 1""",
        "retried_scores": f"""
SELECT {_SCORE_COLUMNS} FROM scores_judged
WHERE reasons = '' AND account_id IN (SELECT account_id FROM accounts_valid WHERE k % 2 = 1)""",
        "open_rejects": """
SELECT score_id, account_id, reasons, '2023-06-01' AS rejected_on
FROM (SELECT score_id, account_id,
             CASE WHEN account_id IN (SELECT account_id FROM accounts)
                   AND account_id NOT IN (SELECT account_id FROM accounts_valid)
                  THEN concat_ws('|', nullif(reasons, ''), 'FOREIGN_KEY:account_id')
                  ELSE reasons END AS reasons
      FROM scores_judged)
WHERE reasons <> ''""",
        "high_risk_top10_with_orphans": """
SELECT account_id, customer_id, property_province,
       format('${:,.2f}', CAST(loan_amount AS DOUBLE)) AS loan_amount,
       credit_score AS latest_credit_score,
       CAST(CAST(round(current_ltv, 1) AS DECIMAL(6,1)) AS VARCHAR) || '%' AS current_ltv,
       CAST(round(risk_score, 1) AS DOUBLE) AS risk_score, risk_category, risk_flags,
       recommended_action
FROM coded x
WHERE risk_category IN ('High Risk', 'Very High Risk') AND CAST(substr(account_id, 4) AS BIGINT) % 3 <> 0
ORDER BY x.risk_score DESC, account_id LIMIT 10""",
        "upsert_accounts": f"""
SELECT {_ACCOUNT_COLUMNS} FROM accounts_valid
UNION ALL
SELECT {_ACCOUNT_COLUMNS} FROM accounts
WHERE origination_date < DATE '2023-01-01'
  AND account_id NOT IN (SELECT account_id FROM accounts_valid)""",
        "append_scores": f"""
SELECT {_SCORE_COLUMNS} FROM scores WHERE score_date < DATE '2023-07-01'
UNION ALL
SELECT {_SCORE_COLUMNS} FROM scores_judged
WHERE reasons = '' AND score_id NOT IN
  (SELECT score_id FROM scores WHERE score_date < DATE '2023-07-01')""",
        "load_new_scores": f"""
SELECT {_SCORE_COLUMNS} FROM scores_unloaded
WHERE reasons = '' AND account_id IN (SELECT account_id FROM accounts_loaded)""",
        "load_orphans": """
SELECT 'credit_scores' AS table_name, score_id AS row_key, account_id AS missing_parent
FROM scores_unloaded
WHERE reasons = '' AND account_id IN (SELECT account_id FROM accounts_loaded)
  AND account_id NOT IN (SELECT account_id FROM accounts_loaded)""",
        "append_orphans": """
SELECT 'credit_scores' AS table_name, score_id AS row_key, account_id AS missing_parent
FROM scores_unloaded
WHERE reasons = '' AND account_id NOT IN (SELECT account_id FROM accounts_loaded)""",
    }


def oracle_sql() -> dict[str, str]:
    dated = {
        "risk_history": _METRICS.format(source="contract"),
        "risk_point_in_time": _METRICS.format(source="coded"),
        "risk_summary_by_date": _summary(
            "contract", "risk_flags <> ''",
            "CAST(as_of AS VARCHAR) AS calculation_date, risk_category", "as_of, risk_category",
        ),
        "risk_summary_by_province": _summary(
            "(SELECT c.*, a.property_province FROM contract c JOIN accounts a USING (account_id))",
            "risk_flags <> ''",
            "CAST(as_of AS VARCHAR) AS calculation_date, property_province", "as_of, property_province",
        ),
        "orders_as_of_metrics": f"""
SELECT order_id, o.account_id, CAST(order_date AS VARCHAR) AS order_date,
       CASE WHEN c.account_id IS NOT NULL
            THEN 'RISK' || strftime(c.as_of, '%Y%m%d') || c.account_id END AS metric_id,
       risk_category, CAST(risk_score AS DOUBLE) AS risk_score_normalized
FROM ({_DATED_ORDERS}) o LEFT JOIN contract c ON c.account_id = o.account_id AND c.as_of <= order_date
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY c.as_of DESC) = 1""",
    }
    sql = {name: f"{_BASE}\n{body.strip()}" for name, body in _bodies().items()}
    sql.update({name: f"{_DATED}\n{body.strip()}" for name, body in dated.items()})
    return sql
