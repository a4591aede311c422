"""Thresholds and switches of the risk model, kept apart from the pipeline.

Two presets share one pipeline. ``AS_CODED`` scores the way the original job computes;
``CONTRACT`` satisfies the documented rules (score within 0-100, only active flags, six
flags, unusable rows rejected instead of failing the job).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tier:
    """One risk tier; ``min_score`` is inclusive, ``None`` marks the lowest tier."""

    name: str
    min_score: int | None
    default_probability: Decimal
    pd_low: Decimal
    pd_high: Decimal
    recommended_action: str
    portfolio_action: str


# Tiers from best to worst, with score cut, default probability (point and
# documented range) and action texts.
TIERS = (
    Tier("Very Low Risk", 750, Decimal("0.0050"), Decimal("0.00"), Decimal("0.01"),
         "Continue routine monitoring", "Standard monitoring"),
    Tier("Low Risk", 700, Decimal("0.0200"), Decimal("0.01"), Decimal("0.03"),
         "Continue routine monitoring", "Quarterly review"),
    Tier("Medium Risk", 650, Decimal("0.0500"), Decimal("0.03"), Decimal("0.07"),
         "Standard monitoring with monthly reviews", "Monthly review + enhanced monitoring"),
    Tier("High Risk", 600, Decimal("0.1100"), Decimal("0.07"), Decimal("0.15"),
         "Enhanced monitoring - Weekly check-ins", "Weekly review + intervention planning"),
    Tier("Very High Risk", None, Decimal("0.2000"), Decimal("0.15"), Decimal("1.00"),
         "Immediate review required - Consider workout options",
         "Daily monitoring + immediate action"),
)
HIGH_RISK_TIERS = ("High Risk", "Very High Risk")

# Follow-up per warning flag.
FLAG_ACTIONS = {
    "HIGH_LTV": "Enhanced monitoring",
    "LOW_CREDIT": "Credit counseling referral",
    "SCORE_DECLINE": "Risk review",
    "DEROGATORY_MARKS": "Account investigation",
    "HIGH_UTILIZATION": "Financial stress indicator",
    "PAYMENT_ISSUES": "Collections alert",
}

# Allowed codes per column.
DOMAINS = {
    "property_province": ("ON", "QC", "BC", "AB", "MB", "SK", "NS", "NB", "PE", "NL"),
    "property_type": ("Single Family", "Condo", "Townhouse", "Multi-Family"),
    "employment_status": ("Full-Time", "Part-Time", "Self-Employed", "Retired", "Contract"),
    "score_source": ("Equifax", "TransUnion"),
    "risk_category": tuple(tier.name for tier in TIERS),
}

# Allowed ranges per column, both ends included.
RANGES = {
    "credit_score": (300, 900),
    "payment_history_score": (0, 100),
    "credit_utilization_pct": (0, 100),
    "risk_score_normalized": (0, 100),
    "default_probability": (0, 1),
}


@dataclass(frozen=True)
class RiskPolicy:
    name: str
    # Weight and full-scale value of each score component.
    credit_weight: int = 40
    credit_full_scale: int = 900
    ltv_weight: int = 35
    ltv_full_scale: int = 100
    marks_weight: int = 15
    marks_full_scale: int = 10
    utilization_weight: int = 10
    utilization_full_scale: int = 100
    # Flag thresholds.
    ltv_limit: int = 80
    credit_floor: int = 650
    utilization_limit: int = 75
    payment_floor: int = 60
    decline_points: int = 50
    decline_days: int = 90
    # Switches.
    score_multiplier: int = 100
    score_type: str = "decimal(6,2)"
    ltv_type: str = "decimal(6,2)"
    documented_rules: bool = False


AS_CODED = RiskPolicy("as_coded")
CONTRACT = RiskPolicy(
    "contract", score_multiplier=1, score_type="decimal(5,2)", documented_rules=True
)


def tier_policy(spark: SparkSession) -> DataFrame:
    """The tier table as rows: one row per tier, so its size is fixed."""
    return spark.createDataFrame(
        [
            (rank, t.name, t.min_score, t.pd_low, t.pd_high, t.portfolio_action)
            for rank, t in enumerate(TIERS, start=1)
        ],
        "tier_rank int, risk_category string, min_credit_score int, "
        "pd_low decimal(5,4), pd_high decimal(5,4), portfolio_action string",
    )


def flag_policy(spark: SparkSession) -> DataFrame:
    """The flag table as rows: one row per flag, so its size is fixed."""
    return spark.createDataFrame(
        list(FLAG_ACTIONS.items()), "risk_flag string, flag_action string"
    )
