"""Loan-portfolio risk analytics as plain DataFrame operators on Spark."""

from loanrisk.policy import AS_CODED, CONTRACT, RiskPolicy

__all__ = ["AS_CODED", "CONTRACT", "RiskPolicy"]
