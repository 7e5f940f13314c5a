"""earlybell: risk-event detection and early-warning evaluation on Spark DataFrames."""

from earlybell.rules import BrokerMapping, PressureRules, RiskRules

__all__ = ["BrokerMapping", "PressureRules", "RiskRules"]
