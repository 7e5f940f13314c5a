"""Event detection from the five standard tables to the stored result batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import calendar, events, gate, panel
from earlybell.sources import sinks


@dataclass(frozen=True)
class RiskInputs:
    """The five standard tables."""

    trading_calendar: DataFrame
    security_status_daily: DataFrame
    stock_market_daily: DataFrame
    security_risk_status: DataFrame
    broker_risk_classification: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {
            "broker": self.broker_risk_classification,
            "master": self.security_status_daily,
            "calendar": self.trading_calendar,
            "market": self.stock_market_daily,
            "st": self.security_risk_status,
        }


class RiskRun:
    """Lazy results of one detection run; nothing executes before a table is read or written."""

    def __init__(
        self,
        inputs: RiskInputs,
        rules: R.RiskRules,
        pressure: R.PressureRules | None = None,
        *,
        batch_id: str,
        snapshot_id: str,
        default_calendar: str = R.DEFAULT_CALENDAR,
    ) -> None:
        if not batch_id or not snapshot_id:
            raise ValueError("batch_id and snapshot_id are required")
        self.inputs, self.rules = inputs, rules
        self.pressure = pressure or R.PressureRules()
        self.ids = {"batch_id": batch_id, "snapshot_id": snapshot_id}
        self.days = calendar.market_trading_days(
            calendar.trading_days(inputs.trading_calendar), R.MARKETS, default_calendar
        )
        self.split = gate.universe_split(
            inputs.broker_risk_classification, inputs.security_status_daily, rules
        )
        self.eligible = self.split.where(F.col("eligibility") == "ELIGIBLE")

    def findings(self, *, prevalidation_allow_run: bool = True) -> DataFrame:
        return gate.gate_findings(
            self.inputs.by_name(), self.days, self.rules, prevalidation_allow_run=prevalidation_allow_run
        )

    @property
    def panel(self) -> DataFrame:
        return panel.risk_panel(
            self.eligible,
            self.days,
            self.inputs.stock_market_daily,
            self.inputs.security_risk_status,
            self.inputs.security_status_daily,
            self.rules,
        )

    def segments(self) -> DataFrame:
        return events.limit_down_segments(self.panel, self.rules, **self.ids)

    def events(self) -> DataFrame:
        return events.risk_events(self.panel, self.rules, **self.ids)

    def pressure_observations(self) -> DataFrame:
        return events.pressure_observations(self.panel, self.rules, self.pressure, **self.ids)

    def write(self, root: str) -> DataFrame:
        """Check the gate, write the batch and return its manifest.

        The gate's verdict is one row; it is the only value the driver reads.
        """
        verdict = gate.allow_run(self.findings()).first()
        if not verdict["allow_run"]:
            raise ValueError(f"the input gate rejects the run: {verdict['error_count']} errors")
        return sinks.write_bundle(
            {
                "continuous_limit_down_segments": self.segments(),
                "risk_events": self.events(),
                "limit_down_pressure_observations": self.pressure_observations(),
            },
            root,
            self.ids["batch_id"],
        )
