"""Broker evaluation of a stored event batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import assess, calendar, grades, metrics, quality, ranking
from earlybell.operators.panel import DAY
from earlybell.sources import sinks
from earlybell.sources.staging import store


@dataclass(frozen=True)
class EvaluationInputs:
    """Events (stored), wide grade history, ST states, lifecycle, calendar days, prices.

    ``history`` has biz_date, stk_code and one column per broker; ``st`` has the key,
    trading_date and is_st; ``life`` is the evaluated universe with its lifecycle;
    ``days`` lists market_code and trading_date; ``prices`` adds previous_close,
    close_price and trading_status.
    """

    events: DataFrame
    history: DataFrame
    st: DataFrame
    life: DataFrame
    days: DataFrame
    prices: DataFrame | None = None


class EvaluationRun:
    def __init__(
        self,
        inputs: EvaluationInputs,
        brokers: Sequence[str],
        mapping: R.BrokerMapping,
        start: date,
        end: date,
        *,
        rule_version: str = "v6",
        batch_id: str,
        code_digits: str = R.CODE_DIGITS,
    ) -> None:
        self.inputs, self.brokers, self.mapping = inputs, tuple(brokers), mapping
        self.window = (start, end)
        self.rule_version, self.batch_id, self.code_digits = rule_version, batch_id, code_digits
        self.cells = assess.wide_to_cells(inputs.history, self.brokers, digits=code_digits)
        self.index = calendar.calendar_index(inputs.days)

    def history_findings(self) -> DataFrame:
        """Securities on only one side of history and ST."""
        return quality.history_st_reconciliation(self.cells, self.inputs.st, self.inputs.life, *self.window)

    def record_findings(self) -> DataFrame:
        """History rows that the cells can't take as they are: codes without a canonical form,
        and security-days with records that differ (BM304). A run refuses while there are any."""
        codes = assess.uncanonical_codes(self.inputs.history, digits=self.code_digits).select(
            F.lit("SECURITY_CODE_INVALID").alias("code"), F.lit(None).cast("string").alias("market_code"),
            F.col("stk_code").alias("security_code"), F.lit(None).cast("date").alias("fact_date"), "affected_rows",
        )
        conflicts = assess.version_conflicts(self.cells).select(
            F.lit("BM304").alias("code"), *R.KEY, F.col("classification_date").alias("fact_date"), "affected_rows"
        )
        return codes.unionByName(conflicts)

    def assessments(self) -> DataFrame:
        """Event x broker verdicts; securities without history are marked, not dropped."""
        missing = self.history_findings().where(F.col("code") == "BM109_SECURITY_HISTORY_MISSING")
        return assess.assess_events(
            self.inputs.events,
            self.cells,
            self.inputs.st,
            self.inputs.days,
            self.index,
            self.brokers,
            self.mapping,
            rule_version=self.rule_version,
            batch_id=self.batch_id,
            missing_history=missing,
            prefilter=True,
        )

    def exposure_states(self) -> DataFrame:
        return assess.exposure_states(
            self.inputs.life, self.inputs.days, self.window, self.cells, self.inputs.st, self.brokers, self.mapping
        )

    def grade_returns(self) -> DataFrame:
        if self.inputs.prices is None:
            raise ValueError("prices are required for grade returns")
        return grades.grade_returns_daily(
            self.inputs.life,
            self.inputs.days,
            self.window,
            self.cells,
            grades.simple_returns(self.inputs.prices),
            self.brokers,
        )

    def tables(self) -> dict[str, DataFrame]:
        """All result tables. Assessments and exposure states are stored first: several metrics read them."""
        verdicts = store(self.assessments(), "assessments")
        states = store(self.exposure_states(), "exposure_states")
        start, end = self.window
        sessions = self.inputs.days.where(F.col(DAY).between(F.lit(start), F.lit(end))).select(DAY).distinct()
        warning_days = metrics.warning_days_distribution(verdicts, self.brokers)
        hits = metrics.hit_rates(verdicts, self.brokers)
        rates = metrics.warning_rates_snapshot(states, self.inputs.events, self.brokers, sessions).unionByName(
            metrics.warning_rates_period(states, self.inputs.events, self.brokers)
        )
        summary = metrics.final_summary(warning_days, hits, rates)
        out = {
            "event_broker_assessments": verdicts,
            "broker_warning_days_summary": warning_days,
            "broker_hit_rate_summary": hits,
            "broker_warning_rate_summary": rates,
            "broker_final_summary": summary,
            "broker_rankings": ranking.broker_rankings(summary),
            "broker_metric_findings": assess.assessment_findings(verdicts),
        }
        if self.inputs.prices is not None:
            daily = self.grade_returns()
            out["grade_returns_daily"] = daily
            out["grade_return_summary"] = grades.grade_return_summary(daily)
        return out

    def write(self, root: str) -> DataFrame:
        if not self.record_findings().isEmpty():
            raise ValueError("the history has record findings; see record_findings()")
        return sinks.write_bundle(self.tables(), root, self.batch_id)
