"""Rule sets: frozen dataclasses that parameterise the operators.

Everything here is configuration-sized (a few dozen entries); nothing in it
grows with the data, which is why operators may turn it into literals or
broadcast it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

KEY = ("market_code", "security_code")

# --- fixed values -----------------------------------------------------------
MARKETS = ("XSHG", "XSHE", "XBSE")
RISK_MARKETS = ("XSHG", "XSHE")
DEFAULT_CALENDAR = "cn"
SUFFIX_MARKETS = {"SH": "XSHG", "SZ": "XSHE", "BJ": "XBSE"}
NORMAL_TRADED = ("正常成交", "TRADED", "NORMAL_TRADED")
BOARD_ALIASES = {
    "MainBoard": "MAIN",
    "主板": "MAIN",
    "GEM": "CHINEXT",
    "创业板": "CHINEXT",
    "STAR": "STAR",
    "KSH": "STAR",
    "科创板": "STAR",
    "BSE": "BSE",
    "北交所": "BSE",
}
LIMIT_DOWN_THRESHOLDS = {"MAIN": 3, "CHINEXT": 2, "STAR": 2}
PRESSURE_THRESHOLDS = {"MAIN": 2, "CHINEXT": 1, "STAR": 1}
RETURN_PRICE_ADJUSTMENT = "POST_ADJUSTED"
RETURN_NORMAL_STATUS = ("正常成交", "NORMAL", "TRADED")
SUSPENDED_STATUS = ("停牌", "无成交")
ST_TRUE = ("true", "1", "yes", "是", "生效", "st", "*st")
ST_FALSE = ("false", "0", "no", "否", "未生效", "非st", "non_st")
BOOL_TRUE = ("true", "1", "yes", "y", "是")
BOOL_FALSE = ("false", "0", "no", "n", "否")
GRADES = ("A", "B", "C", "D", "E", "F", "G")
GRADE_BUCKETS = (*GRADES, "BLANK", "UNKNOWN")
INTERCEPT_GRADES = ("F", "G")
LIMIT_DOWN_EVENT = "NON_ST_CONTINUOUS_LIMIT_DOWN"
NEW_ST_EVENT = "NEW_ST"
ALL_EVENTS = "ALL_RISK_EVENTS"
PRESSURE_EVENT = "NON_ST_LIMIT_DOWN_PRESSURE_OBSERVATION"
EVENT_VIEWS = (LIMIT_DOWN_EVENT, NEW_ST_EVENT, ALL_EVENTS)
DATASETS = (
    "market_calendar",
    "instrument_master_history",
    "daily_price_unadjusted",
    "daily_st_status",
    "daily_suspension_status",
    "daily_price_limits",
)
AUDITED_REASONS = (
    "BM203_ST_STATUS_MISSING",
    "BM301_MAPPING_UNKNOWN",
    "BM303_DANGEROUS_RUN_LEFT_CENSORED",
    "BM305_NO_BROKER_START_FOR_ST_OVERRIDE",
    "BM109_SECURITY_HISTORY_MISSING",
)
EXPECTED_PEER_BROKERS = 21
RANKING_METRICS = (
    "event_hit_rate",
    "security_hit_rate",
    "warning_rate",
    "warning_days_median",
    "warning_days_mean",
)
COMPOSITE_METRICS = RANKING_METRICS[:4]
EXAMPLE_LIMIT = 20
CODE_DIGITS = r"\d{6}"  # a security code before its market suffix
# ---------------------------------------------------------------------------


def literal_rows(spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """Configuration-sized rows as a local relation (its size is known to Catalyst)."""

    def sql(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, date):
            return f"DATE'{value.isoformat()}'"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    body = ", ".join("(" + ", ".join(map(sql, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


@dataclass(frozen=True)
class RiskRules:
    """Formal event rules for one observation window."""

    observation_start: date
    observation_end: date
    rule_version: str = "v2"
    board_aliases: Mapping[str, str] = field(default_factory=lambda: dict(BOARD_ALIASES))
    thresholds: Mapping[str, int] = field(default_factory=lambda: dict(LIMIT_DOWN_THRESHOLDS))
    excluded_boards: tuple[str, ...] = ("BSE",)
    excluded_markets: tuple[str, ...] = ("XBSE",)
    decimal_scale: int = 6
    minimum_segment_length: int = 2
    code_digits: str = CODE_DIGITS
    continuous_event_type: str = LIMIT_DOWN_EVENT
    new_st_event_type: str = NEW_ST_EVENT

    def __post_init__(self) -> None:
        if self.observation_start > self.observation_end:
            raise ValueError("observation start is later than observation end")


@dataclass(frozen=True)
class PressureRules:
    """Lower thresholds for pressure observations next to the formal events."""

    rule_version: str = "limit_down_pressure_v1"
    event_type: str = PRESSURE_EVENT
    thresholds: Mapping[str, int] = field(default_factory=lambda: dict(PRESSURE_THRESHOLDS))

    def check_against(self, formal: RiskRules) -> None:
        if set(self.thresholds) != set(formal.thresholds):
            raise ValueError("pressure and formal board scopes differ")
        if any(self.thresholds[b] > formal.thresholds[b] for b in self.thresholds):
            raise ValueError("a pressure threshold exceeds the formal one")


@dataclass(frozen=True)
class BrokerMapping:
    """Exact (broker, raw value) -> DANGEROUS / NON_DANGEROUS; never inferred."""

    version: str
    buckets: Mapping[str, Mapping[str, str]]
    status: str = "approved"

    @property
    def broker_ids(self) -> tuple[str, ...]:
        return tuple(sorted(self.buckets))

    @staticmethod
    def from_dangerous(version: str, dangerous: Mapping[str, str], grades=GRADES) -> BrokerMapping:
        """``{"B01": "FG"}`` marks F and G dangerous and the other grades not."""
        return BrokerMapping(
            version,
            {
                broker: {g: "DANGEROUS" if g in bad else "NON_DANGEROUS" for g in grades}
                for broker, bad in dangerous.items()
            },
        )

    def frame(self, spark: SparkSession) -> DataFrame:
        """Mapping as rows; at most brokers x raw values, so safe to broadcast."""
        rows = [
            (broker, raw, bucket, f"{self.version}:{broker}:{raw}")
            for broker, values in sorted(self.buckets.items())
            for raw, bucket in sorted(values.items())
            if raw != ""
        ]
        return literal_rows(
            spark,
            ("broker_id", "raw_classification", "mapped_bucket", "mapping_record_id"),
            rows,
        )
