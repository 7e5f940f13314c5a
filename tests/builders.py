"""Tiny five-table inputs for hand-made cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from earlybell.plans.risk_run import RiskInputs, RiskRun
from earlybell.rules import RiskRules

D = dt.date
KEY_SCHEMA = "market_code string, security_code string"


def sessions(start: D, n: int) -> list[D]:
    """``n`` weekdays from a date on."""
    out, day = [], start
    while len(out) < n:
        if day.weekday() < 5:
            out.append(day)
        day += dt.timedelta(days=1)
    return out


class Market:
    """Collects rows of the five tables; ``day`` strings mark each session of a security.

    L limit-down, n normal, s suspended, T ST day (normal trade), U ST day at limit price.
    """

    def __init__(self, days: list[D], window: tuple[D, D] | None = None) -> None:
        self.days = days
        self.window = window or (days[0], days[-1])
        self.universe, self.master, self.market, self.st = [], [], [], []

    def add(self, code, marks, *, market="XSHG", board="MAIN", listed=D(2020, 1, 1), delisted=None, days=None, before=None, boards=()):
        key = (market, f"{code}.{market}")
        days = days or self.days
        self.universe.append((*key, days[0]))
        self.master.append((*key, listed, board, listed, delisted))
        for when, name in boards:
            self.master.append((*key, when, name, listed, delisted))
        if before is not None:
            day = self.window[0] - dt.timedelta(days=3)
            self.st.append((*key, "ST", before, day, "base"))
        for day, mark in zip(days, marks):
            close = Decimal("10.000000")
            limit = close if mark in "LU" else Decimal("9.000000")
            status = "停牌" if mark == "s" else "TRADED"
            self.market.append((*key, day, status, close, limit, f"m-{day}"))
            self.st.append((*key, "ST", "生效" if mark in "TU" else "未生效", day, f"s-{day}"))
        return self

    def run(self, spark, **rules) -> RiskRun:
        calendar = [("cn", d, True) for d in self.days]
        inputs = RiskInputs(
            spark.createDataFrame(calendar, "market_code string, calendar_date date, is_trading_day boolean"),
            spark.createDataFrame(self.master, KEY_SCHEMA + ", status_date date, board_code string, listed_date date, delisted_date date"),
            spark.createDataFrame(
                self.market,
                KEY_SCHEMA + ", trading_date date, trading_status string, close_price decimal(20,6), limit_down_price decimal(20,6), source_record_id string",
            ),
            spark.createDataFrame(
                self.st, KEY_SCHEMA + ", risk_status_type string, risk_status_value string, status_start_date date, source_record_id string"
            ),
            spark.createDataFrame(self.universe, KEY_SCHEMA + ", classification_date date"),
        )
        return RiskRun(inputs, RiskRules(*self.window, **rules), batch_id="b", snapshot_id="s")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
