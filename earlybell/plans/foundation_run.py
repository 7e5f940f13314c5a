"""Versioned store: append, reconcile, snapshot, export."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import foundation as fd
from earlybell.operators import panel, store
from earlybell.operators.panel import DAY
from earlybell.sources import sinks, staging

PLANNED = (
    ("MDFRQ004", "daily_price_unadjusted"),
    ("MDFRQ004", "daily_price_limits"),
    ("MDFRQ004", "daily_st_status"),
    ("MDFRQ004", "daily_suspension_status"),
    ("MDFRQ005", "daily_st_status"),
    ("MDFRQ005", "daily_suspension_status"),
    ("MDFRQ006", "daily_price_unadjusted"),
    ("MDFRQ006", "daily_price_limits"),
    ("MDFRQ007", ""),
    ("MDFRQ008", "daily_price_unadjusted"),
    ("MDFRQ009", "daily_price_unadjusted"),
    ("MDFRQ010", "daily_price_limits"),
    ("MDFRQ011", "daily_st_status"),
    ("MDFRQ011", "daily_suspension_status"),
)


@dataclass(frozen=True)
class DailyFacts:
    """Current typed facts with the key and trading_date, and the universe they belong to."""

    universe: DataFrame
    days: DataFrame
    prices: DataFrame
    limits: DataFrame
    st: DataFrame
    suspension: DataFrame


def append(root: str, stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append the changed rows of a batch and return its counts; conflicting batches are refused.

    What is to be written is computed once and stored; the facts and the counts read it back.
    """
    if not store.batch_conflicts(incoming).isEmpty():
        raise ValueError("one batch gives a business key two payloads")
    written = staging.store(store.append_versions(stored, incoming), "appended")
    counts = store.append_summary(incoming, written)
    sinks.write_facts(written, root)
    return counts


def reconcile(facts: DailyFacts) -> DataFrame:
    """All issues of the daily facts (Q17-Q20), one row per issue."""
    f = facts
    expected = panel.expected_days(f.universe, f.days).select(*R.KEY, DAY)
    traded = fd.traded_days(expected, f.suspension).where(F.col("market_code").isin(*R.RISK_MARKETS))
    named: Sequence[tuple[str, DataFrame, DataFrame | None]] = (
        ("daily_price_unadjusted", f.prices, f.prices),
        ("daily_price_limits", f.limits, f.prices),
        ("daily_st_status", f.st, None),
        ("daily_suspension_status", f.suspension, None),
    )
    parts = [fd.facts_outside_lifecycle(df, f.universe, f.days, name, prices) for name, df, prices in named]
    parts += [
        fd.missing_expected(expected, f.st, "MDFRQ005", "daily_st_status"),
        fd.missing_expected(expected, f.suspension, "MDFRQ005", "daily_suspension_status"),
        fd.missing_expected(traded, f.prices, "MDFRQ006", "daily_price_unadjusted"),
        fd.missing_expected(traded, f.limits, "MDFRQ006", "daily_price_limits"),
        fd.price_limit_key_mismatch(f.prices, f.limits),
        fd.priced_while_suspended(f.prices, f.suspension),
        fd.invalid_prices(f.prices),
        fd.invalid_limits(f.limits),
        fd.null_flags(f.st, "is_st", "daily_st_status"),
        fd.null_flags(f.suspension, "is_suspended", "daily_suspension_status"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def report(facts: DailyFacts) -> DataFrame:
    """PASS / FAIL per planned check."""
    return fd.check_report(reconcile(facts), PLANNED)


def publish(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot manifest of the latest facts and its digest per dataset."""
    manifest = store.snapshot_manifest(stored)
    return manifest, store.member_digest(manifest, ["dataset_id"])
