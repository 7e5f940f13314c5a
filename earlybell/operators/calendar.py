"""Trading-calendar dimension and date-range operators.

A calendar holds at most one row per market and day. Its size is bounded by the
calendar itself (a few thousand rows per market), not by the fact data, so it is
the one dimension that is always broadcast and the only one that may be ordered
within a whole market.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S


def trading_days(calendar: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Distinct (market_code, trading_date) of trading days inside the bounds."""
    days = calendar.where(F.col("is_trading_day"))
    if start is not None:
        days = days.where(F.col("calendar_date") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("calendar_date") <= F.lit(end))
    return days.select("market_code", F.col("calendar_date").alias("trading_date")).distinct()


def market_trading_days(days: DataFrame, markets: Sequence[str], default: str = R.DEFAULT_CALENDAR) -> DataFrame:
    """Own calendar of each market, else the default one.

    Each day goes to every market it can serve (a literal list), and a market
    that has days of its own drops the borrowed ones.
    """
    targets = F.when(
        F.col("market_code") == default, F.array(*[F.lit(m) for m in markets])
    ).otherwise(F.array("market_code"))
    served = days.select(
        F.explode(targets).alias("target"), "trading_date", (F.col("market_code") != default).alias("own")
    ).where(F.col("target").isin(*markets))
    per_market = Window.partitionBy("target")
    return (
        served.withColumn("has_own", F.max("own").over(per_market))
        .where(F.col("own") == F.col("has_own"))
        .select(F.col("target").alias("market_code"), "trading_date")
    )


def calendar_index(days: DataFrame) -> DataFrame:
    """Ordinal, previous and next trading day of every trading day."""
    w = Window.partitionBy("market_code").orderBy("trading_date")
    return days.select(
        "market_code",
        "trading_date",
        F.row_number().over(w).alias("ordinal"),
        F.lag("trading_date").over(w).alias("previous_day"),
        F.lead("trading_date").over(w).alias("next_day"),
    )


def trading_day_difference(pairs: DataFrame, index: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """Ordinal distance end - start in trading days; null if either is no trading day."""
    cal = index.select("market_code", "trading_date", "ordinal")
    a = cal.select("market_code", F.col("trading_date").alias(start), F.col("ordinal").alias("_a"))
    b = cal.select("market_code", F.col("trading_date").alias(end), F.col("ordinal").alias("_b"))
    return (
        pairs.join(a, ["market_code", start], "left")
        .join(b, ["market_code", end], "left")
        .withColumn(out, F.col("_b") - F.col("_a"))
        .drop("_a", "_b")
    )


def natural_day_lookup(calendar: DataFrame) -> DataFrame:
    """Every calendar day with the latest trading day before it and at or before it."""
    before = (
        Window.partitionBy("market_code")
        .orderBy("calendar_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("is_trading_day"), F.col("calendar_date"))
    return calendar.select(
        "market_code",
        "calendar_date",
        "is_trading_day",
        F.last(own, ignorenulls=True).over(before).alias("previous_trading_day"),
        F.last(own, ignorenulls=True).over(upto).alias("latest_trading_day"),
    )


def last_completed_session(days: DataFrame, requested: date) -> DataFrame:
    """Requested end resolved to the last session on or before it, per market."""
    return days.groupBy("market_code").agg(
        F.max(F.when(F.col("trading_date") <= F.lit(requested), F.col("trading_date"))).alias("effective_end")
    )


def latest_shared_day(days: DataFrame, markets: Sequence[str], before: date) -> DataFrame:
    """Latest trading day shared by all markets strictly before a date (C4)."""
    return (
        days.where(F.col("market_code").isin(*markets) & (F.col("trading_date") < F.lit(before)))
        .groupBy("trading_date")
        .agg(F.count_distinct("market_code").alias("n"))
        .where(F.col("n") == len(markets))
        .agg(F.max("trading_date").alias("safe_end_date"))
    )


def coverage(facts: DataFrame, datasets: Sequence[str], markets: Sequence[str], optional: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Date extent per (dataset, market) on the full required grid.

    ``facts`` needs dataset_id, market_code, business_date.
    """
    spark = facts.sparkSession
    grid = R.literal_rows(
        spark,
        ("dataset_id", "market_code", "is_optional"),
        [(d, m, (d, m) in set(optional)) for d in datasets for m in markets],
    )
    seen = facts.groupBy("dataset_id", "market_code").agg(
        F.min("business_date").alias("minimum_business_date"),
        F.max("business_date").alias("maximum_business_date"),
        F.count_distinct("business_date").alias("distinct_business_dates"),
        F.count("*").alias("row_count"),
    )
    return grid.join(seen, ["dataset_id", "market_code"], "left").select(
        "dataset_id",
        "market_code",
        "minimum_business_date",
        "maximum_business_date",
        F.coalesce("distinct_business_dates", F.lit(0)).alias("distinct_business_dates"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.when(F.col("minimum_business_date").isNotNull(), "AVAILABLE")
        .when(F.col("is_optional"), "OPTIONAL_NOT_APPLICABLE")
        .otherwise("MISSING")
        .alias("coverage_state"),
    )


def common_data_as_of(covered: DataFrame) -> DataFrame:
    """Minimum of the maximum dates; null if any required pair has none."""
    return covered.agg(
        F.when(
            F.count("*") == F.count("maximum_business_date"), F.min("maximum_business_date")
        ).alias("data_as_of")
    )


def missing_ranges(expected: DataFrame, existing: DataFrame, keys: Sequence[str] = ("dataset_id", "market_code")) -> DataFrame:
    """Continuous natural-day ranges of expected dates that are absent.

    Both sides are reduced to distinct dates first, so the ordered window sees
    calendar-many rows per key.
    """
    keys = list(keys)
    cols = [*keys, "business_date"]
    missing = expected.select(*cols).distinct().join(existing.select(*cols).distinct(), cols, "left_anti")
    w = Window.partitionBy(*keys).orderBy("business_date")
    return (
        missing.withColumn("island", F.date_sub("business_date", F.row_number().over(w)))
        .groupBy(*keys, "island")
        .agg(
            F.min("business_date").alias("start_date"),
            F.max("business_date").alias("end_date"),
            F.count("*").alias("missing_days"),
        )
        .drop("island")
    )


def quarter_ranges(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """A date range cut into calendar quarters and clipped to its bounds."""
    quarter = F.explode(F.sequence(F.trunc(start, "quarter"), F.col(end), F.expr("interval 3 months")))
    others = [c for c in bounds.columns if c not in (start, end)]
    return bounds.withColumn("_q", quarter).select(
        *others,
        F.greatest(F.col(start), F.col("_q")).alias("range_start"),
        F.least(F.col(end), F.date_sub(F.add_months("_q", 3), 1)).alias("range_end"),
        F.concat(F.year("_q").cast("string"), F.lit("Q"), F.quarter("_q").cast("string")).alias("quarter"),
    )


def interval_days(df: DataFrame, start: str, end: str, out: str = "business_date") -> DataFrame:
    """One row per day of a closed interval; a missing end means the start day only."""
    return df.withColumn(
        out, F.explode(F.sequence(F.col(start), F.coalesce(F.col(end), F.col(start))))
    )


def monthly_to_daily(snapshots: DataFrame, calendar: DataFrame, start: date, end: date) -> DataFrame:
    """Monthly cross-sections carried to trading days.

    A snapshot holds through the next snapshot's boundary day inclusive. Boundaries
    on closed days move back to the previous session. The first one also serves the
    days from its own date on; blanks become G. ``snapshots`` needs snapshot_date,
    security columns and ``grade``; ``calendar`` is one market's natural calendar.
    """
    days = natural_day_lookup(calendar).where(F.col("calendar_date").between(F.lit(start), F.lit(end)))
    # one row per snapshot date: calendar-sized, never security-sized
    dates = snapshots.select("snapshot_date").distinct()
    boundary = (
        dates.join(
            natural_day_lookup(calendar).select(F.col("calendar_date").alias("snapshot_date"), "latest_trading_day"),
            "snapshot_date",
        )
        .groupBy("latest_trading_day")
        .agg(F.max("snapshot_date").alias("snapshot_date"))
        .withColumnRenamed("latest_trading_day", "calendar_date")
    )
    ordered = Window.partitionBy("market_code").orderBy("calendar_date")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    chosen = (
        days.where("is_trading_day")
        .join(boundary, "calendar_date", "left")
        .withColumn(
            "first_boundary",
            F.min(F.when(F.col("snapshot_date").isNotNull(), F.col("calendar_date"))).over(
                Window.partitionBy("market_code")
            ),
        )
        .withColumn(
            "active",
            F.coalesce(
                F.last("snapshot_date", ignorenulls=True).over(before),
                F.when(F.col("calendar_date") == F.col("first_boundary"), F.col("snapshot_date")),
            ),
        )
        .where(F.col("active").isNotNull())
        .select(F.col("calendar_date").alias("trading_date"), F.col("active").alias("snapshot_date"))
    )
    return snapshots.join(chosen, "snapshot_date").withColumn(
        "grade", F.coalesce(S.blank_to_null("grade"), F.lit("G"))
    )


def uncovered_days(days: DataFrame, history: DataFrame, day: str = "classification_date") -> DataFrame:
    """Trading days in range without any history row (C11)."""
    return days.join(
        history.select(F.col(day).alias("trading_date")).distinct(), "trading_date", "left_anti"
    )
