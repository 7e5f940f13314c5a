"""The security x trading-day panel.

All per-security state (as-of board, ST state, previous close, active grades) is
read off one panel: the sources are stacked, hash-partitioned once on
(market_code, security_code), merged per day and scanned by ordered windows. A
security never has more rows than the calendar has days, because every source is
reduced to one row per security-day before it is stacked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S

DAY = "trading_date"
#: The key in sorting order: sorts compare an 8-byte prefix of their first column, and codes differ where markets don't.
SORT_KEY = ("security_code", "market_code")


def by_day(*more: str):
    """Per-security (or finer) window in day order."""
    return Window.partitionBy(*SORT_KEY, *more).orderBy(DAY)


def running(*more: str):
    return by_day(*more).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(*more: str):
    return by_day(*more).rowsBetween(Window.unboundedPreceding, -1)


def latest_version(df: DataFrame, keys: Sequence[str], *version: str) -> DataFrame:
    """Row of the greatest version per key.

    An aggregate instead of a ranked window: each task keeps one row per key
    before the shuffle, so a key with very many versions stays cheap. Ties fall
    to the greatest remaining columns, which keeps the result deterministic.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in version]
    best = F.max(F.struct(*version, *rest)).alias("_best")
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
    )


def lifecycle(master: DataFrame, as_of: date | None = None) -> DataFrame:
    """Latest lifecycle and board record per security up to a date."""
    if as_of is not None:
        master = master.where(F.col("status_date") <= F.lit(as_of))
    return master.groupBy(*R.KEY).agg(
        F.max_by(F.struct("board_code", "listed_date", "delisted_date"), "status_date").alias("m")
    ).select(*R.KEY, "m.board_code", "m.listed_date", "m.delisted_date")


def day_arrays(days: DataFrame) -> DataFrame:
    """One row per market with its ordered trading days.

    Joins with it carry no hint: Catalyst and AQE broadcast it by its measured size,
    as they do with every calendar side, and shuffle beyond their threshold.
    """
    return days.groupBy("market_code").agg(F.array_sort(F.collect_set(DAY)).alias("days"))


def expected_days(securities: DataFrame, days: DataFrame) -> DataFrame:
    """Security x trading day inside the right-open lifecycle, with the day's ordinal.

    ``securities`` needs the key, listed_date and delisted_date. The calendar side
    is one array per market, so the grid grows by a map-side explode: no shuffle
    of securities and no range join.
    """
    return (
        securities.join(day_arrays(days), "market_code")
        .select(*R.KEY, "listed_date", "delisted_date", F.posexplode("days").alias("pos", DAY))
        .where(S.in_lifecycle(DAY, "listed_date", "delisted_date"))
        .select(*R.KEY, DAY, (F.col("pos") + 1).alias("ordinal"), "listed_date", "delisted_date")
    )


def stack_by_day(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Merge sources keyed by security and day into one row with a struct per source.

    Each frame has the key, ``trading_date`` and payload columns, at most one row
    per security-day. Stacking plus one exchange on the security replaces a chain
    of multi-key joins, and later windows on the security reuse that exchange and
    its sort order.
    """

    def tagged(name: str, df: DataFrame) -> DataFrame:
        payload = [c for c in df.columns if c not in (*R.KEY, DAY)]
        return df.select(*R.KEY, DAY, F.struct(*payload).alias(name))

    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [tagged(n, d) for n, d in frames.items()],
    )
    return (
        stacked.repartition(*R.KEY)
        .groupBy(*SORT_KEY, DAY)
        .agg(*[F.max(n).alias(n) for n in frames])
        .select(*R.KEY, DAY, *frames)
    )


def carry(value: Column, window=None) -> Column:
    """Last non-null value up to the current day."""
    return F.last(value, ignorenulls=True).over(window or running())


def st_daily(risk_status: DataFrame) -> DataFrame:
    """Daily ST rows reduced to one state per security-day, latest record version first."""
    version = [F.col("record_version").cast("int")] if "record_version" in risk_status.columns else []
    rows = risk_status.where(F.upper("risk_status_type") == "ST").select(
        *R.KEY,
        F.col("status_start_date").alias(DAY),
        S.parse_st("risk_status_value").alias("is_st"),
        "source_record_id",
        *[v.alias("record_version") for v in version],
    )
    best = F.max(F.struct(*(["record_version"] if version else []), "source_record_id", "is_st")).alias("b")
    return rows.groupBy(*SORT_KEY, DAY).agg(best).select(
        *R.KEY, DAY, F.col("b.is_st").alias("is_st"), F.col("b.source_record_id").alias("source_record_id")
    )


def market_daily(market: DataFrame) -> DataFrame:
    """One market row per security-day, latest market_data_version first."""
    cols = ["trading_status", "close_price", "limit_down_price", "source_record_id"]
    if "market_data_version" in market.columns:
        market = market.withColumn("market_data_version", F.col("market_data_version").cast("int"))
        market = latest_version(
            market.select(*R.KEY, DAY, "market_data_version", *cols), [*R.KEY, DAY], "market_data_version"
        )
    return market.select(*R.KEY, DAY, *cols)


def board_records(master: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Canonical board per dated master record, one per security-day."""
    return (
        master.groupBy(*R.KEY, F.col("status_date").alias(DAY))
        .agg(F.max("board_code").alias("board_code"))
        .select(*R.KEY, DAY, S.canonical_board("board_code", aliases).alias("board_code"))
    )


def risk_panel(
    eligible: DataFrame,
    days: DataFrame,
    market: DataFrame,
    risk_status: DataFrame,
    master: DataFrame,
    rules: R.RiskRules,
    *,
    carry_st: bool = False,
) -> DataFrame:
    """In-lifecycle trading days of the eligible securities with all daily facts.

    Columns: key, trading_date, ordinal, listed_date, delisted_date, has_market,
    trading_status, close_price, limit_down_price, source_record_id, is_st,
    st_source_record_id, baseline_st / baseline_source / baseline_date (last state
    before the window), board_code (as of the day) and is_limit_down.
    ``carry_st`` keeps the last known state on days without an ST row.
    """
    start = F.lit(rules.observation_start)
    inside = trading_window(days, rules)
    market = trading_window(market, rules)  # nothing is carried from market rows, so those outside the grid say nothing
    st = st_daily(risk_status)
    stacked = stack_by_day(
        {
            "grid": expected_days(eligible, inside),
            "mkt": market_daily(market),
            "st": st,
            "board": board_records(master, rules.board_aliases),
        }
    )
    st_state = carry(F.col("st")) if carry_st else F.col("st")
    scanned = stacked.select(
        *R.KEY,
        DAY,
        "grid",
        "mkt",
        st_state.alias("st"),
        carry(
            F.when((F.col(DAY) < start) & F.col("st").isNotNull(), F.struct(DAY, "st.is_st", "st.source_record_id"))
        ).alias("baseline"),
        carry(F.col("board")).alias("board"),
    ).where(F.col("grid").isNotNull())
    return scanned.select(
        *R.KEY,
        DAY,
        "grid.ordinal",
        "grid.listed_date",
        "grid.delisted_date",
        F.col("mkt").isNotNull().alias("has_market"),
        "mkt.trading_status",
        "mkt.close_price",
        "mkt.limit_down_price",
        F.col("mkt.source_record_id").alias("source_record_id"),
        F.col("st.is_st").alias("is_st"),
        F.col("st.source_record_id").alias("st_source_record_id"),
        F.col("baseline.is_st").alias("baseline_st"),
        F.col("baseline.source_record_id").alias("baseline_source"),
        F.col(f"baseline.{DAY}").alias("baseline_date"),
        F.col("board.board_code").alias("board_code"),
        S.is_limit_down(
            "st.is_st", "mkt.trading_status", "mkt.close_price", "mkt.limit_down_price", rules.decimal_scale
        ).alias("is_limit_down"),
    )


def trading_window(days: DataFrame, rules: R.RiskRules) -> DataFrame:
    return days.where(F.col(DAY).between(F.lit(rules.observation_start), F.lit(rules.observation_end)))


def st_filled(securities: DataFrame, days: DataFrame, st: DataFrame, *, closed_end: bool = True) -> DataFrame:
    """Sparse ST states carried over the lifecycle grid; null before the first state.

    ST loading accepts the termination day itself, unlike the right-open event grid.
    States dated on closed days are not evidence and are skipped.
    """
    if closed_end:
        securities = securities.withColumn("delisted_date", F.date_add("delisted_date", 1))
    grid = expected_days(securities, days).select(*R.KEY, DAY, "ordinal")
    return (
        stack_by_day({"grid": grid, "st": st.select(*R.KEY, DAY, "is_st")})
        .where(F.col("grid").isNotNull())
        .select(*R.KEY, DAY, carry(F.col("st.is_st")).alias("is_st"))
    )


def previous_known_close(prices: DataFrame, start: date | None = None) -> DataFrame:
    """Close of the last day that had one before the current day, any gap.

    Rows before ``start`` only seed the carry and are not returned.
    """
    out = prices.withColumn("previous_close", carry(F.col("close_price"), before()))
    return out if start is None else out.where(F.col(DAY) >= F.lit(start))


def previous_session_close(prices: DataFrame, index: DataFrame) -> DataFrame:
    """Close of exactly the previous session; null across a gap.

    The session numbers come from the broadcast calendar, so a lagged row counts
    only if its number is one less: no dense grid is needed.
    """
    numbered = prices.join(
        index.select("market_code", DAY, "ordinal"), ["market_code", DAY]
    )
    return numbered.withColumn(
        "previous_close",
        F.when(F.lag("ordinal").over(by_day()) == F.col("ordinal") - 1, F.lag("close_price").over(by_day())),
    ).drop("ordinal")


def assemble_market_daily(prices: DataFrame, limits: DataFrame, suspension: DataFrame) -> DataFrame:
    """Price days plus suspended days without a price, with limits and status."""
    return (
        stack_by_day(
            {
                "p": prices.select(*R.KEY, DAY, "close_price"),
                "l": limits.select(*R.KEY, DAY, "limit_up_price", "limit_down_price"),
                "s": suspension.select(*R.KEY, DAY, "is_suspended"),
            }
        )
        .where(F.col("p").isNotNull() | F.coalesce(F.col("s.is_suspended"), F.lit(False)))
        .select(
            *R.KEY,
            DAY,
            F.when(F.coalesce(F.col("s.is_suspended"), F.lit(False)), "停牌").otherwise("正常成交").alias("trading_status"),
            "p.close_price",
            "l.limit_up_price",
            "l.limit_down_price",
            carry(F.col("p.close_price"), before()).alias("previous_close"),
        )
    )


def typed_three_way(prices: DataFrame, limits: DataFrame, suspension: DataFrame, key: str = "business_key") -> DataFrame:
    """Price rows with limits and suspension by business key, plus a completeness flag."""
    return (
        prices.join(limits.select(key, "limit_up_price", "limit_down_price"), key, "left")
        .join(suspension.select(key, "is_suspended"), key, "left")
        .withColumn("is_complete", F.col("is_suspended").isNotNull())
    )
