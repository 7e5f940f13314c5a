"""Projection of the given tables onto the securities domain.

The tables carry no securities, so users stand in for securities and their
events for daily facts. The projection is a plain DataFrame plan over the whole
tables; ``workload.prelude`` states the same rules in SQL.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import assess, calendar, events, panel
from earlybell.sources.staging import store

START, END = date(2024, 1, 8), date(2024, 1, 30)
CODE_DIGITS = r"\d{6,}"  # users from a million on have longer codes
RULES = R.RiskRules(START, END, code_digits=CODE_DIGITS)
PRESSURE = R.PressureRules()
BROKERS = ("B01", "B02", "B03")
MAPPING = R.BrokerMapping.from_dangerous("m1", {"B01": "FG", "B02": "EFG", "B03": "DEFG"})
RAW_VALUES = ("A", "B", "C", "D", "E", "F", "G", "", "X")
MONEY = "decimal(18,2)"


def market_of(user: str = "user_id") -> Column:
    return F.expr(f"CASE {user} % 3 WHEN 0 THEN 'XSHG' WHEN 1 THEN 'XSHE' ELSE 'XBSE' END")


def code_of(user: str = "user_id") -> Column:
    digits = F.expr(f"lpad(cast({user} as string), greatest(6, length(cast({user} as string))), '0')")
    return F.concat(digits, F.lit("."), market_of(user))


def at_risk(df: DataFrame) -> DataFrame:
    """Rows of the markets that ``Domain.eligible`` keeps; a filter on the key passes every step to the scan."""
    return df.where(F.col("market_code") != "XBSE")


class Domain:
    """Lazily built domain tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Raw events keyed by security and day."""
        return self.table("events").select(
            "event_id",
            "user_id",
            "event_type",
            market_of().alias("market_code"),
            code_of().alias("security_code"),
            F.col("ts").cast("date").alias("d"),
            F.col("value").cast(MONEY).alias("amt"),
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Everything the domain needs per user and day, stored once.

        The raw events are scanned once, folded map-side on two integers, and every
        domain table below reads the stored fold instead of the raw rows.
        """
        kind = F.col("event_type")
        on = lambda cond: F.when(cond, F.col("event_id"))
        folded = (
            self.table("events")
            .withColumn("amt", F.col("value").cast(MONEY))
            .groupBy("user_id", F.col("ts").cast("date").alias("trading_date"))
            .agg(
                F.count("*").alias("n"),
                F.max(kind == "error").alias("has_error"),
                F.sum("amt").alias("amount"),
                F.min("amt").alias("low_amt"),
                F.max("amt").alias("high_amt"),
                F.max("event_id").alias("last_id"),
                F.max_by(kind == "signup", on(kind.isin("signup", "purchase"))).alias("set_st"),
                F.max_by("amt", on(kind == "click")).alias("click_amt"),
                F.max((kind == "view") & (F.col("amt") >= 60)).alias("has_large_view"),
            )
        )
        return store(
            folded.select("user_id", market_of().alias("market_code"), code_of().alias("security_code"), *folded.columns[1:]),
            "daily_facts",
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Natural-day calendar of the default market and XSHG (others fall back)."""
        extent = self.facts.agg(F.min("trading_date").alias("lo"), F.max("trading_date").alias("hi"))
        return (
            extent.select(F.explode(F.sequence("lo", "hi")).alias("calendar_date"))
            .select(
                F.explode(F.array(F.lit("cn"), F.lit("XSHG"))).alias("market_code"),
                "calendar_date",
                (F.weekday("calendar_date") < 5).alias("is_trading_day"),
            )
        )

    @cached_property
    def days(self) -> DataFrame:
        """Trading days per market, with the default-calendar fallback applied."""
        return calendar.market_trading_days(calendar.trading_days(self.calendar), R.MARKETS)

    @cached_property
    def index(self) -> DataFrame:
        return calendar.calendar_index(self.days)

    @cached_property
    def securities(self) -> DataFrame:
        """Master lifecycle, stored once: listed on the first event day, every seventh one delisted 21 days later."""
        listed = self.facts.groupBy("user_id", *R.KEY).agg(F.min("trading_date").alias("listed_date")).select(
            "user_id",
            *R.KEY,
            "listed_date",
            F.when(F.col("user_id") % 7 == 0, F.date_add("listed_date", 21)).alias("delisted_date"),
            F.expr(
                "CASE WHEN user_id % 11 = 5 THEN 'BSE' WHEN user_id % 5 = 0 THEN 'GEM' "
                "WHEN user_id % 5 = 1 THEN 'KSH' ELSE 'MainBoard' END"
            ).alias("board_code"),
        )
        return store(listed, "securities")

    @cached_property
    def master(self) -> DataFrame:
        """Dated master records: the listing record and a board change per large view day."""
        base = self.securities.select(
            *R.KEY, F.col("listed_date").alias("status_date"), "board_code", "listed_date", "delisted_date"
        )
        moved = self.facts.where("has_large_view").select(
            *R.KEY, F.col("trading_date").alias("status_date"), F.lit("GEM").alias("new_board")
        )
        changed = (
            moved.join(self.securities, list(R.KEY))
            .where((F.col("status_date") > F.col("listed_date")) & (F.col("board_code") != "BSE"))
            .select(*R.KEY, "status_date", F.col("new_board").alias("board_code"), "listed_date", "delisted_date")
        )
        return base.unionByName(changed)

    @cached_property
    def life(self) -> DataFrame:
        """Lifecycle without the generating user."""
        return self.securities.select(*R.KEY, "listed_date", "delisted_date")

    @cached_property
    def eligible(self) -> DataFrame:
        """Securities outside the excluded market and board, by their latest record."""
        latest = panel.lifecycle(self.master, END)
        return latest.where((F.col("market_code") != "XBSE") & (F.col("board_code") != "BSE"))

    @cached_property
    def daily(self) -> DataFrame:
        """One row per security and event day with price-like sums."""
        return self.facts.select(
            *R.KEY,
            "trading_date",
            "n",
            "has_error",
            "amount",
            "low_amt",
            "high_amt",
            "last_id",
            (F.lit(1) + F.col("amount")).cast("decimal(20,6)").alias("close_price"),
        )

    @cached_property
    def market(self) -> DataFrame:
        """Daily market rows: a limit-down close on error days, a suspension row per quiet session."""
        quiet = panel.expected_days(self.life, self.days).select(*R.KEY, "trading_date")
        stacked = panel.stack_by_day({"g": quiet.withColumn("one", F.lit(1)), "t": self.daily})
        traded = F.col("t").isNotNull()
        return stacked.select(
            *R.KEY,
            "trading_date",
            F.when(traded, "TRADED").otherwise("停牌").alias("trading_status"),
            F.col("t.close_price").alias("close_price"),
            F.when(
                F.col("t.has_error"), F.col("t.close_price")
            ).otherwise((F.col("t.close_price") * F.lit("0.9").cast("decimal(3,1)")).cast("decimal(20,6)")).alias("limit_down_price"),
            F.when(traded, F.concat(F.lit("ev-"), F.col("t.last_id").cast("string"))).otherwise("none").alias("source_record_id"),
        )

    @cached_property
    def st_changes(self) -> DataFrame:
        """ST changes: the day's last signup sets it, its last purchase clears it."""
        return self.facts.where(F.col("set_st").isNotNull()).select(
            *R.KEY, "trading_date", F.col("set_st").alias("is_st")
        )

    @cached_property
    def st_known(self) -> DataFrame:
        """ST state per lifecycle session, stored once; null before the first change."""
        return store(panel.st_filled(self.life, self.days, self.st_changes), "st_known")

    @cached_property
    def risk_status(self) -> DataFrame:
        """Complete daily ST rows in the standard layout (unknown counts as not ST)."""
        return self.st_known.select(
            *R.KEY,
            F.lit("ST").alias("risk_status_type"),
            F.when(F.coalesce("is_st", F.lit(False)), "生效").otherwise("未生效").alias("risk_status_value"),
            F.col("trading_date").alias("status_start_date"),
            F.concat_ws(":", F.lit("st"), "security_code", F.col("trading_date").cast("string")).alias("source_record_id"),
        )

    @cached_property
    def wide(self) -> DataFrame:
        """Wide grade history from the last click of each security-day (weekends included)."""
        return self._wide(self.facts)

    def _wide(self, facts: DataFrame) -> DataFrame:
        picked = facts.where(F.col("click_amt").isNotNull()).select(
            F.col("trading_date").alias("biz_date"), "user_id", F.col("click_amt").alias("v")
        )
        digits = F.expr("lpad(cast(user_id as string), greatest(6, length(cast(user_id as string))), '0')")
        suffix = F.expr("CASE user_id % 3 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' ELSE '.BJ' END")
        raws = F.array(*[F.lit(r) for r in RAW_VALUES])
        return picked.select(
            "biz_date",
            F.concat(digits, suffix).alias("stk_code"),
            *[F.get(raws, ((F.floor("v") + 3 * k) % 9).cast("int")).alias(b) for k, b in enumerate(BROKERS)],
        )

    @cached_property
    def cells(self) -> DataFrame:
        return assess.wide_to_cells(self.wide, BROKERS, digits=CODE_DIGITS)

    @cached_property
    def long(self) -> DataFrame:
        return assess.wide_to_long(self.wide, BROKERS, self.index, digits=CODE_DIGITS)

    # --- derived results shared by several queries ---------------------------
    @cached_property
    def panel(self) -> DataFrame:
        facts = [at_risk(df) for df in (self.market, self.risk_status, self.master)]
        return panel.risk_panel(self.eligible, self.days, *facts, RULES)

    @cached_property
    def stored_runs(self) -> DataFrame:
        """Runs and ST entries of the panel, which formal and pressure events are judged from."""
        return store(events.event_runs(self.panel, RULES), "event_runs")

    @cached_property
    def risk_events(self) -> DataFrame:
        return events.risk_events_of(self.stored_runs, RULES, batch_id="b1", snapshot_id="s1")

    @cached_property
    def pressure(self) -> DataFrame:
        return events.pressure_observations_of(self.stored_runs, RULES, PRESSURE, batch_id="b1", snapshot_id="s1")

    @cached_property
    def stored_events(self) -> DataFrame:
        """Events as the stored hand-off table between detection and evaluation."""
        return store(self.risk_events, "risk_events")

    @cached_property
    def stored_pressure(self) -> DataFrame:
        return store(self.pressure, "pressure_observations")

    @cached_property
    def assessments(self) -> DataFrame:
        return self.assessed(self.stored_events)

    def assessed(self, found: DataFrame) -> DataFrame:
        """Assessments of formal or pressure events. Most securities at risk have some, so the
        other markets are left out by name, and no join looks for the rest."""
        cells = assess.wide_to_cells(self._wide(at_risk(self.facts)), BROKERS, digits=CODE_DIGITS)
        return assess.assess_events(found, cells, at_risk(self.st_known), self.days, self.index, BROKERS, MAPPING)

    @cached_property
    def stored_assessments(self) -> DataFrame:
        """Assessments as the stored result that several metric tables read."""
        return store(self.assessments, "assessments")

    @cached_property
    def stored_pressure_assessments(self) -> DataFrame:
        return store(self.assessed(self.stored_pressure.withColumnRenamed("observation_date", "risk_date")), "pressure_assessments")

    @cached_property
    def exposure_states(self) -> DataFrame:
        return assess.exposure_states(
            self.eligible, self.days, (START, END), self.cells, self.st_known, BROKERS, MAPPING
        )
