"""Event detection on the risk panel: limit-down segments, ST entries, pressure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.panel import DAY, SORT_KEY, by_day, running



def event_runs(panel: DataFrame, rules: R.RiskRules) -> DataFrame:
    """Limit-down runs (any length) and ST entries from one scan of the panel.

    The panel holds every in-lifecycle session, so a suspension, an ST day or any
    other non-limit-down day closes a run. The board is the one in force on the
    run's first day. An ST entry is a non-ST to ST step between consecutive
    sessions; the first session compares with the baseline, which for a security
    listed inside the window is its own first state (so it is no event).

    Columns: key, is_st_entry, board_code, consecutive_length, first_fact_date,
    last_fact_date, open_at_observation_end, fact_days, source_record_ids.
    """
    first = F.row_number().over(by_day()) == 1
    listed_inside = F.coalesce(F.col("listed_date") >= F.lit(rules.observation_start), F.lit(False))

    def before_day(current: str, baseline: str):
        return (
            F.when(~first, F.lag(current).over(by_day()))
            .when(listed_inside, F.col(current))
            .otherwise(F.col(baseline))
        )

    flagged = panel.select(
        *R.KEY,
        DAY,
        "ordinal",
        "board_code",
        "source_record_id",
        "st_source_record_id",
        "is_st",
        "is_limit_down",
        before_day("is_st", "baseline_st").alias("previous_st"),
        before_day("st_source_record_id", "baseline_source").alias("previous_source"),
        F.lead(DAY).over(by_day()).isNull().alias("is_last_day"),
        F.sum(F.when(F.col("is_limit_down"), 0).otherwise(1)).over(running()).alias("run_id"),
    ).withColumn("is_st_entry", F.coalesce(~F.col("previous_st") & F.col("is_st"), F.lit(False)))
    sources = F.when(
        F.col("is_st_entry"), F.array("previous_source", "st_source_record_id")
    ).otherwise(F.array("source_record_id"))
    return (
        flagged.where(F.col("is_limit_down") | F.col("is_st_entry"))
        # an ST entry forms its own group; a run never exceeds the calendar's days
        .groupBy(*SORT_KEY, "is_st_entry", F.when(F.col("is_st_entry"), F.col("ordinal")).otherwise(F.col("run_id")).alias("run"))
        .agg(
            F.min_by("board_code", DAY).alias("board_code"),
            F.count("*").cast("int").alias("consecutive_length"),
            F.min(DAY).alias("first_fact_date"),
            F.max(DAY).alias("last_fact_date"),
            F.max("is_last_day").alias("open_at_observation_end"),
            F.array_sort(F.collect_list(F.struct(DAY, sources.alias("ids")))).alias("facts"),
        )
        .select(
            *R.KEY,
            "is_st_entry",
            "board_code",
            "consecutive_length",
            "first_fact_date",
            "last_fact_date",
            "open_at_observation_end",
            F.col(f"facts.{DAY}").alias("fact_days"),
            F.flatten("facts.ids").alias("source_record_ids"),
        )
    )


def _day_at(position) -> F.Column:
    return F.get(F.col("fact_days"), position - 1)


def _judged(runs: DataFrame, rules: R.RiskRules) -> DataFrame:
    """ST entries and the runs of at least the minimum length, with number and verdict."""
    entry = F.col("is_st_entry")
    numbering = Window.partitionBy(*SORT_KEY, "is_st_entry").orderBy("first_fact_date")
    reached = F.coalesce(F.col("consecutive_length") >= F.col("applicable_threshold"), F.lit(False))
    return (
        runs.where(entry | (F.col("consecutive_length") >= rules.minimum_segment_length))
        .withColumn("applicable_threshold", S.lookup("board_code", rules.thresholds))
        .withColumn("segment_number", F.row_number().over(numbering))
        .withColumn("threshold_reached", ~entry & reached)
        .withColumn(
            "threshold_reached_date", F.when(F.col("threshold_reached"), _day_at(F.col("applicable_threshold")))
        )
    )


def limit_down_segments(
    panel: DataFrame, rules: R.RiskRules, *, batch_id: str = "", snapshot_id: str = ""
) -> DataFrame:
    """Runs of at least the minimum length with their threshold verdict."""
    return (
        _judged(event_runs(panel, rules), rules)
        .where(~F.col("is_st_entry"))
        .select(
            *R.KEY,
            "segment_number",
            F.lit(rules.continuous_event_type).alias("event_type"),
            F.lit("RQDATA_MARKET_DAILY_DERIVED").alias("event_source"),
            "board_code",
            "applicable_threshold",
            "consecutive_length",
            "first_fact_date",
            "threshold_reached_date",
            "last_fact_date",
            "threshold_reached",
            "open_at_observation_end",
            F.lit(rules.rule_version).alias("rule_version"),
            F.lit(batch_id).alias("calculation_batch_id"),
            F.lit(snapshot_id).alias("upstream_snapshot_id"),
            "source_record_ids",
        )
    )


def st_baselines(panel: DataFrame, rules: R.RiskRules) -> DataFrame:
    """Baseline state per scanned security with its date and reason."""
    inside = F.coalesce(F.col("listed_date") >= F.lit(rules.observation_start), F.lit(False))
    return (
        panel.groupBy(*R.KEY)
        .agg(
            F.min_by(
                F.struct(
                    F.when(inside, F.col(DAY)).otherwise(F.col("baseline_date")).alias("baseline_date"),
                    F.when(inside, F.col("is_st")).otherwise(F.col("baseline_st")).alias("is_st"),
                    F.when(inside, "FIRST_IN_LIFECYCLE_TRADING_DAY")
                    .otherwise("LATEST_STATE_BEFORE_OBSERVATION_START")
                    .alias("reason"),
                ),
                DAY,
            ).alias("b")
        )
        .select(*R.KEY, "b.baseline_date", "b.is_st", "b.reason")
    )


def risk_events(panel: DataFrame, rules: R.RiskRules, *, batch_id: str = "", snapshot_id: str = "") -> DataFrame:
    """Formal events of both types (W5): ST entries and runs that reached their threshold.

    Unique per key, type and first fact date by construction.
    """
    return risk_events_of(event_runs(panel, rules), rules, batch_id=batch_id, snapshot_id=snapshot_id)


def risk_events_of(runs: DataFrame, rules: R.RiskRules, *, batch_id: str = "", snapshot_id: str = "") -> DataFrame:
    """:func:`risk_events` from ``event_runs``, which a caller may have stored."""
    entry = F.col("is_st_entry")
    return (
        _judged(runs, rules)
        .where(entry | F.col("threshold_reached"))
        .select(
            *R.KEY,
            F.when(entry, rules.new_st_event_type).otherwise(rules.continuous_event_type).alias("event_type"),
            F.when(entry, "RQDATA_ST_STATUS_TRANSITION").otherwise("RQDATA_MARKET_DAILY_DERIVED").alias("event_source"),
            "first_fact_date",
            F.when(entry, F.col("first_fact_date")).otherwise(F.col("threshold_reached_date")).alias("risk_date"),
            "last_fact_date",
            "threshold_reached_date",
            F.when(~entry, F.col("segment_number")).alias("segment_number"),
            F.when(~entry, F.col("consecutive_length")).alias("consecutive_length"),
            F.when(entry, "NON_ST").alias("previous_st_state"),
            F.when(entry, "ST").alias("current_st_state"),
            F.lit(rules.rule_version).alias("rule_version"),
            F.lit(batch_id).alias("calculation_batch_id"),
            F.lit(snapshot_id).alias("upstream_snapshot_id"),
            "source_record_ids",
        )
    )


def new_st_events(panel: DataFrame, rules: R.RiskRules, **ids: str) -> DataFrame:
    """Non-ST to ST between consecutive in-lifecycle sessions."""
    return risk_events(panel, rules, **ids).where(F.col("event_type") == rules.new_st_event_type)


def duplicate_events(events: DataFrame) -> DataFrame:
    """Business keys that occur more than once (empty for a valid result)."""
    return (
        events.groupBy(*R.KEY, "event_type", "first_fact_date")
        .agg(F.count("*").alias("row_count"))
        .where("row_count > 1")
    )


def pressure_observations(
    panel: DataFrame,
    rules: R.RiskRules,
    pressure: R.PressureRules,
    *,
    batch_id: str = "",
    snapshot_id: str = "",
) -> DataFrame:
    """Low-threshold observations with their upgrade to a formal event.

    One run pass serves both thresholds: a run that also meets the formal one has
    the same first day as its formal event, so no join back is needed.
    """
    return pressure_observations_of(
        event_runs(panel, rules), rules, pressure, batch_id=batch_id, snapshot_id=snapshot_id
    )


def pressure_observations_of(
    runs: DataFrame,
    rules: R.RiskRules,
    pressure: R.PressureRules,
    *,
    batch_id: str = "",
    snapshot_id: str = "",
) -> DataFrame:
    """:func:`pressure_observations` from ``event_runs``, which a caller may have stored."""
    pressure.check_against(rules)
    length = F.col("consecutive_length")
    formal = (length >= F.col("formal_threshold")) & (length >= rules.minimum_segment_length)
    return (
        runs.where(~F.col("is_st_entry"))
        .withColumn("observation_threshold", S.lookup("board_code", pressure.thresholds))
        .withColumn("formal_threshold", S.lookup("board_code", rules.thresholds))
        .where(length >= F.col("observation_threshold"))
        .select(
            *R.KEY,
            F.lit(pressure.event_type).alias("event_type"),
            "board_code",
            "observation_threshold",
            "formal_threshold",
            "first_fact_date",
            _day_at(F.col("observation_threshold")).alias("observation_date"),
            "last_fact_date",
            "consecutive_length",
            formal.alias("upgraded_to_formal_risk"),
            F.when(formal, _day_at(F.col("formal_threshold"))).alias("formal_risk_date"),
            "open_at_observation_end",
            F.lit(pressure.rule_version).alias("pressure_rule_version"),
            F.lit(rules.rule_version).alias("formal_rule_version"),
            F.lit(batch_id).alias("calculation_batch_id"),
            F.lit(snapshot_id).alias("upstream_snapshot_id"),
            "source_record_ids",
        )
    )


def event_batch_totals(events: DataFrame, pressure: DataFrame | None = None) -> DataFrame:
    """Manifest counts of one batch."""
    totals = events.agg(
        F.count("*").alias("event_count"),
        F.count_distinct(F.struct(*R.KEY)).alias("distinct_security_count"),
        F.count_if(F.col("event_type") == R.LIMIT_DOWN_EVENT).alias("limit_down_event_count"),
        F.count_if(F.col("event_type") == R.NEW_ST_EVENT).alias("new_st_event_count"),
    ).withColumn("batch", F.lit(1))
    if pressure is None:
        return totals.drop("batch")
    observed = pressure.agg(
        F.count("*").alias("observation_event_count"),
        F.count_if("upgraded_to_formal_risk").alias("upgraded_event_count"),
        F.count_distinct(F.struct(*R.KEY)).alias("observed_security_count"),
    ).withColumn("batch", F.lit(1))
    return totals.join(observed, "batch").drop("batch")
