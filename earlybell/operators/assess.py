"""Point-in-time assessment of events and daily dangerous exposures.

Histories arrive in *cell* form: one row per security and classification date
with ``grades``, an array of raw values aligned with the broker list. A blank
cell is a record (it replaces the previous grade), so the whole array is carried
forward at once and brokers are exploded only after the carry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.panel import DAY, SORT_KEY, before, carry, day_arrays, expected_days, running, stack_by_day

EVENT_FIELDS = ("event_type", "first_fact_date", "risk_date")


# --- history shapes ---------------------------------------------------------
def wide_to_cells(
    wide: DataFrame, brokers: Sequence[str], *, day: str = "biz_date", code: str = "stk_code", digits: str = R.CODE_DIGITS
) -> DataFrame:
    """Wide history to cells: weekend rows dropped, codes canonical, blanks kept as ''."""
    cells = F.array(*[F.coalesce(F.trim(F.col(f"`{b}`").cast("string")), F.lit("")) for b in brokers])
    return (
        wide.where(~S.is_weekend(day))
        .select(
            S.security_market(code, digits).alias("market_code"),
            S.canonical_security(code, digits).alias("security_code"),
            F.col(day).alias("classification_date"),
            cells.alias("grades"),
        )
        .where(F.col("market_code").isNotNull())
    )


def uncanonical_codes(wide: DataFrame, *, code: str = "stk_code", digits: str = R.CODE_DIGITS) -> DataFrame:
    """Codes without a canonical form, with their rows: what ``wide_to_cells`` leaves out."""
    return (
        wide.where(S.security_market(code, digits).isNull())
        .groupBy(F.coalesce(F.col(code).cast("string"), F.lit("")).alias("stk_code"))
        .agg(F.count("*").alias("affected_rows"))
    )


def version_conflicts(cells: DataFrame) -> DataFrame:
    """Security-days of a history with several records that differ (BM304), with their rows.

    The panel takes one record per security-day; a run must refuse while any differ.
    """
    per_day = cells.groupBy(*R.KEY, "classification_date").agg(
        F.count("*").alias("affected_rows"), F.min("grades").alias("low"), F.max("grades").alias("high")
    )
    return per_day.where("low <> high").select(*R.KEY, "classification_date", "affected_rows")


def wide_to_long(
    wide: DataFrame,
    brokers: Sequence[str],
    index: DataFrame,
    *,
    day: str = "biz_date",
    code: str = "stk_code",
    digits: str = R.CODE_DIGITS,
) -> DataFrame:
    """Wide history to one record per broker with its first usable session."""
    long = (
        wide.where(~S.is_weekend(day))
        .select(
            S.security_market(code, digits).alias("market_code"),
            S.canonical_security(code, digits).alias("security_code"),
            F.col(day).alias("classification_date"),
            *[F.coalesce(F.trim(F.col(f"`{b}`").cast("string")), F.lit("")).alias(b) for b in brokers],
        )
        .unpivot([*R.KEY, "classification_date"], list(brokers), "broker_id", "raw_classification")
    )
    usable = index.select(
        "market_code", F.col(DAY).alias("classification_date"), F.col("next_day").alias("first_usable_trading_day")
    )
    return long.join(usable, ["market_code", "classification_date"], "left")


def active_grades(history: DataFrame, grid: DataFrame, extra: dict[str, DataFrame] | None = None) -> DataFrame:
    """Grid days with the history record active at their close.

    ``active`` is ``struct(classification_date, grades)``; only records dated on a
    grid day or earlier count, and a grid row's own record already applies.
    """
    stacked = stack_by_day(
        {
            "grid": grid,
            "hist": history.select(
                *R.KEY, F.col("classification_date").alias(DAY), "classification_date", "grades"
            ),
            **(extra or {}),
        }
    )
    return stacked.withColumn("active", carry(F.col("hist")))


def _explode_brokers(df: DataFrame, brokers: Sequence[str], keep: Sequence[Column | str]) -> DataFrame:
    return df.select(
        *keep, "active", F.posexplode(F.array(*[F.lit(b) for b in brokers])).alias("_pos", "broker_id")
    ).select(
        *[c if isinstance(c, str) else c for c in _names(df, keep)],
        "broker_id",
        F.col("active.classification_date").alias("selected_date"),
        F.get(F.col("active.grades"), F.col("_pos")).alias("raw_classification"),
    )


def _names(df: DataFrame, keep: Sequence[Column | str]) -> list[str]:
    return df.select(*keep).columns


def classify(df: DataFrame, mapping: R.BrokerMapping, *, is_st: str = "is_st") -> DataFrame:
    """Mapped bucket, final bucket and resolution of exploded broker rows."""
    table = mapping.frame(df.sparkSession)
    final = S.final_classification(F.col("raw_classification").isNotNull(), "raw_classification", is_st, "mapped_bucket")
    return (
        df.join(F.broadcast(table), ["broker_id", "raw_classification"], "left")
        .withColumn("_final", final)
        .withColumn("final_bucket", F.col("_final.bucket"))
        .withColumn("classification_resolution", F.col("_final.resolution"))
        .drop("_final")
    )


# --- assessments ------------------------------------------------------------
def events_with_cutoff(events: DataFrame, index: DataFrame) -> DataFrame:
    """Events with the previous session (the evaluation cutoff) and the fact ordinal."""
    cal = index.select(
        "market_code",
        F.col(DAY).alias("first_fact_date"),
        F.col("previous_day").alias("cutoff_trading_date"),
        F.col("ordinal").alias("fact_ordinal"),
    )
    return events.select(*R.KEY, *EVENT_FIELDS).join(
        cal, ["market_code", "first_fact_date"], "left"
    )


def dangerous_runs(states: DataFrame, *, first_day: str = "first_day") -> DataFrame:
    """Start and left-censoring of the dangerous run each broker-day belongs to.

    Only a DANGEROUS day continues a run. The start is the first day of the run on
    which the broker itself filed a dangerous record; a run carried by ST alone has
    none. All windows share one partitioning and order, so they cost one sort.
    """
    dangerous = F.coalesce(F.col("final_bucket") == "DANGEROUS", F.lit(False))
    own = dangerous & (F.col("mapped_bucket") == "DANGEROUS") & (F.col("selected_date") == F.col(DAY))
    own = F.coalesce(own, F.lit(False))
    marked = (
        states.withColumn("_own", own)
        .withColumn("_break", carry(F.when(~dangerous, F.col("ordinal")), running("broker_id")))
        .withColumn("_prior", carry(F.when(own, F.col("ordinal")), before("broker_id")))
    )
    starts = F.col("_own") & (F.col("_prior").isNull() | (F.col("_prior") < F.coalesce("_break", F.lit(0))))
    run = carry(F.when(starts, F.struct("ordinal", DAY)), running("broker_id"))
    return (
        marked.withColumn("_run", run)
        .withColumn("_run", F.when(dangerous & (F.col("_run.ordinal") > F.coalesce("_break", F.lit(0))), F.col("_run")))
        .withColumn("dangerous_run_start_date", F.col(f"_run.{DAY}"))
        .withColumn("run_start_ordinal", F.col("_run.ordinal"))
        .withColumn("run_left_censored", F.coalesce(F.col(f"_run.{DAY}") == F.col(first_day), F.lit(False)))
        .drop("_own", "_break", "_prior", "_run")
    )


def state_grid(securities: DataFrame, days: DataFrame) -> DataFrame:
    """Lifecycle grid of securities with the market's first session attached."""
    first = day_arrays(days).select("market_code", F.get("days", F.lit(0)).alias("first_day"))
    return (
        expected_days(securities, days)
        .select(*R.KEY, DAY, "ordinal")
        .join(first, "market_code")
    )


def broker_states(
    grid: DataFrame,
    history: DataFrame,
    st: DataFrame,
    brokers: Sequence[str],
    mapping: R.BrokerMapping,
    extra: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Final bucket per security, broker and grid day (P9 on the carried record).

    ``grid`` needs the key, trading_date, ordinal and first_day; each ``extra`` source, at most
    one row per security-day, becomes a struct column of that name.
    """
    extra = extra or {}
    sources = {"st": st.select(*R.KEY, DAY, "is_st"), **extra}
    panel = active_grades(history, grid, sources).where(F.col("grid").isNotNull())
    exploded = _explode_brokers(
        panel,
        brokers,
        [*R.KEY, DAY, *[F.col(f"grid.{c}").alias(c) for c in ("ordinal", "first_day")], *extra,
         F.col("st.is_st").alias("is_st")],
    )
    return classify(exploded, mapping)


def assess_events(
    events: DataFrame,
    history: DataFrame,
    st: DataFrame,
    days: DataFrame,
    index: DataFrame,
    brokers: Sequence[str],
    mapping: R.BrokerMapping,
    *,
    rule_version: str = "v6",
    batch_id: str = "",
    missing_history: DataFrame | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """One row per event and broker, judged at the previous session's close.

    Events are a source of the panel on their cutoff day, so the daily states never leave
    the security's partition: history, ST states and events meet in one exchange. The grid
    ends at a security's last cutoff, since a state depends on no later day. An
    event whose previous session is not in the calendar is kept as UNKNOWN.
    ``prefilter`` semi-joins history and ST to the event securities first; use it
    when ``events`` is a stored table, since the join reads it again.
    """
    calendar = day_arrays(days).withColumn("first_day", F.get("days", F.lit(0)))
    # an event without a previous session rides on the first grid day and stays UNKNOWN
    cut = (
        events_with_cutoff(events, index)
        .join(calendar.select("market_code", "first_day"), "market_code", "left")
        .withColumn(DAY, F.coalesce("cutoff_trading_date", "first_day"))
    )
    due = cut.groupBy(*SORT_KEY, DAY).agg(
        # bounded: one event per type and day
        F.array_sort(F.collect_list(F.struct("cutoff_trading_date", *EVENT_FIELDS, "fact_ordinal"))).alias("events")
    )
    if prefilter:
        keys = events.select(*R.KEY).distinct()
        history = history.join(keys, list(R.KEY), "left_semi")
        st = st.join(keys, list(R.KEY), "left_semi")
    grid = (
        cut.groupBy(*R.KEY).agg(F.max(DAY).alias("last_due"))
        .join(calendar, "market_code", "left")
        .select(*R.KEY, "last_due", "first_day", F.posexplode_outer("days").alias("pos", DAY))
        .where(F.col(DAY).isNull() | (F.col(DAY) <= F.col("last_due")))
        .select(*R.KEY, DAY, (F.col("pos") + 1).alias("ordinal"), "first_day")
    )
    states = broker_states(grid, history, st, brokers, mapping, {"due": due})
    rows = (
        dangerous_runs(states)
        .where(F.col("due").isNotNull())
        .withColumn("event", F.explode("due.events"))
        .select(
            *R.KEY,
            *[F.col(f"event.{c}").alias(c) for c in ("cutoff_trading_date", *EVENT_FIELDS, "fact_ordinal")],
            "broker_id",
            "selected_date",
            "raw_classification",
            "mapped_bucket",
            "mapping_record_id",
            "is_st",
            "final_bucket",
            "classification_resolution",
            "dangerous_run_start_date",
            "run_start_ordinal",
            "run_left_censored",
        )
    )
    uncut = F.col("cutoff_trading_date").isNull()
    rows = (
        rows.withColumn("final_bucket", F.when(uncut, "UNKNOWN").otherwise(F.col("final_bucket")))
        .withColumn(
            "classification_resolution",
            F.when(uncut, "CALENDAR_COVERAGE_MISSING").otherwise(F.col("classification_resolution")),
        )
        .withColumn("selected_date", F.when(~uncut, F.col("selected_date")))
        .withColumn("raw_classification", F.when(~uncut, F.col("raw_classification")))
        .withColumn("is_st", F.when(~uncut, F.col("is_st")))
    )
    if missing_history is not None:
        flagged = missing_history.select(*R.KEY).distinct().withColumn("_no_history", F.lit(True))
        gone = F.coalesce(F.col("_no_history"), F.lit(False))
        rows = rows.join(flagged, list(R.KEY), "left")
        rows = (
            rows.withColumn("final_bucket", F.when(gone, "UNKNOWN").otherwise(F.col("final_bucket")))
            .withColumn(
                "classification_resolution",
                F.when(gone, "SECURITY_HISTORY_MISSING").otherwise(F.col("classification_resolution")),
            )
            .withColumn("selected_date", F.when(~gone, F.col("selected_date")))
            .withColumn("raw_classification", F.when(~gone, F.col("raw_classification")))
            .withColumn("mapping_record_id", F.when(~gone, F.col("mapping_record_id")))
            .drop("_no_history")
        )
    return assessment_verdict(rows, mapping, rule_version=rule_version, batch_id=batch_id)


def assessment_verdict(rows: DataFrame, mapping: R.BrokerMapping, *, rule_version: str, batch_id: str) -> DataFrame:
    """Identification, hit flag, warning days and reason code."""
    bucket = F.col("final_bucket")
    unknown = bucket == "UNKNOWN"
    dangerous = F.coalesce(bucket == "DANGEROUS", F.lit(False))
    no_start = F.col("dangerous_run_start_date").isNull()
    censored = F.coalesce(F.col("run_left_censored"), F.lit(False))
    resolution = F.col("classification_resolution")
    defined = dangerous & ~no_start & ~censored
    unknown_reason = (
        F.when(resolution == "ST_STATUS_MISSING", "BM203_ST_STATUS_MISSING")
        .when(resolution == "MAPPING_UNKNOWN", "BM301_MAPPING_UNKNOWN")
        .when(resolution == "SECURITY_HISTORY_MISSING", "BM109_SECURITY_HISTORY_MISSING")
        .when(resolution == "CALENDAR_COVERAGE_MISSING", "BM201_CALENDAR_COVERAGE_MISSING")
        .otherwise("BM307_PIT_EVIDENCE_UNKNOWN")
    )
    return rows.select(
        S.event_key().alias("event_key"),
        *R.KEY,
        *EVENT_FIELDS,
        "broker_id",
        "cutoff_trading_date",
        F.col("selected_date").alias("selected_classification_date"),
        "raw_classification",
        F.lit(mapping.version).alias("mapping_version"),
        F.coalesce("mapping_record_id", F.lit("")).alias("mapping_record_id"),
        F.when(F.col("is_st").isNull(), "UNKNOWN").when(F.col("is_st"), "ST").otherwise("NON_ST").alias("cutoff_st_state"),
        "final_bucket",
        "classification_resolution",
        F.when(unknown, "UNKNOWN").when(dangerous, "IDENTIFIED").otherwise("NOT_IDENTIFIED").alias("identification_status"),
        F.when(F.coalesce(unknown, F.lit(False)), F.lit(None).cast("boolean")).otherwise(dangerous).alias("is_hit"),
        F.when(unknown, "UNKNOWN")
        .when(defined, "DEFINED")
        .when(dangerous, "UNKNOWN")
        .otherwise("NOT_APPLICABLE")
        .alias("warning_days_status"),
        F.when(dangerous, F.col("dangerous_run_start_date")).alias("dangerous_run_start_date"),
        F.when(defined, F.col("fact_ordinal") - F.col("run_start_ordinal")).alias("warning_trading_days"),
        F.when(unknown, unknown_reason)
        .when(defined, "BM300_IDENTIFIED")
        .when(dangerous & no_start, "BM305_NO_BROKER_START_FOR_ST_OVERRIDE")
        .when(dangerous, "BM303_DANGEROUS_RUN_LEFT_CENSORED")
        .when(F.col("selected_date").isNull(), "BM302_NO_USABLE_CLASSIFICATION")
        .otherwise("BM306_FINAL_NON_DANGEROUS")
        .alias("reason_code"),
        F.lit(rule_version).alias("metric_rule_version"),
        F.lit(batch_id).alias("metric_batch_id"),
    )


def at_cutoffs(daily: DataFrame, cut: DataFrame) -> DataFrame:
    """Daily rows on the events' cutoff days only.

    The semi-join lets Catalyst broadcast the cutoffs while they are small, so the
    daily table is filtered where it is scanned instead of being shuffled whole.
    """
    return daily.join(cut.select(*R.KEY, DAY).distinct(), [*R.KEY, DAY], "left_semi")


def cutoff_only_assessments(
    events: DataFrame,
    grades: DataFrame,
    st: DataFrame,
    index: DataFrame,
    broker_id: str,
    mapping: R.BrokerMapping,
) -> DataFrame:
    """Hit verdict from the cutoff day alone, without warning days.

    ``grades`` is a daily single-broker history (key, trading_date, grade) that must
    have a row on the cutoff; missing evidence stays visible as UNKNOWN.
    """
    cut = events_with_cutoff(events, index).withColumnRenamed("cutoff_trading_date", DAY)
    graded = at_cutoffs(grades.select(*R.KEY, DAY, F.col("grade").alias("raw_classification")), cut)
    joined = (
        cut.join(graded, [*R.KEY, DAY], "left")
        .join(at_cutoffs(st.select(*R.KEY, DAY, "is_st"), cut), [*R.KEY, DAY], "left")
        .withColumn("broker_id", F.lit(broker_id))
    )
    hit = F.col("final_bucket") == "DANGEROUS"
    known = F.col("final_bucket").isin("DANGEROUS", "NON_DANGEROUS")
    return classify(joined, mapping).select(
        S.event_key().alias("event_key"),
        *R.KEY,
        *EVENT_FIELDS,
        "broker_id",
        F.col(DAY).alias("cutoff_trading_date"),
        F.when(F.col("raw_classification").isNotNull(), F.col(DAY)).alias("selected_classification_date"),
        "raw_classification",
        "final_bucket",
        "classification_resolution",
        F.when(~F.coalesce(known, F.lit(False)), "UNKNOWN").when(hit, "IDENTIFIED").otherwise("NOT_IDENTIFIED").alias("identification_status"),
        F.when(F.coalesce(known, F.lit(False)), hit).alias("is_hit"),
        F.lit("NOT_CALCULATED").alias("warning_days_status"),
        F.lit(None).cast("int").alias("warning_trading_days"),
        F.lit("SCORING_CUTOFF_ONLY").alias("reason_code"),
    )


def cutoff_st_evidence(events: DataFrame, st: DataFrame, index: DataFrame) -> DataFrame:
    """Exact ST state at each event's previous session, flagged when absent."""
    cut = events_with_cutoff(events, index).withColumnRenamed("cutoff_trading_date", DAY)
    return cut.join(at_cutoffs(st.select(*R.KEY, DAY, "is_st"), cut), [*R.KEY, DAY], "left").select(
        S.event_key().alias("event_key"),
        F.col(DAY).alias("cutoff_date"),
        F.when(F.col("is_st").isNull(), "MISSING").when(F.col("is_st"), "ST").otherwise("NON_ST").alias("st_state"),
        (F.col("is_st") & (F.col("event_type") == R.NEW_ST_EVENT)).alias("contradicts_event"),
    )


# --- exposures --------------------------------------------------------------
def exposure_states(
    securities: DataFrame,
    days: DataFrame,
    window: tuple,
    history: DataFrame,
    st: DataFrame,
    brokers: Sequence[str],
    mapping: R.BrokerMapping,
) -> DataFrame:
    """Daily final buckets over the universe, lifecycle-clipped to the window."""
    start, end = window
    inside = days.where(F.col(DAY).between(F.lit(start), F.lit(end)))
    return broker_states(
        state_grid(securities, inside), history.where(F.col("classification_date") <= F.lit(end)), st, brokers, mapping
    ).select(*R.KEY, "broker_id", F.col(DAY).alias("snapshot_date"), "final_bucket")


def dangerous_exposures(states: DataFrame) -> DataFrame:
    return states.where(F.col("final_bucket") == "DANGEROUS").drop("final_bucket")


def unknown_counts(states: DataFrame) -> DataFrame:
    """Unknown securities per broker and day."""
    return states.groupBy("broker_id", "snapshot_date").agg(
        F.count_if(F.col("final_bucket") == "UNKNOWN").alias("unknown_count")
    )


# --- audits -----------------------------------------------------------------
def assessment_findings(assessments: DataFrame) -> DataFrame:
    """Audited reason codes as findings."""
    return assessments.where(F.col("reason_code").isin(*R.AUDITED_REASONS)).select(
        F.col("reason_code").alias("code"),
        F.lit("WARNING").alias("severity"),
        F.concat_ws("/", "identification_status", "warning_days_status").alias("message"),
        "broker_id",
        *R.KEY,
        F.col("first_fact_date").alias("fact_date"),
    )


def lookahead_violations(assessments: DataFrame, index: DataFrame) -> DataFrame:
    """Assessments that use information from after their cutoff (Q27); empty when sound."""
    usable = index.select(
        "market_code",
        F.col(DAY).alias("selected_classification_date"),
        F.col("ordinal").alias("_sel"),
    )
    joined = assessments.join(usable, ["market_code", "selected_classification_date"], "left")
    return joined.select(
        "event_key",
        "broker_id",
        F.when(F.col("cutoff_trading_date") >= F.col("first_fact_date"), "CUTOFF_NOT_BEFORE_FACT")
        .when(F.col("selected_classification_date") > F.col("cutoff_trading_date"), "SELECTED_AFTER_CUTOFF")
        .when(F.col("selected_classification_date").isNotNull() & F.col("_sel").isNull(), "SELECTED_ON_CLOSED_DAY")
        .alias("violation"),
    ).where(F.col("violation").isNotNull())
