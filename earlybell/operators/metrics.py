"""Hit rates, warning days, warning rates and their summary.

Every metric is emitted for each event type and for both types together, on a
dense broker x view grid, so a broker without events still has a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S

VIEW_NAMES = {
    R.LIMIT_DOWN_EVENT: "非ST连续跌停风险股票",
    R.NEW_ST_EVENT: "新增ST风险股票",
    R.ALL_EVENTS: "两类风险股票合计",
}


def view_grid(spark: SparkSession, brokers: Sequence[str], buckets: Sequence[str] | None = None) -> DataFrame:
    """Broker x view (x grade) rows; configuration-sized."""
    if buckets is None:
        return R.literal_rows(spark, ("broker_id", "event_type_view"), [(b, v) for b in brokers for v in R.EVENT_VIEWS])
    return R.literal_rows(
        spark,
        ("broker_id", "event_type_view", "grade"),
        [(b, v, g) for b in brokers for v in R.EVENT_VIEWS for g in buckets],
    )


def with_views(df: DataFrame) -> DataFrame:
    """Each row once under its own event type and once under all events (G1)."""
    return df.withColumn(
        "event_type_view", F.explode(F.array("event_type", F.lit(R.ALL_EVENTS)))
    )


def _densify(grid: DataFrame, metrics: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    return F.broadcast(grid).join(metrics, list(keys), "left").fillna(0, list(counts))


def hit_rates(assessments: DataFrame, brokers: Sequence[str]) -> DataFrame:
    """Event and security hit rates (G2); unknown verdicts stay in the denominators.

    Securities are folded first, so the distinct counts need no second dedup.
    """
    per_security = (
        with_views(assessments)
        .groupBy("broker_id", "event_type_view", *R.KEY)
        .agg(
            F.count("*").alias("events"),
            F.count_if("is_hit").alias("hits"),
            F.count_if(F.col("is_hit").isNull()).alias("unknowns"),
        )
    )
    counts = [
        "risk_event_count",
        "hit_event_count",
        "unknown_event_count",
        "risk_security_count",
        "hit_risk_security_count",
        "unknown_security_count",
    ]
    totals = per_security.groupBy("broker_id", "event_type_view").agg(
        F.sum("events").alias(counts[0]),
        F.sum("hits").alias(counts[1]),
        F.sum("unknowns").alias(counts[2]),
        F.count("*").alias(counts[3]),
        F.count_if(F.col("hits") > 0).alias(counts[4]),
        F.count_if((F.col("hits") == 0) & (F.col("unknowns") > 0)).alias(counts[5]),
    )
    grid = view_grid(assessments.sparkSession, brokers)
    return _densify(grid, totals, ("broker_id", "event_type_view"), counts).select(
        "broker_id",
        "event_type_view",
        *counts[:3],
        S.rate("hit_event_count", "risk_event_count").alias("event_hit_rate"),
        *counts[3:],
        S.rate("hit_risk_security_count", "risk_security_count").alias("security_hit_rate"),
        F.when(F.col("risk_event_count") > 0, "DEFINED").otherwise("NOT_APPLICABLE").alias("result_status"),
    )


def _defined_days():
    return F.when(F.col("warning_days_status") == "DEFINED", F.col("warning_trading_days"))


def _day_stats() -> list:
    # warning days are small integers (bounded by the calendar), so the exact
    # median's value histogram stays small per group
    days = _defined_days()
    mean = F.sum(days).cast("decimal(20,0)") / F.nullif(F.count(days), F.lit(0)).cast("decimal(20,0)")
    return [
        F.min(days).alias("warning_days_min"),
        F.max(days).alias("warning_days_max"),
        F.round(F.median(days).cast("decimal(20,6)"), 6).alias("warning_days_median"),
        F.round(mean, 6).alias("warning_days_mean"),
    ]


def warning_days_distribution(assessments: DataFrame, brokers: Sequence[str]) -> DataFrame:
    """Warning-day statistics and status counts per broker and view."""
    counts = [
        "defined_sample_count",
        "identified_days_unknown_count",
        "not_identified_count",
        "unknown_assessment_count",
    ]
    status = F.col("identification_status")
    stats = (
        with_views(assessments)
        .groupBy("broker_id", "event_type_view")
        .agg(
            F.count(_defined_days()).alias(counts[0]),
            F.count_if((status == "IDENTIFIED") & (F.col("warning_days_status") == "UNKNOWN")).alias(counts[1]),
            F.count_if(status == "NOT_IDENTIFIED").alias(counts[2]),
            F.count_if(status == "UNKNOWN").alias(counts[3]),
            *_day_stats(),
        )
    )
    grid = view_grid(assessments.sparkSession, brokers)
    return _densify(grid, stats, ("broker_id", "event_type_view"), counts).withColumn(
        "result_status", F.when(F.col("defined_sample_count") > 0, "DEFINED").otherwise("NOT_APPLICABLE")
    )


def _last_events(events: DataFrame) -> DataFrame:
    """Latest first-fact date per security and view: later than a day iff any event is."""
    return events.groupBy(*R.KEY).agg(
        *[
            F.max(F.when(F.col("event_type") == v, F.col("first_fact_date")) if v != R.ALL_EVENTS else F.col("first_fact_date")).alias(f"last_{i}")
            for i, v in enumerate(R.EVENT_VIEWS)
        ]
    )


def _by_view(counted: DataFrame, keys: Sequence[str], scope: str) -> DataFrame:
    views = F.explode(
        F.array(
            *[
                F.struct(F.lit(v).alias("view"), F.coalesce(F.col(f"n_{i}"), F.lit(0)).alias("n"))
                for i, v in enumerate(R.EVENT_VIEWS)
            ]
        )
    )
    snapshot = F.col("snapshot_date") if "snapshot_date" in keys else F.lit(None).cast("date")
    return counted.withColumn("v", views).select(
        "broker_id",
        F.col("v.view").alias("event_type_view"),
        F.lit(scope).alias("aggregation_scope"),
        snapshot.alias("snapshot_trading_date"),
        F.col("v.n").alias("dangerous_risk_security_count"),
        "dangerous_security_count",
        "unknown_classification_security_count",
        S.rate("v.n", "dangerous_security_count").alias("warning_rate"),
        F.when(F.col("dangerous_security_count") > 0, "DEFINED").otherwise("NOT_APPLICABLE").alias("result_status"),
    )


def warning_rates_snapshot(states: DataFrame, events: DataFrame, brokers: Sequence[str], days: DataFrame) -> DataFrame:
    """Share of the securities dangerous on a day that have a later event.

    Counted straight off the daily states: three conditional counts per broker-day,
    then one row per view, on the dense broker x day grid.
    """
    later = states.join(_last_events(events), list(R.KEY), "left")
    dangerous = F.col("final_bucket") == "DANGEROUS"
    counted = later.groupBy("broker_id", "snapshot_date").agg(
        F.count_if(dangerous).alias("dangerous_security_count"),
        F.count_if(F.col("final_bucket") == "UNKNOWN").alias("unknown_classification_security_count"),
        *[F.count_if(dangerous & (F.col(f"last_{i}") > F.col("snapshot_date"))).alias(f"n_{i}") for i in range(3)],
    )
    grid = days.select(
        F.col("trading_date").alias("snapshot_date"), F.explode(F.array(*[F.lit(b) for b in brokers])).alias("broker_id")
    ).distinct()
    dense = grid.join(counted, ["broker_id", "snapshot_date"], "left").fillna(
        0, ["dangerous_security_count", "unknown_classification_security_count"]
    )
    return _by_view(dense, ("broker_id", "snapshot_date"), "SNAPSHOT")


def warning_rates_period(states: DataFrame, events: DataFrame, brokers: Sequence[str]) -> DataFrame:
    """Share of securities ever dangerous with an event after their first exposure."""
    bucket = F.col("final_bucket")
    firsts = states.groupBy("broker_id", *R.KEY).agg(
        F.min(F.when(bucket == "DANGEROUS", F.col("snapshot_date"))).alias("first_date"),
        F.max(F.coalesce(bucket == "UNKNOWN", F.lit(False))).alias("ever_unknown"),
    )
    counted = (
        firsts.join(_last_events(events), list(R.KEY), "left")
        .groupBy("broker_id")
        .agg(
            F.count("first_date").alias("dangerous_security_count"),
            F.count_if("ever_unknown").alias("unknown_classification_security_count"),
            *[F.count_if(F.col(f"last_{i}") > F.col("first_date")).alias(f"n_{i}") for i in range(3)],
        )
    )
    grid = R.literal_rows(states.sparkSession, ("broker_id",), [(b,) for b in brokers])
    dense = F.broadcast(grid).join(counted, "broker_id", "left").fillna(
        0, ["dangerous_security_count", "unknown_classification_security_count"]
    )
    return _by_view(dense, ("broker_id",), "OBSERVATION_PERIOD")


def final_summary(days: DataFrame, hits: DataFrame, rates: DataFrame) -> DataFrame:
    """The three metric tables on one row per broker and view."""
    keys = ["broker_id", "event_type_view"]
    period = rates.where(F.col("aggregation_scope") == "OBSERVATION_PERIOD").drop("result_status")
    names = F.create_map(*[F.lit(x) for pair in VIEW_NAMES.items() for x in pair])
    return (
        days.drop("result_status")
        .join(hits.drop("result_status"), keys)
        .join(period, keys)
        .select(
            *keys,
            names[F.col("event_type_view")].alias("risk_type_zh"),
            "defined_sample_count",
            "identified_days_unknown_count",
            "warning_days_min",
            "warning_days_max",
            "warning_days_median",
            "warning_days_mean",
            "risk_event_count",
            "hit_event_count",
            "event_hit_rate",
            "risk_security_count",
            "hit_risk_security_count",
            "security_hit_rate",
            "dangerous_risk_security_count",
            "dangerous_security_count",
            "unknown_classification_security_count",
            "warning_rate",
        )
    )


def summary_key_mismatches(days: DataFrame, hits: DataFrame, rates: DataFrame) -> DataFrame:
    """Broker-view keys that are not in all three tables (BM402)."""
    keys = ["broker_id", "event_type_view"]
    period = rates.where(F.col("aggregation_scope") == "OBSERVATION_PERIOD")
    tagged = (
        days.select(*keys).distinct().unionByName(hits.select(*keys).distinct()).unionByName(period.select(*keys).distinct())
    )
    return tagged.groupBy(*keys).agg(F.count("*").alias("table_count")).where("table_count <> 3")


def grade_event_detail(assessments: DataFrame, broker_id: str) -> DataFrame:
    """Traceable per-event detail of one broker with its grade bucket."""
    return (
        assessments.where(F.col("broker_id") == broker_id)
        .withColumn("raw_classification", F.upper(F.trim(F.coalesce("raw_classification", F.lit("")))))
        .withColumn("grade", S.grade_bucket("raw_classification", "selected_classification_date"))
    )


def grade_event_summary(assessments: DataFrame, broker_id: str) -> DataFrame:
    """Event statistics per view and grade A-G/BLANK/UNKNOWN of one broker."""
    counts = [
        "risk_event_count",
        "hit_event_count",
        "unknown_event_count",
        "risk_security_count",
        "hit_risk_security_count",
        "defined_warning_days_count",
    ]
    key = F.struct(*R.KEY)
    stats = (
        with_views(grade_event_detail(assessments, broker_id))
        .groupBy("event_type_view", "grade")
        .agg(
            F.count("*").alias(counts[0]),
            F.count_if("is_hit").alias(counts[1]),
            F.count_if(F.col("is_hit").isNull()).alias(counts[2]),
            F.count_distinct(key).alias(counts[3]),
            F.count_distinct(F.when(F.col("is_hit"), key)).alias(counts[4]),
            F.count(_defined_days()).alias(counts[5]),
            *_day_stats(),
        )
    )
    grid = view_grid(assessments.sparkSession, [broker_id], R.GRADE_BUCKETS)
    return (
        _densify(grid, stats, ("event_type_view", "grade"), counts)
        .withColumn("event_hit_rate", S.rate("hit_event_count", "risk_event_count"))
        .withColumn("security_hit_rate", S.rate("hit_risk_security_count", "risk_security_count"))
        .withColumn("result_status", F.when(F.col("risk_event_count") > 0, "DEFINED").otherwise("NOT_APPLICABLE"))
    )


def count_reconciliation(
    events: DataFrame,
    assessments: DataFrame,
    days: DataFrame,
    hits: DataFrame,
    rates: DataFrame,
    brokers: Sequence[str],
    snapshot_days: DataFrame,
) -> DataFrame:
    """Expected against actual row counts across the result tables."""
    n = len(brokers)

    def one(df: DataFrame, value, name: str) -> DataFrame:
        return df.agg(value.alias("n")).select(F.lit(name).alias("name"), F.col("n").cast("bigint"))

    parts = [
        one(events, F.count("*") * n, "expected_assessments"),
        one(assessments, F.count("*"), "assessments"),
        one(assessments, F.count_distinct("event_key", "broker_id"), "assessment_keys"),
        one(days, F.count("*"), "warning_day_rows"),
        one(hits, F.count("*"), "hit_rate_rows"),
        one(snapshot_days, (F.count_distinct("trading_date") + 1) * n * len(R.EVENT_VIEWS), "expected_warning_rates"),
        one(rates, F.count("*"), "warning_rate_rows"),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    flat = stacked.groupBy().pivot("name", [
        "expected_assessments", "assessments", "assessment_keys", "warning_day_rows",
        "hit_rate_rows", "expected_warning_rates", "warning_rate_rows",
    ]).agg(F.first("n"))
    return flat.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("check_name"), F.col(want).alias("expected"), F.col(got).alias("actual"))
                    for name, want, got in (
                        ("BM402_ASSESSMENT_COUNT", "expected_assessments", "assessments"),
                        ("BM401_ASSESSMENT_KEYS", "assessments", "assessment_keys"),
                        ("BM402_WARNING_RATE_COUNT", "expected_warning_rates", "warning_rate_rows"),
                    )
                ],
                F.struct(F.lit("BM402_WARNING_DAY_COUNT").alias("check_name"), F.lit(3 * n).cast("bigint").alias("expected"), F.col("warning_day_rows").alias("actual")),
                F.struct(F.lit("BM402_HIT_RATE_COUNT").alias("check_name"), F.lit(3 * n).cast("bigint").alias("expected"), F.col("hit_rate_rows").alias("actual")),
            )
        ).alias("c")
    ).select("c.*", (F.col("c.expected") == F.col("c.actual")).alias("passed"))
