"""Two-sided comparison of keyed tables and of two models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S


def key_conflicts(df: DataFrame, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Keys that carry more than one distinct value."""
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*compared)).alias("a"), F.max(F.struct(*compared)).alias("b"))
        .where(~F.col("a").eqNullSafe(F.col("b")))
        .select(*keys)
    )


def two_sided_diff(actual: DataFrame, expected: DataFrame, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """MISSING / EXTRA / DIFFERENT / *_CONFLICT per key, provenance columns ignored.

    Both sides are stacked and folded per key: one shuffle, map-side combined, and
    a key repeated very often on one side collapses before it travels.
    """
    keys = list(keys)
    left = actual.select(*keys, F.struct(*compared).alias("a"))
    right = expected.select(*keys, F.struct(*compared).alias("e"))
    folded = (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.min("a").alias("a_lo"),
            F.max("a").alias("a_hi"),
            F.min("e").alias("e_lo"),
            F.max("e").alias("e_hi"),
        )
    )
    return folded.select(
        *keys,
        F.when(F.col("a_lo").isNotNull() & ~F.col("a_lo").eqNullSafe(F.col("a_hi")), "LOCAL_CONFLICT")
        .when(F.col("e_lo").isNotNull() & ~F.col("e_lo").eqNullSafe(F.col("e_hi")), "BASELINE_CONFLICT")
        .when(F.col("a_lo").isNull(), "MISSING")
        .when(F.col("e_lo").isNull(), "EXTRA")
        .when(~F.col("a_lo").eqNullSafe(F.col("e_lo")), "DIFFERENT")
        .alias("difference"),
    ).where(F.col("difference").isNotNull())


def diff_with_lifecycle(
    actual: DataFrame, expected: DataFrame, life: DataFrame, compared: Sequence[str], *, eligibility: str | None = None
) -> DataFrame:
    """Table diff where rows outside the lifecycle are informational.

    A missing key outside the lifecycle, and a difference there that concerns only
    the eligibility label, do not count as failures. Extra keys are informational.
    """
    keys = [*R.KEY, "business_date"]
    diff = two_sided_diff(actual, expected, keys, compared)
    outside = ~S.in_lifecycle("business_date", "listed_date", "delisted_date")
    known = F.col("_known")
    joined = diff.join(life.select(*R.KEY, "listed_date", "delisted_date", F.lit(True).alias("_known")), list(R.KEY), "left")
    out = F.coalesce(known & outside, F.lit(False))
    label_only = F.lit(False)
    if eligibility is not None:
        strict = [c for c in compared if c != eligibility]
        hard = two_sided_diff(actual, expected, keys, strict).select(*keys, F.lit(True).alias("_hard"))
        joined = joined.join(hard, keys, "left")
        label_only = F.col("_hard").isNull()
    return joined.select(
        *keys,
        "difference",
        F.when((F.col("difference") == "MISSING") & out, "OUTSIDE_LIFECYCLE")
        .when((F.col("difference") == "DIFFERENT") & out & label_only, "ELIGIBILITY_LABEL_ONLY")
        .when(F.col("difference") == "EXTRA", "LOCAL_ONLY")
        .otherwise("FAILURE")
        .alias("assessment"),
    )


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of exactly one side, tagged (U1, U5); set semantics via one folded shuffle."""
    cols = a.columns
    tagged = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    folded = tagged.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return folded.where(F.col("_a") != F.col("_b")).select(
        *cols, F.when(F.col("_a") == 1, "ONLY_LEFT").otherwise("ONLY_RIGHT").alias("side")
    )


# --- two models -------------------------------------------------------------
def unpaired_keys(new: DataFrame, legacy: DataFrame) -> DataFrame:
    """Event keys that only one model assessed; must be empty before comparing."""
    return symmetric_difference(new.select("event_key"), legacy.select("event_key"))


def paired_assessments(new: DataFrame, legacy: DataFrame) -> DataFrame:
    """Both models' verdicts of each event from one fold, with hits two-valued."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "event_key",
            "security_code",
            "event_type",
            F.struct(
                F.coalesce("raw_classification", F.lit("")).alias("grade"),
                F.coalesce("is_hit", F.lit(False)).alias("hit"),
                F.col("warning_trading_days").alias("days"),
            ).alias(name),
        )

    both = side(new, "n").unionByName(side(legacy, "l"), allowMissingColumns=True)
    return (
        both.groupBy("event_key", "security_code", "event_type")
        .agg(F.max("n").alias("n"), F.max("l").alias("l"))
        .select(
            "event_key",
            "security_code",
            "event_type",
            F.col("n").isNotNull().alias("in_new"),
            F.col("l").isNotNull().alias("in_legacy"),
            F.col("n.grade").alias("new_classification"),
            F.col("l.grade").alias("legacy_classification"),
            F.col("n.hit").alias("new_hit"),
            F.col("l.hit").alias("legacy_hit"),
            F.col("n.days").alias("new_warning_days"),
            F.col("l.days").alias("legacy_warning_days"),
        )
    )


def _changed(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def event_differences(pairs: DataFrame) -> DataFrame:
    """Events on which the models disagree."""
    return pairs.where(
        _changed("new_hit", "legacy_hit")
        | _changed("new_warning_days", "legacy_warning_days")
        | _changed("new_classification", "legacy_classification")
    ).withColumn("warning_days_delta", F.col("new_warning_days") - F.col("legacy_warning_days"))


def model_comparison_totals(pairs: DataFrame) -> DataFrame:
    """Gained and lost hits, warning changes and averages."""
    avg = lambda c: S.rate(F.sum(c), F.count(c))
    return pairs.agg(
        F.count("*").alias("event_count"),
        F.count_if("new_hit").alias("new_hit_count"),
        F.count_if("legacy_hit").alias("legacy_hit_count"),
        F.count_if(F.col("new_hit") & ~F.col("legacy_hit")).alias("gained_hit_count"),
        F.count_if(F.col("legacy_hit") & ~F.col("new_hit")).alias("lost_hit_count"),
        F.count_if(_changed("new_warning_days", "legacy_warning_days")).alias("warning_changed_count"),
        avg("new_warning_days").alias("new_average_warning_days"),
        avg("legacy_warning_days").alias("legacy_average_warning_days"),
    )


def migration_matrix(pairs: DataFrame) -> DataFrame:
    """Counts per old -> new grade."""
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("UNKNOWN"))
    return pairs.groupBy(
        text("legacy_classification").alias("from_grade"), text("new_classification").alias("to_grade")
    ).agg(F.count("*").alias("event_count"))


def tagged_differences(differences: DataFrame) -> DataFrame:
    """Differences with their change types and grade transition."""
    new, old = F.col("new_hit"), F.col("legacy_hit")
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("UNKNOWN"))
    tags = F.array_compact(
        F.array(
            F.when(new & ~old, "gained_hit"),
            F.when(old & ~new, "lost_hit"),
            F.when(new != old, "hit_changed"),
            F.when(_changed("new_warning_days", "legacy_warning_days"), "warning_changed"),
            F.when(text("new_classification") != text("legacy_classification"), "classification_changed"),
        )
    )
    return differences.withColumn("change_types", tags).withColumn(
        "classification_transition", F.concat(text("legacy_classification"), F.lit(">"), text("new_classification"))
    )


def filter_differences(
    tagged: DataFrame, *, security: str = "", event_type: str = "", change_type: str = "", transition: str = ""
) -> DataFrame:
    """Display filters of the difference explorer."""
    out = tagged
    if security.strip():
        term = security.strip().upper()
        out = out.where(F.upper("security_code").contains(term) | F.upper("event_key").contains(term))
    if event_type:
        out = out.where(F.col("event_type") == event_type)
    if change_type:
        out = out.where(F.array_contains("change_types", change_type))
    if transition:
        out = out.where(F.col("classification_transition") == transition)
    return out


def difference_summary(tagged: DataFrame) -> DataFrame:
    has = lambda t: F.count_if(F.array_contains("change_types", t))
    return tagged.agg(
        F.count("*").alias("total_difference_count"),
        has("gained_hit").alias("gained_hit_count"),
        has("lost_hit").alias("lost_hit_count"),
        has("warning_changed").alias("warning_changed_count"),
        has("classification_changed").alias("classification_changed_count"),
    )
