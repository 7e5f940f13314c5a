"""Broker rankings, drill-down and overview."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.sources.staging import new_path, store


def competition_rank(df: DataFrame, metric: str, out: str, partition: Sequence[str] = ("event_type_view",)) -> DataFrame:
    """1,1,3 ranks, best first, nulls unranked (R1). One row per broker and view, so the window is broker-sized."""
    w = Window.partitionBy(*partition).orderBy(F.col(metric).desc_nulls_last())
    return df.withColumn(out, F.when(F.col(metric).isNotNull(), F.rank().over(w)))


def broker_rankings(
    summary: DataFrame,
    expected: int = R.EXPECTED_PEER_BROKERS,
    metrics: Sequence[str] = R.RANKING_METRICS,
    composite: Sequence[str] = R.COMPOSITE_METRICS,
) -> DataFrame:
    """Metric ranks and the composite score, only for a complete peer sample (R2)."""
    view = Window.partitionBy("event_type_view")
    out = summary
    for metric in metrics:
        out = competition_rank(out, metric, f"{metric}_rank")
    filled = F.count(F.when(F.greatest(*[F.col(m).isNull().cast("int") for m in composite]) == 0, 1)).over(view)
    out = out.withColumn("observed_broker_count", F.count("*").over(view)).withColumn(
        "composite_available", (F.col("observed_broker_count") == expected) & (filled == expected)
    )
    points = sum(
        ((F.lit(expected) - F.col(f"{m}_rank")) / F.lit(float(max(expected - 1, 1))) * 100 for m in composite),
        F.lit(0.0),
    )
    out = out.withColumn(
        "composite_score", F.when(F.col("composite_available"), F.round(points / len(composite), 6))
    ).withColumn(
        "sample_status", F.when(F.col("observed_broker_count") == expected, "COMPLETE").otherwise("INCOMPLETE_SAMPLE")
    )
    return competition_rank(out, "composite_score", "composite_rank")


def dense_frequency_rank(df: DataFrame, frequency: str, out: str, partition: Sequence[str] = ()) -> DataFrame:
    """Dense rank of group frequencies; an empty group has none.

    ``df`` is already grouped, so the ranked rows are as many as there are groups. Without
    ``partition`` the distinct frequencies are ranked over range partitions, so that neither
    many groups nor many frequencies meet in one task.
    """
    if partition:
        w = Window.partitionBy(*partition).orderBy(F.desc(frequency))
        return df.withColumn(out, F.when(F.col(frequency) > 0, F.dense_rank().over(w)))
    ranks = range_positions(df.where(F.col(frequency) > 0).select(frequency).distinct(), [F.desc(frequency)], out)
    return df.join(ranks.withColumn(out, F.col(out).cast("int")), frequency, "left").select(*df.columns, out)


def range_positions(rows: DataFrame, order: Sequence, out: str) -> DataFrame:
    """``rows`` with their 1-based position in a total order, without a window over all of them.

    Rows are dealt into ranges of the order and stored; a position is the place in the range
    plus the sizes of the ranges before it, of which there is one row per range.
    """
    return _placed(stored_ranges(rows, order), out)


def stored_ranges(rows: DataFrame, order: Sequence) -> DataFrame:
    """Rows in the order's ranges, with ``_range`` and the row's place in it (``_place``, from 0)."""
    keys = list(order)
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return store(laid.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "ranges")


def range_index(ranged: DataFrame) -> DataFrame:
    """Per range: its rows and the rows before it. One row per range, so one window over all is small."""
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def _placed(ranged: DataFrame, out: str) -> DataFrame:
    index = range_index(ranged).select("_range", "before")
    return ranged.join(index, "_range").withColumn(out, F.col("_place") + F.col("before") + 1).drop("_range", "_place", "before")


def with_hit_status(assessments: DataFrame) -> DataFrame:
    return assessments.withColumn("hit_status", S.hit_status("is_hit", "identification_status", "final_bucket"))


def drilldown_rows(
    assessments: DataFrame, broker_id: str, view: str = R.ALL_EVENTS, security: str = "", hit: str = "ALL"
) -> DataFrame:
    """Rows behind one broker's metric after the page filters."""
    rows = with_hit_status(assessments.where(F.col("broker_id") == broker_id))
    if view != R.ALL_EVENTS:
        rows = rows.where(F.col("event_type") == view)
    if security.strip():
        rows = rows.where(F.upper("security_code").contains(security.strip().upper()))
    if hit != "ALL":
        rows = rows.where(F.col("hit_status") == hit)
    return rows


def drilldown_securities(rows: DataFrame) -> DataFrame:
    """Per-security counts, hit rate and warning days."""
    days = F.col("warning_trading_days")
    return (
        rows.groupBy("security_code", "market_code")
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(F.col("hit_status") == "HIT").alias("hit_event_count"),
            F.count_if(F.col("hit_status") == "UNKNOWN").alias("unknown_event_count"),
            F.count(days).alias("defined_warning_count"),
            F.max(days).alias("warning_days_earliest"),
            F.median(days).alias("warning_days_median"),
            F.max("risk_date").alias("latest_risk_date"),
        )
        .withColumn("event_hit_rate", S.rate("hit_event_count", "event_count"))
    )


def page(df: DataFrame, order: Sequence, number: int, size: int) -> DataFrame:
    """One page (1-based) of a sorted result; executors only keep their own top rows."""
    if number < 1 or not 1 <= size <= 10_000:
        raise ValueError("page is out of range")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


@dataclass(frozen=True)
class PagedResult:
    """A sorted result whose pages are read from the ranges they lie in.

    The result is stored once, in ranges of its order, one folder each; ``ranges`` says how
    many rows each holds and how many come before. A page opens just the folders that it
    touches, however deep it lies.
    """

    path: str
    columns: tuple[str, ...]
    schema: StructType
    #: (range, rows before it, rows) in order; one entry per range
    ranges: tuple[tuple[int, int, int], ...]

    @property
    def total(self) -> int:
        return sum(n for _, _, n in self.ranges)

    def page(self, spark: SparkSession, number: int, size: int) -> DataFrame:
        """The rows of a page (1-based), in any order; ``position`` is their place in the result."""
        if number < 1 or not 1 <= size <= 10_000:
            raise ValueError("page is out of range")
        first, last = (number - 1) * size, number * size
        touched = [r for r, before, n in self.ranges if before < last and before + n > first]
        rows = spark.read.schema(self.schema).parquet(self.path).where(F.col("_range").isin(touched or [-1]))
        bases = F.coalesce(*[F.when(F.col("_range") == r, b) for r, b, _ in self.ranges if r in touched], F.lit(0))
        placed = rows.withColumn("position", (F.col("_place") + bases + 1).cast("long"))
        return placed.where(F.col("position").between(first + 1, last)).select(*self.columns, "position")


def paged(df: DataFrame, order: Sequence) -> PagedResult:
    """Store a result for paging; ``order`` must be total, or ties take any order."""
    spark = df.sparkSession
    ranged = stored_ranges(df, order)
    path = new_path(spark, "pages")
    ranged.write.partitionBy("_range").parquet(path)
    index = range_index(ranged).orderBy("_range").collect()  # a row per range
    return PagedResult(path, tuple(df.columns), ranged.schema, tuple((r["_range"], r["before"], r["rows"]) for r in index))


def example_keys(issues: DataFrame, key: str = "issue_key", limit: int = R.EXAMPLE_LIMIT) -> DataFrame:
    """Total issue count next to the first keys in key order.

    The count is one aggregate row; the examples are a distributed top-n.
    """
    total = issues.agg(F.count("*").alias("affected_rows")).withColumn("one", F.lit(1))
    first = issues.select(key).orderBy(key).limit(limit).withColumn("one", F.lit(1))
    return first.join(F.broadcast(total), "one").select(key, "affected_rows")


def peer_overview(summary: DataFrame, expected: int = R.EXPECTED_PEER_BROKERS) -> DataFrame:
    """Totals over the combined view of one batch."""
    return summary.where(F.col("event_type_view") == R.ALL_EVENTS).agg(
        F.sum("defined_sample_count").alias("defined_warning_count"),
        F.sum("identified_days_unknown_count").alias("unknown_warning_count"),
        F.sum("hit_event_count").alias("hit_event_count"),
        F.count("*").alias("broker_count"),
        (F.count("*") == expected).alias("complete_sample"),
    )


def ranked_overview(summary: DataFrame, returns: DataFrame, expected: int = R.EXPECTED_PEER_BROKERS) -> DataFrame:
    """Per broker and grade of one batch: the broker's ranks in the combined view, the grade's
    returns, and the batch's totals (G27).

    ``returns`` is the period summary per broker and raw grade; a broker without one keeps a
    row. Summary and returns are broker-sized, so the joins are as well.
    """
    ranked = broker_rankings(summary, expected).where(F.col("event_type_view") == R.ALL_EVENTS)
    ranks = ranked.select(
        "broker_id", "event_hit_rate", "event_hit_rate_rank", "warning_rate_rank", "composite_score", "composite_rank", "sample_status"
    )
    totals = peer_overview(summary, expected).select(
        F.col("hit_event_count").alias("total_hit_events"),
        F.col("defined_warning_count").alias("total_defined_warnings"),
        F.col("unknown_warning_count").alias("total_unknown_warnings"),
        F.lit(1).alias("one"),
    )
    met = ranks.join(returns, "broker_id", "left").withColumn("one", F.lit(1))
    return met.join(totals, "one").drop("one")
