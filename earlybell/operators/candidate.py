"""Validation of a stored import against its catalogue and its sources (Q24).

Two large multisets are compared by digests first: order-free sums per partition (dataset,
market, year, month), then per bucket of the partitions that differ, then row by row inside
the buckets that differ. Partitions that agree are read once, for their digest, and never
shuffled row by row; the list of unequal ones prunes the later reads.

Coverage, duplicates and value relations come from one fold of all daily facts and the
expected security-days on their key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earlybell.functions import scalars as S
from earlybell.operators import cache_import as I
from earlybell.sources.staging import store

PARTS = ("dataset_id", "market_code", "year", "month")
DAILY = (I.PRICES, I.LIMITS, I.ST, I.SUSPENSION)


# --- multiset differences by digests ------------------------------------------
def _digest(rows: DataFrame, by: Sequence[str], side: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias(f"{side}_n"),
        F.sum(F.col("_word").cast("decimal(38,0)")).alias(f"{side}_sum"),
        F.bit_xor("_word").alias(f"{side}_xor"),
    )


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The groups whose digests differ, stored: a row for each, whatever the tables' size."""
    joined = _digest(left, by, "l").join(_digest(right, by, "r"), list(by), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in ("n", "sum", "xor")])
    return store(joined.where(~same).select(*by), name)


def digest_difference(
    left: DataFrame, right: DataFrame, columns: Sequence[str], parts: Sequence[str] = PARTS, buckets: int = 64
) -> DataFrame:
    """Per unequal partition: how many rows occur on one side only (``missing``: in ``left`` more
    often, ``extra``: in ``right`` more often), duplicates counted.

    ``parts`` must not be null; ``columns`` are compared null-safely.
    """
    by = list(parts)

    def side(rows: DataFrame) -> DataFrame:
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
        return rows.select(*by, F.xxhash64(text).alias("_word"), F.sha2(text, 256).alias("_row"))

    left, right = side(left), side(right)
    apart = _unequal(left.drop("_row"), right.drop("_row"), by, "unequal_partitions")
    inside = lambda rows: rows.join(apart, by, "left_semi").withColumn("_bucket", F.pmod("_word", F.lit(buckets)))
    left, right = inside(left), inside(right)
    keys = [*by, "_bucket"]
    cells = _unequal(left.drop("_row"), right.drop("_row"), keys, "unequal_buckets")
    pick = lambda rows, d: rows.join(cells, keys, "left_semi").select(*by, "_row", F.lit(d).alias("d"))
    folded = pick(left, 1).unionByName(pick(right, -1)).groupBy(*by, "_row").agg(F.sum("d").alias("d")).where("d <> 0")
    return folded.groupBy(*by).agg(
        F.sum(F.greatest("d", F.lit(0))).alias("missing"), F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("extra")
    )


# --- findings ---------------------------------------------------------------------
@dataclass(frozen=True)
class Window:
    """The observed days; ST facts also cover the session before them."""

    baseline: date
    start: date
    end: date


def latest_lifecycle(facts: DataFrame) -> DataFrame:
    """Listing and termination of each security by its latest master record."""
    latest = F.max_by(F.struct("listing_date", "termination_date"), "effective_start")
    rows = facts.where(F.col("dataset_id") == I.MASTER).groupBy("market_code", "security_code").agg(latest.alias("x"))
    return rows.select("market_code", "security_code", "x.*")


def expected_days(facts: DataFrame, window: Window) -> DataFrame:
    """Trading days of the window in each security's lifecycle."""
    days = facts.where((F.col("dataset_id") == I.CALENDAR) & F.col("is_trading_day"))
    days = days.where(F.col("business_date").between(window.baseline, window.end)).select("market_code", "business_date").distinct()
    met = latest_lifecycle(facts).join(days, "market_code")  # on the market; a security meets the window's days
    inside = S.in_lifecycle("business_date", "listing_date", "termination_date")
    return met.where(inside).select("market_code", "security_code", "business_date")


def _fold(facts: DataFrame, window: Window) -> DataFrame:
    """One row per security-day: how often each dataset has it, and the values of each."""
    key = ["market_code", "security_code", "business_date"]
    values = (*I.NUMBERS, "is_suspended")
    daily = facts.where(F.col("dataset_id").isin(*DAILY)).select(*key, "dataset_id", *values)
    expected = expected_days(facts, window).select(*key, F.lit("").alias("dataset_id"))
    stacked = daily.unionByName(expected, allowMissingColumns=True)
    is_ = lambda d: F.col("dataset_id") == d
    return stacked.groupBy(*key).agg(
        F.max(is_("")).alias("expected"),
        *[F.count_if(is_(d)).alias(d) for d in DAILY],
        F.max(F.when(is_(I.PRICES), F.struct(*I.NUMBERS[:6]))).alias("p"),
        F.max(F.when(is_(I.LIMITS), F.struct(*I.NUMBERS[6:]))).alias("l"),
        F.max(is_(I.SUSPENSION) & ~F.col("is_suspended")).alias("live"),
    )


def _any(conditions: Sequence[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(False))


def coverage_findings(facts: DataFrame, window: Window) -> DataFrame:
    """Duplicates, missing and unexpected keys of the daily datasets, and broken value relations."""
    day, expected = F.col("business_date"), F.coalesce("expected", F.lit(False))
    counts = []
    for d in DAILY:
        begin = window.baseline if d == I.ST else window.start
        allowed = window.baseline if d in (I.ST, I.SUSPENSION) else window.start
        there = F.col(d) > 0
        counts += [
            F.coalesce(F.sum(F.greatest(F.col(d) - 1, F.lit(0))), F.lit(0)).alias(f"{d}_duplicate_keys"),
            F.count_if(expected & ~there & day.between(begin, window.end)).alias(f"{d}_missing_keys"),
            F.count_if(there & ~(expected & day.between(allowed, window.end))).alias(f"{d}_unexpected_keys"),
        ]
    both = (F.col(I.PRICES) > 0) & (F.col(I.LIMITS) > 0)
    holes = _any([F.col(f"p.{c}").isNull() for c in I.NUMBERS[:6]] + [F.col(f"l.{c}").isNull() for c in I.NUMBERS[6:]])
    p = lambda c: F.col(f"p.{c}")
    signs = [p("close_price") <= 0, p("volume") < 0, p("amount") < 0]
    order = [p("high_price") < p("low_price"), p("close_price") > p("high_price"), p("close_price") < p("low_price")]
    # each alone: a null in one of them must not hide another
    broken = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in (*signs, *order, F.col("l.limit_down_price") > F.col("l.limit_up_price"))])
    counts += [
        F.count_if(both & F.coalesce("live", F.lit(False)) & holes).alias("live_price_or_limit_missing"),
        F.count_if(both & broken).alias("invalid_price_relationship"),
    ]
    return _long(_fold(facts, window).agg(*counts))


def _long(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "finding", "issue_count")


def _source(field: str) -> Column:
    return F.get_json_object("source_row", f"$.{field}")


def row_findings(facts: DataFrame) -> DataFrame:
    """Per row: the stored hash against its values, and the typed values against the source row's text."""
    of = lambda d: F.col("dataset_id") == d
    number = lambda c: S.blank_to_null(_source(c)).try_cast("decimal(24,6)")
    day = lambda c: F.nullif(_source(c), F.lit("")).try_cast("date")
    differs = lambda a, b: ~F.col(a).eqNullSafe(b)
    prices = [differs(c, number("turnover" if c == "amount" else c)) for c in I.NUMBERS[:6]]
    limits = [differs(c, number(c)) for c in I.NUMBERS[6:]]
    master = [
        differs("board_code", _source("board_code")),
        differs("listing_date", day("listed_date")),
        differs("termination_date", day("delisted_date")),
        differs("effective_start", day("status_date")),
    ]
    states = F.coalesce(*[F.when(_source("risk_status_value") == text, flag) for text, flag in I.ST_VALUES.items()])
    broken_hash = F.col("payload_hash") != I.payload_hash()
    counts = [F.count_if(of(d) & broken_hash).alias(f"{d}_payload_hash_mismatch") for d in I.DATASETS]
    counts += [
        F.count_if(of(I.ST) & F.col("is_st").isNull()).alias("st_unknown"),
        F.count_if(of(I.SUSPENSION) & F.col("is_suspended").isNull()).alias("suspension_unknown"),
        F.count_if(of(I.PRICES) & _any(prices)).alias("normalized_price_differences"),
        F.count_if(of(I.LIMITS) & _any(limits)).alias("normalized_limit_differences"),
        F.count_if(of(I.ST) & differs("is_st", states)).alias("normalized_st_differences"),
        F.count_if(of(I.MASTER) & _any(master)).alias("normalized_master_differences"),
    ]
    return _long(facts.agg(*counts))


def difference_findings(left: DataFrame, right: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``<dataset>_<name>_missing`` and ``_extra`` of all datasets, zero where they agree."""
    found = digest_difference(left, right, columns).groupBy("dataset_id").agg(F.sum("missing").alias("missing"), F.sum("extra").alias("extra"))
    sides = found.unpivot(["dataset_id"], ["missing", "extra"], "side", "n")
    named = sides.select(F.concat_ws("_", "dataset_id", F.lit(name), "side").alias("finding"), F.col("n").alias("issue_count"))
    every = [(f"{d}_{name}_{s}", 0) for d in I.DATASETS for s in ("missing", "extra")]
    zeros = left.sparkSession.createDataFrame(every, "finding string, issue_count bigint")
    return named.unionByName(zeros).groupBy("finding").agg(F.sum("issue_count").alias("issue_count"))


def validate_candidate(facts: DataFrame, catalogue: DataFrame, sources: DataFrame, window: Window) -> DataFrame:
    """All findings of a stored import as (finding, issue_count).

    ``facts`` as ``read_import`` gives them; ``catalogue`` has their partition columns, business
    key and payload hash as they were recorded; ``sources`` are the records that were to be
    kept, with their source row. Catalogue: ``missing`` rows are facts that it lacks. Round
    trip: ``missing`` rows are source rows that no fact holds.
    """
    dated = sources.withColumn("year", F.year("business_date")).withColumn("month", F.month("business_date"))
    return (
        coverage_findings(facts, window)
        .unionByName(row_findings(facts))
        .unionByName(difference_findings(facts, catalogue, ("business_key", "payload_hash"), "catalogue"))
        .unionByName(difference_findings(dated, facts, ("source_row",), "roundtrip"))
    )
