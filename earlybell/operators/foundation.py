"""Reconciliation checks of the fact store and derivation of its six datasets.

Checks return one row per issue: rule_id, dataset_id, market_code, issue_key.
:func:`check_report` turns them into counted outcomes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.compare import symmetric_difference
from earlybell.operators.panel import DAY, expected_days, stack_by_day
from earlybell.sources.staging import store


def issue_key(*cols: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in (cols or (*R.KEY, DAY))])


def issues(df: DataFrame, rule_id: str, dataset_id: str | None = None, key: Column | None = None) -> DataFrame:
    market = F.col("market_code") if "market_code" in df.columns else F.lit(None).cast("string")
    return df.select(
        F.lit(rule_id).alias("rule_id"),
        F.lit(dataset_id).cast("string").alias("dataset_id"),
        market.alias("market_code"),
        (key if key is not None else issue_key()).alias("issue_key"),
    )


def check_report(found: DataFrame, expected_checks: Sequence[tuple[str, str]]) -> DataFrame:
    """PASS / FAIL per planned (rule, dataset) with the affected row count."""
    grid = R.literal_rows(found.sparkSession, ("rule_id", "dataset_id"), expected_checks)
    counted = found.groupBy("rule_id", F.coalesce("dataset_id", F.lit("")).alias("dataset_id")).agg(
        F.count("*").alias("affected_rows")
    )
    return F.broadcast(grid).join(counted, ["rule_id", "dataset_id"], "left").select(
        "rule_id",
        "dataset_id",
        F.coalesce("affected_rows", F.lit(0)).alias("affected_rows"),
        F.when(F.coalesce("affected_rows", F.lit(0)) == 0, "PASS").otherwise("FAIL").alias("outcome"),
    )


# --- calendar and master ----------------------------------------------------
def calendar_gaps(calendar: DataFrame, markets: Sequence[str], start: date, end: date) -> DataFrame:
    """Natural days without a calendar row, and rows without a trading flag (Q15)."""
    grid = R.literal_rows(calendar.sparkSession, ("market_code", "lo", "hi"), [(m, start, end) for m in markets])
    expected = grid.select("market_code", F.explode(F.sequence("lo", "hi")).alias("calendar_date"))
    inside = calendar.where(F.col("calendar_date").between(F.lit(start), F.lit(end)) & F.col("market_code").isin(*markets))
    missing = expected.join(inside.select("market_code", "calendar_date").distinct(), ["market_code", "calendar_date"], "left_anti")
    null_flag = inside.where(F.col("is_trading_day").isNull())
    key = lambda kind: F.concat_ws("|", F.lit(kind), F.col("calendar_date").cast("string"))
    return issues(missing, "MDFRQ002", "market_calendar", key("MISSING")).unionByName(
        issues(null_flag, "MDFRQ002", "market_calendar", key("DUPLICATE_OR_NULL"))
    )


def master_matches_universe(universe: DataFrame, master: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Universe members without an equal master row, and master rows outside it.

    Null-safe on every compared column.
    """
    distinct = master.select("security_code", *columns).distinct()
    a, b = universe.alias("e"), distinct.alias("a")
    same = F.col("e.security_code") == F.col("a.security_code")
    for c in columns:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))
    mismatch = a.join(b, same, "left_anti").select(F.concat_ws("|", F.lit("MISSING_OR_MISMATCH"), "security_code").alias("k"))
    extra = distinct.join(universe.select("security_code"), "security_code", "left_anti").select(
        F.concat_ws("|", F.lit("EXTRA"), "security_code").alias("k")
    )
    return issues(mismatch.unionByName(extra), "MDFRQ003", "instrument_master_history", F.col("k"))


# --- daily facts ------------------------------------------------------------
def flat_zero_bar() -> Column:
    """A price row that only marks the end of trading: no volume and one price."""
    return (
        (F.col("volume") == 0)
        & (F.col("amount") == 0)
        & (F.col("open_price") == F.col("high_price"))
        & (F.col("open_price") == F.col("low_price"))
        & (F.col("open_price") == F.col("close_price"))
    )


def _with_lifecycle(facts: DataFrame, universe: DataFrame, days: DataFrame) -> DataFrame:
    life = universe.select(*R.KEY, "listed_date", "delisted_date", F.lit(True).alias("is_member"))
    cal = days.select("market_code", DAY, F.lit(True).alias("is_open"))
    return facts.join(life, list(R.KEY), "left").join(cal, ["market_code", DAY], "left")


def terminal_bars(prices: DataFrame) -> DataFrame:
    return prices.where(flat_zero_bar()).select(*R.KEY, DAY).withColumn("is_marker", F.lit(True))


def facts_outside_lifecycle(facts: DataFrame, universe: DataFrame, days: DataFrame, dataset_id: str, prices: DataFrame | None = None) -> DataFrame:
    """Facts of unknown securities, outside the lifecycle or on closed days (Q17).

    Price and limit rows may carry a flat zero bar on the termination day itself.
    """
    joined = _with_lifecycle(facts.select(*R.KEY, DAY), universe, days)
    late = F.col(DAY) >= F.col("delisted_date")
    if prices is not None:
        joined = joined.join(terminal_bars(prices), [*R.KEY, DAY], "left")
        late = (F.col(DAY) > F.col("delisted_date")) | (
            (F.col(DAY) == F.col("delisted_date")) & F.col("is_marker").isNull()
        )
    bad = (
        F.col("is_member").isNull()
        | (F.col(DAY) < F.col("listed_date"))
        | F.coalesce(late, F.lit(False))
        | F.col("is_open").isNull()
    )
    return issues(joined.where(bad), "MDFRQ004", dataset_id)


def terminal_markers(facts: DataFrame, universe: DataFrame, dataset_id: str, prices: DataFrame) -> DataFrame:
    """Audit of the tolerated flat zero bars on termination days (Q17)."""
    ends = universe.where(F.col("delisted_date").isNotNull()).select(*R.KEY, F.col("delisted_date").alias(DAY))
    keys = [*R.KEY, DAY]
    return issues(
        facts.select(*keys).join(ends, keys, "left_semi").join(terminal_bars(prices).select(*keys), keys, "left_semi"),
        "MDFRQ019",
        dataset_id,
    )


def missing_expected(expected: DataFrame, facts: DataFrame, rule_id: str, dataset_id: str) -> DataFrame:
    """Expected security-days without a fact."""
    keys = [*R.KEY, DAY]
    return issues(expected.select(*keys).join(facts.select(*keys), keys, "left_anti"), rule_id, dataset_id)


def traded_days(expected: DataFrame, suspension: DataFrame) -> DataFrame:
    """Expected days whose suspension row says the security traded (Q18, Q22)."""
    keys = [*R.KEY, DAY]
    return expected.select(*keys).join(suspension.where(~F.col("is_suspended")).select(*keys), keys, "left_semi")


def price_limit_key_mismatch(prices: DataFrame, limits: DataFrame) -> DataFrame:
    """Security-days with only a price or only a limit, risk markets."""
    keys = [*R.KEY, DAY]
    risk = F.col("market_code").isin(*R.RISK_MARKETS)
    return issues(symmetric_difference(prices.where(risk).select(*keys), limits.where(risk).select(*keys)), "MDFRQ007")


def priced_while_suspended(prices: DataFrame, suspension: DataFrame) -> DataFrame:
    """Price rows on suspended days, risk markets (Q19)."""
    keys = [*R.KEY, DAY]
    halted = suspension.where("is_suspended").select(*keys)
    return issues(
        prices.where(F.col("market_code").isin(*R.RISK_MARKETS)).select(*keys).join(halted, keys, "left_semi"),
        "MDFRQ008",
        "daily_price_unadjusted",
    )


def invalid_prices(prices: DataFrame) -> DataFrame:
    """Null, negative or inconsistent OHLC rows (Q20)."""
    fields = ("open_price", "high_price", "low_price", "close_price", "volume", "amount")
    bad = F.lit(False)
    for c in fields:
        bad = bad | F.col(c).isNull() | (F.col(c) < 0)
    bad = bad | (F.col("high_price") < F.greatest("open_price", "low_price", "close_price"))
    bad = bad | (F.col("low_price") > F.least("open_price", "high_price", "close_price"))
    return issues(prices.where(F.col("market_code").isin(*R.RISK_MARKETS) & bad), "MDFRQ009", "daily_price_unadjusted")


def invalid_limits(limits: DataFrame) -> DataFrame:
    up, down = F.col("limit_up_price"), F.col("limit_down_price")
    bad = up.isNull() | down.isNull() | (up < 0) | (down < 0) | (up < down)
    return issues(limits.where(F.col("market_code").isin(*R.RISK_MARKETS) & bad), "MDFRQ010", "daily_price_limits")


def null_flags(facts: DataFrame, column: str, dataset_id: str) -> DataFrame:
    return issues(facts.where(F.col(column).isNull()), "MDFRQ011", dataset_id)


def payload_evidence(store: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Facts whose stored hash is not the hash of their payload, or without evidence (Q21)."""
    bad = (
        (F.col("payload_hash") != S.payload_hash(payload))
        | F.col("source_request_id").isNull()
        | (F.trim("source_request_id") == "")
        | F.col("partition_id").isNull()
    )
    return issues(
        store.where(bad), "MDFRQ016", None, issue_key("dataset_id", "business_key", "source_record_version")
    )


def complete_dates(facts: DataFrame, days: DataFrame, datasets: Sequence[str], markets: Sequence[str]) -> DataFrame:
    """Does each (dataset, market) cover exactly the trading dates? (Q23)

    ``facts`` needs dataset_id, market_code, business_date.
    """
    cal = days.where(F.col("market_code").isin(*markets)).select("market_code", F.col(DAY).alias("business_date"), F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset_id"))
    seen = facts.select("dataset_id", "market_code", "business_date").distinct()
    folded = (
        cal.select("dataset_id", "market_code", "business_date", F.lit(1).alias("e"), F.lit(0).alias("a"))
        .unionByName(seen.select("*", F.lit(0).alias("e"), F.lit(1).alias("a")))
        .groupBy("dataset_id", "market_code", "business_date")
        .agg(F.max("e").alias("e"), F.max("a").alias("a"))
    )
    return folded.groupBy("dataset_id", "market_code").agg(
        F.sum("e").alias("expected_dates"),
        F.sum("a").alias("actual_dates"),
        F.count_if(F.col("e") != F.col("a")).alias("mismatch_count"),
    ).withColumn("complete", (F.col("mismatch_count") == 0) & (F.col("expected_dates") > 0))


def candidate_report(prices: DataFrame, limits: DataFrame, suspension: DataFrame, expected: DataFrame) -> DataFrame:
    """Stored-candidate validation counts from one panel (Q24)."""
    merged = stack_by_day(
        {
            "e": expected.select(*R.KEY, DAY, F.lit(1).alias("one")),
            "p": prices.select(*R.KEY, DAY, "high_price", "low_price", "close_price", "volume", "amount"),
            "l": limits.select(*R.KEY, DAY, "limit_up_price", "limit_down_price"),
            "s": suspension.select(*R.KEY, DAY, "is_suspended"),
        }
    )
    p, lim = F.col("p").isNotNull(), F.col("l").isNotNull()
    live = p & lim & F.coalesce(~F.col("s.is_suspended"), F.lit(False))
    holes = F.lit(False)
    for c in ("p.high_price", "p.low_price", "p.close_price", "p.volume", "p.amount", "l.limit_up_price", "l.limit_down_price"):
        holes = holes | F.col(c).isNull()
    broken = (
        (F.col("p.close_price") <= 0)
        | (F.col("p.volume") < 0)
        | (F.col("p.amount") < 0)
        | (F.col("p.high_price") < F.col("p.low_price"))
        | (F.col("p.close_price") > F.col("p.high_price"))
        | (F.col("p.close_price") < F.col("p.low_price"))
        | (F.col("l.limit_down_price") > F.col("l.limit_up_price"))
    )
    e = F.col("e").isNotNull()
    counts = merged.agg(
        F.count_if(e & F.col("s").isNull()).alias("suspension_missing_keys"),
        F.count_if(~e & F.col("s").isNotNull()).alias("suspension_unexpected_keys"),
        F.count_if(e & ~p).alias("price_missing_keys"),
        F.count_if(~e & p).alias("price_unexpected_keys"),
        F.count_if(live & holes).alias("live_price_or_limit_missing"),
        F.count_if(p & lim & F.coalesce(broken, F.lit(False))).alias("invalid_price_relationship"),
        F.count_if(F.col("s").isNotNull() & F.col("s.is_suspended").isNull()).alias("suspension_unknown"),
    )
    return counts.unpivot([], counts.columns, "finding", "issue_count")


def roundtrip_difference(source: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose hash occurs more often on one side (Q24): multiset difference by row hash."""
    h = S.payload_hash(columns).alias("row_hash")
    folded = (
        source.select(h, F.lit(1).alias("d"))
        .unionByName(stored.select(h, F.lit(-1).alias("d")))
        .groupBy("row_hash")
        .agg(F.sum("d").alias("d"))
    )
    return folded.agg(
        F.coalesce(F.sum(F.when(F.col("d") > 0, F.col("d"))), F.lit(0)).alias("roundtrip_missing"),
        F.coalesce(F.sum(F.when(F.col("d") < 0, -F.col("d"))), F.lit(0)).alias("roundtrip_extra"),
    )


def increment_findings(
    universe: DataFrame, days: DataFrame, prices: DataFrame, limits: DataFrame, st: DataFrame, suspension: DataFrame
) -> DataFrame:
    """Increment batch validation per active stock-day (Q25)."""
    merged = stack_by_day(
        {
            "e": expected_days(universe, days).select(*R.KEY, DAY, "ordinal"),
            "p": prices.select(*R.KEY, DAY, "open_price", "high_price", "low_price", "close_price"),
            "l": limits.select(*R.KEY, DAY, F.lit(1).alias("one")),
            "st": st.select(*R.KEY, DAY, F.lit(1).alias("one")),
            "s": suspension.select(*R.KEY, DAY, "is_suspended"),
        }
    )
    e = F.col("e").isNotNull()
    traded = e & F.coalesce(~F.col("s.is_suspended"), F.lit(False))
    positive = F.lit(True)
    for c in ("open", "high", "low", "close"):
        positive = positive & F.coalesce(F.col(f"p.{c}_price") > 0, F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(e & F.col("st").isNull(), "ST_MISSING"),
            F.when(e & F.col("s").isNull(), "SUSPENSION_MISSING"),
            F.when(traded & F.col("p").isNull(), "PRICE_MISSING"),
            F.when(traded & F.col("l").isNull(), "LIMIT_MISSING"),
            F.when(traded & F.col("p").isNotNull() & ~positive, "PRICE_INVALID"),
            F.when(~e & F.coalesce(F.col("p").isNotNull() | F.col("st").isNotNull() | F.col("s").isNotNull() | F.col("l").isNotNull(), F.lit(False)), "OUT_OF_SCOPE_FACT"),
        )
    )
    return merged.select(*R.KEY, DAY, F.explode(found).alias("finding"))


def adjusted_coverage(prices: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Traded prices without one finite positive adjusted close (Q28)."""
    keys = [*R.KEY, DAY]
    folded = adjusted.groupBy(*keys).agg(F.count("*").alias("n"), F.max(F.col("close_price").cast("double")).alias("adj"))
    joined = prices.where(F.col("close_price") > 0).select(*keys).join(folded, keys, "left")
    adj = F.col("adj")
    return joined.agg(
        F.count("*").alias("expected_price_rows"),
        F.count_if(adj.isNull() | F.isnan(adj) | (F.abs(adj) == float("inf")) | (adj <= 0)).alias("missing_post_close_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def raw_to_fact(raw: DataFrame, facts: DataFrame, life: DataFrame, fields: Sequence[str], suspension: DataFrame) -> DataFrame:
    """Raw rows against stored facts on lifecycle-valid days, null-safe at six decimals (Q29)."""
    masters = life.select(*R.KEY, "listed_date", "delisted_date", F.lit(True).alias("known"))
    as_dec = lambda p, c: F.col(f"{p}.{c}").cast("decimal(24,6)")
    # raw rows fold per security-day first, so a security with very many rows cannot skew the join
    folded = raw.groupBy(*R.KEY, DAY).agg(F.count("*").alias("n"), F.max(F.struct(*fields)).alias("v"))
    per_day = folded.join(masters, list(R.KEY), "left").select(
        *R.KEY,
        DAY,
        "n",
        (F.coalesce(F.col("known"), F.lit(False)) & S.in_lifecycle(DAY, "listed_date", "delisted_date")).alias("valid"),
        F.col("known").isNull().alias("unknown"),
        "v",
    )
    merged = stack_by_day(
        {
            "r": per_day,
            "f": facts.select(*R.KEY, DAY, *fields),
            "s": suspension.select(*R.KEY, DAY, "is_suspended"),
        }
    )
    differs = F.lit(False)
    for c in fields:
        differs = differs | ~F.col(f"r.v.{c}").cast("decimal(24,6)").eqNullSafe(as_dec("f", c))
    valid = F.coalesce(F.col("r.valid"), F.lit(False))
    live = F.col("f").isNotNull() & F.coalesce(~F.col("s.is_suspended"), F.lit(False))
    return merged.agg(
        F.coalesce(F.sum(F.when(F.col("r.unknown"), F.col("r.n"))), F.lit(0)).alias("unknown_master"),
        F.coalesce(F.sum(F.when(valid, F.col("r.n") - 1)), F.lit(0)).alias("duplicate_keys"),
        F.count_if(valid & (F.col("f").isNull() | differs)).alias("value_or_key_differences"),
        F.count_if(live & ~valid).alias("live_fact_without_raw_price"),
    )


def result_contract(results: Mapping[str, tuple[DataFrame, Sequence[str]]], manifest: DataFrame) -> DataFrame:
    """Row counts and key uniqueness of result tables against their manifest (Q26).

    ``manifest`` needs table_name and expected_rows.
    """
    counted = None
    for name, (df, keys) in results.items():
        row = (
            df.groupBy(*keys)
            .agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("key_count"))
            .select(F.lit(name).alias("table_name"), "row_count", "key_count")
        )
        counted = row if counted is None else counted.unionByName(row)
    return manifest.join(counted, "table_name", "left").select(
        "table_name",
        "expected_rows",
        "row_count",
        "key_count",
        ((F.col("expected_rows") == F.col("row_count")) & (F.col("row_count") == F.col("key_count"))).alias("passed"),
    )


# --- derivation -------------------------------------------------------------
def six_datasets(
    calendar_days: DataFrame,
    instruments: DataFrame,
    prices: DataFrame,
    st: DataFrame,
    suspension: DataFrame,
    markets: Sequence[str],
    start: date,
    end: date,
) -> dict[str, DataFrame]:
    """Source bundle to six fact datasets.

    The calendar covers every natural day; status facts are kept inside the
    lifecycle only; prices follow known instruments.
    """
    spark = instruments.sparkSession
    grid = R.literal_rows(spark, ("market_code", "lo", "hi"), [(m, start, end) for m in markets])
    flagged = calendar_days.select(F.col(DAY).alias("business_date")).distinct().withColumn("open", F.lit(True))
    calendar = (
        grid.select("market_code", F.explode(F.sequence("lo", "hi")).alias("business_date"))
        .join(flagged, "business_date", "left")
        .select("market_code", "business_date", F.coalesce("open", F.lit(False)).alias("is_trading_day"))
    )
    known = instruments.where(F.col("market_code").isin(*markets))
    master = known.select(
        *R.KEY,
        F.coalesce("board_code", F.lit("UNKNOWN")).alias("board_code"),
        F.col("listed_date").alias("listing_date"),
        F.col("delisted_date").alias("termination_date"),
        F.greatest(F.col("listed_date"), F.lit(start)).alias("effective_start"),
        F.date_sub("delisted_date", 1).alias("effective_end"),
    )
    life = known.select(*R.KEY, "listed_date", "delisted_date")

    def alive(df: DataFrame) -> DataFrame:
        return df.join(life, list(R.KEY)).where(S.in_lifecycle(DAY, "listed_date", "delisted_date")).drop("listed_date", "delisted_date")

    of_known = prices.join(life.select(*R.KEY), list(R.KEY), "left_semi")
    return {
        "market_calendar": calendar,
        "instrument_master_history": master,
        "daily_price_unadjusted": of_known.select(*R.KEY, F.col(DAY).alias("business_date"), "close_price"),
        "daily_price_limits": of_known.select(*R.KEY, F.col(DAY).alias("business_date"), "limit_up_price", "limit_down_price"),
        "daily_st_status": alive(st).withColumnRenamed(DAY, "business_date"),
        "daily_suspension_status": alive(suspension).withColumnRenamed(DAY, "business_date"),
    }


def missing_key_parts(facts: DataFrame, dataset_id: str) -> DataFrame:
    """Rows of a dataset whose key lacks a part, counted by the first one missing.

    Their business key is null; an append must refuse while there are any.
    """
    parts = S.key_parts(dataset_id)
    lacking = F.coalesce(*[F.when(S.blank_to_null(p).isNull(), F.lit(p)) for p in parts])
    found = facts.select(lacking.alias("field")).where("field IS NOT NULL").groupBy("field").agg(F.count("*").alias("affected_rows"))
    return found.select(F.lit("REQUIRED_FIELD_MISSING").alias("code"), F.lit(dataset_id).alias("dataset_id"), "field", "affected_rows")


def outside_lifecycle_counts(facts: DataFrame, life: DataFrame) -> DataFrame:
    """Kept, dropped and unknown rows of a lifecycle-filtered import."""
    known = life.select(*R.KEY, "listed_date", "delisted_date", F.lit(True).alias("known"))
    inside = S.in_lifecycle("business_date", "listed_date", "delisted_date")
    folded = facts.groupBy("dataset_id", *R.KEY, "business_date").agg(F.count("*").alias("n"))
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return folded.join(known, list(R.KEY), "left").groupBy("dataset_id").agg(
        rows(F.col("known") & inside).alias("kept_rows"),
        rows(F.col("known") & ~inside).alias("outside_lifecycle_rows"),
        rows(F.col("known").isNull()).alias("unknown_security_rows"),
    )


# --- universe ---------------------------------------------------------------
def discover_universe(instruments: DataFrame, start: date, end: date) -> DataFrame:
    """Instruments whose lifecycle overlaps the range."""
    return instruments.where(
        (F.col("listed_date") <= F.lit(end)) & (F.col("delisted_date").isNull() | (F.col("delisted_date") > F.lit(start)))
    )


def shard_universe(universe: DataFrame, size: int) -> DataFrame:
    """Fixed-size shards in code order per market.

    Rows are dealt into ranges of market and code whose bounds come from the data; the
    position in a market is the position within a range plus the sizes of the market's
    earlier ranges, so no task orders more than a range. The ranges are stored, as both
    the sizes and the positions read them.
    """
    # longer codes sort after shorter ones, as numbers do
    ranged = universe.repartitionByRange("market_code", F.length("security_code"), "security_code")
    rows = store(ranged.withColumn("_b", F.spark_partition_id()), "universe_ranges")
    sizes = rows.groupBy("market_code", "_b").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("market_code").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy("market_code", "_b").orderBy(F.length("security_code"), "security_code")
    position = F.row_number().over(inside) + F.col("_offset")
    return (
        rows.join(offsets, ["market_code", "_b"])
        .withColumn("_pos", position)
        .withColumn("shard_ordinal", F.ceil(F.col("_pos") / F.lit(size)).cast("int"))
        .drop("_b", "_offset", "_pos")
    )


def shard_summary(sharded: DataFrame) -> DataFrame:
    return sharded.groupBy("market_code", "shard_ordinal").agg(
        F.count("*").alias("security_count"),
        F.min("security_code").alias("first_code"),
        F.max("security_code").alias("last_code"),
    )

