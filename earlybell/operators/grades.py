"""Statistics per grade: pressure and event tables, returns, snapshots, market data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.assess import active_grades
from earlybell.operators.panel import DAY, carry, before, expected_days

YI = 100_000_000  # fixed value: currency unit of the market tables


def _grade_grid(spark, grades: Sequence[str], name: str = "classification") -> DataFrame:
    return F.broadcast(R.literal_rows(spark, (name, "grade_order"), [(g, i) for i, g in enumerate(grades)]))


# --- pressure and event tables ---------------------------------------------
def pressure_detail(observations: DataFrame, assessments: DataFrame) -> DataFrame:
    """Observations with the grade of their own assessment, one to one.

    Run :func:`one_to_one_findings` on the same inputs first: the join keeps every
    observation, and one without assessment stays UNKNOWN.
    """
    keyed = observations.withColumn("event_key", S.event_key())
    return keyed.join(
        assessments.select("event_key", "selected_classification_date", "raw_classification"), "event_key", "left"
    ).withColumn("classification", S.grade_bucket("raw_classification", "selected_classification_date"))


def one_to_one_findings(left: DataFrame, right: DataFrame, key: str = "event_key") -> DataFrame:
    """Duplicate keys on either side and left keys without partner."""
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counted = sides.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return counted.select(
        key,
        F.when(F.col("l") > 1, "LEFT_KEY_DUPLICATE")
        .when(F.col("r") > 1, "RIGHT_KEY_DUPLICATE")
        .when((F.col("l") == 1) & (F.col("r") == 0), "PARTNER_MISSING")
        .alias("finding"),
    ).where(F.col("finding").isNotNull())


def _frequency_columns(frequency: str) -> list[Column]:
    # one row per grade at this point, so the unpartitioned windows see nine rows
    everything = Window.partitionBy(F.lit(1))
    ranked = everything.orderBy(F.desc(frequency))
    return [
        F.when(F.col(frequency) > 0, F.dense_rank().over(ranked)).alias("frequency_rank"),
        S.rate(frequency, F.sum(frequency).over(everything)).alias("event_share"),
    ]


def pressure_grade_summary(detail: DataFrame) -> DataFrame:
    """Frequency, rank, upgrades and limit-down days per grade."""
    counts = ["observation_frequency", "distinct_security_count", "upgraded_event_count", "total_limit_down_days"]
    stats = detail.groupBy("classification").agg(
        F.count("*").alias(counts[0]),
        F.count_distinct(F.struct(*R.KEY)).alias(counts[1]),
        F.count_if("upgraded_to_formal_risk").alias(counts[2]),
        F.sum("consecutive_length").alias(counts[3]),
    )
    dense = _grade_grid(detail.sparkSession, R.GRADE_BUCKETS).join(stats, "classification", "left").fillna(0, counts)
    return dense.select(
        "classification",
        *counts,
        S.rate("upgraded_event_count", "observation_frequency").alias("upgrade_rate"),
        S.rate("total_limit_down_days", "observation_frequency").alias("average_limit_down_days"),
        *_frequency_columns("observation_frequency"),
    )


def pressure_totals(detail: DataFrame) -> DataFrame:
    """Batch totals shown above the pressure table."""
    key = F.struct(*R.KEY)
    return detail.agg(
        F.count("*").alias("observation_count"),
        F.count_distinct(key).alias("distinct_security_count"),
        F.count_if("upgraded_to_formal_risk").alias("upgraded_event_count"),
        F.count_distinct(F.when(F.col("upgraded_to_formal_risk"), key)).alias("upgraded_security_count"),
        F.count_if("open_at_observation_end").alias("open_event_count"),
        F.count_if(F.col("classification") == "BLANK").alias("blank_event_count"),
        F.count_if(F.col("classification") == "UNKNOWN").alias("unknown_event_count"),
    ).withColumn("upgrade_rate", S.rate("upgraded_event_count", "observation_count"))


def event_detail(events: DataFrame, assessments: DataFrame, broker_id: str, event_type: str) -> DataFrame:
    """Formal events of one type with one broker's grade and defined warning days."""
    own = assessments.where((F.col("broker_id") == broker_id) & (F.col("event_type") == event_type)).select(
        "event_key",
        "raw_classification",
        "selected_classification_date",
        F.when(F.col("warning_days_status") == "DEFINED", F.col("warning_trading_days")).alias("warning_days"),
    )
    return (
        events.where(F.col("event_type") == event_type)
        .withColumn("event_key", S.event_key())
        .join(own, "event_key", "left")
        .withColumn("classification", S.grade_bucket("raw_classification", "selected_classification_date"))
    )


def event_grade_summary(detail: DataFrame) -> DataFrame:
    """Formal events per grade with intercepted counts and warning days."""
    counts = ["event_frequency", "distinct_security_count", "total_limit_down_days", "defined_warning_days_count"]
    stats = detail.groupBy("classification").agg(
        F.count("*").alias(counts[0]),
        F.count_distinct(F.struct(*R.KEY)).alias(counts[1]),
        F.sum(F.coalesce("consecutive_length", F.lit(0))).alias(counts[2]),
        F.count("warning_days").alias(counts[3]),
        F.sum("warning_days").alias("warning_days_sum"),
    )
    dense = _grade_grid(detail.sparkSession, R.GRADE_BUCKETS).join(stats, "classification", "left").fillna(0, counts)
    return dense.select(
        "classification",
        *counts,
        S.rate("total_limit_down_days", "event_frequency").alias("average_limit_down_days"),
        S.rate("warning_days_sum", "defined_warning_days_count").alias("average_warning_days"),
        F.when(F.col("classification").isin(*R.INTERCEPT_GRADES), F.col("event_frequency"))
        .when(F.col("classification") == "UNKNOWN", F.lit(None).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("intercept_event_count"),
        *_frequency_columns("event_frequency"),
    )


def event_totals(detail: DataFrame) -> DataFrame:
    """Coverage rate and warning-day statistics of the intercepted events."""
    key = F.struct(*R.KEY)
    caught = F.col("classification").isin(*R.INTERCEPT_GRADES)
    days = F.when(caught, F.col("warning_days"))
    return detail.agg(
        F.count("*").alias("event_count"),
        F.count_distinct(key).alias("distinct_security_count"),
        F.count_if(caught).alias("intercept_event_count"),
        F.count_distinct(F.when(caught, key)).alias("intercept_security_count"),
        F.count(days).alias("warning_days_count"),
        F.min(days).alias("warning_days_min"),
        F.max(days).alias("warning_days_max"),
        F.median(days).alias("warning_days_median"),
        F.sum(days).alias("_sum"),
    ).select(
        "*",
        S.rate("intercept_event_count", "event_count").alias("coverage_rate"),
        S.rate("_sum", "warning_days_count").alias("warning_days_mean"),
    ).drop("_sum")


def threshold_comparison(strict_new: DataFrame, strict_old: DataFrame, loose_new: DataFrame, loose_old: DataFrame) -> DataFrame:
    """Strict against low threshold and new against old model per grade."""

    def pick(df: DataFrame, prefix: str, **cols: str) -> DataFrame:
        return df.select("classification", *[F.col(c).alias(f"{prefix}_{name}") for name, c in cols.items()])

    strict = {"frequency": "event_frequency", "share": "event_share"}
    loose = {
        "frequency": "observation_frequency",
        "share": "event_share",
        "upgrade_count": "upgraded_event_count",
        "upgrade_rate": "upgrade_rate",
    }
    joined = (
        pick(strict_new, "strict_new", **strict)
        .join(pick(strict_old, "strict_old", **strict), "classification")
        .join(pick(loose_new, "loose_new", **loose), "classification")
        .join(pick(loose_old, "loose_old", **loose), "classification")
    )

    def delta(kind: str, name: str) -> Column:
        return (F.col(f"{kind}_new_{name}") - F.col(f"{kind}_old_{name}")).alias(f"{kind}_{name}_delta")

    return joined.select(
        "*", delta("strict", "frequency"), delta("strict", "share"),
        delta("loose", "frequency"), delta("loose", "share"), delta("loose", "upgrade_rate"),
    )


# --- returns ----------------------------------------------------------------
def simple_returns(prices: DataFrame, status: Sequence[str] = R.RETURN_NORMAL_STATUS) -> DataFrame:
    """close / previous - 1 on normal days with a positive previous close."""
    previous = F.col("previous_close").try_cast("decimal(20,6)")
    close = F.col("close_price").try_cast("decimal(20,6)")
    return (
        prices.where(F.trim("trading_status").isin(*status) & (previous > 0) & (close >= 0))
        .select(*R.KEY, DAY, (close / previous - F.lit(1)).cast("decimal(28,18)").alias("simple_return"))
    )


def price_quality(prices: DataFrame, status: Sequence[str] = R.RETURN_NORMAL_STATUS) -> DataFrame:
    """Source, eligible, valid, invalid, duplicate and extreme row counts.

    A key's first valid row counts, so rows are folded per key before the totals.
    """
    previous = F.col("previous_close").try_cast("decimal(20,6)")
    close = F.col("close_price").try_cast("decimal(20,6)")
    normal = F.trim("trading_status").isin(*status)
    valid = F.coalesce(normal & (previous > 0) & (close >= 0), F.lit(False))
    ret = F.when(valid, F.abs(close / previous - F.lit(1)))
    per_key = prices.groupBy(*R.KEY, DAY).agg(
        F.count("*").alias("rows"),
        F.count_if(normal).alias("normal"),
        F.count_if(valid).alias("valid"),
        F.max(ret).alias("largest"),
    )
    return per_key.agg(
        F.sum("rows").alias("source_row_count"),
        F.sum("normal").alias("normal_row_count"),
        F.count_if(F.col("valid") > 0).alias("valid_return_row_count"),
        F.sum(F.col("normal") - F.col("valid")).alias("invalid_price_row_count"),
        F.sum(F.greatest(F.col("valid") - 1, F.lit(0))).alias("duplicate_row_count"),
        F.count_if(F.col("largest") > F.lit("0.30").cast("decimal(3,2)")).alias("extreme_return_count"),
    )


def return_findings(prices: DataFrame, status: Sequence[str] = R.RETURN_NORMAL_STATUS) -> DataFrame:
    """Findings on the prices that returns come from (G25): a key with several valid rows
    (BM502, blocking) and a return beyond 30 % (BM503)."""
    previous = F.col("previous_close").try_cast("decimal(20,6)")
    close = F.col("close_price").try_cast("decimal(20,6)")
    valid = prices.where(F.trim("trading_status").isin(*status) & (previous > 0) & (close >= 0))
    per_key = valid.groupBy(*R.KEY, DAY).agg(
        F.count("*").alias("rows"), F.max(F.abs(close / previous - F.lit(1))).alias("largest")
    )
    codes = F.array_compact(
        F.array(
            F.when(F.col("rows") > 1, "BM502"),
            F.when(F.col("largest") > F.lit("0.30").cast("decimal(3,2)"), "BM503"),
        )
    )
    return per_key.select(F.explode(codes).alias("code"), *R.KEY, F.col(DAY).alias("fact_date"))


def grade_returns_daily(
    securities: DataFrame, days: DataFrame, window: tuple, history: DataFrame, returns: DataFrame, brokers: Sequence[str]
) -> DataFrame:
    """Equal-weight daily return per broker and raw grade.

    The grade known at the close of T-1 meets the return of T: the carry ends one
    row before the current day. Brokers are exploded after the carry and folded
    map-side, so what is shuffled is one row per broker, grade and day and task.
    """
    start, end = window
    inside = days.where(F.col(DAY).between(F.lit(start), F.lit(end)))
    grid = expected_days(securities, inside).select(*R.KEY, DAY, "ordinal")
    stacked = active_grades(
        history.where(F.col("classification_date") <= F.lit(end)), grid, {"ret": returns.select(*R.KEY, DAY, "simple_return")}
    )
    # the lagged carry must see history rows on days outside the grid, so it precedes the filter
    lagged = stacked.withColumn("known", carry(F.col("hist.grades"), before())).where(F.col("grid").isNotNull())
    rows = lagged.select(
        DAY,
        F.col("ret.simple_return").alias("r"),
        F.explode(F.arrays_zip(F.array(*[F.lit(b) for b in brokers]).alias("b"), F.col("known").alias("g"))).alias("x"),
    ).select(DAY, "r", F.col("x.b").alias("broker_id"), F.col("x.g").alias("raw_classification"))
    return (
        rows.where(F.coalesce("raw_classification", F.lit("")) != "")
        .groupBy("broker_id", "raw_classification", F.col(DAY).alias("return_date"))
        .agg(
            F.count("*").alias("classified_security_count"),
            F.count("r").alias("valid_return_security_count"),
            F.sum("r").alias("return_sum"),
            F.count_if(F.col("r") > 0).alias("positive_return_security_count"),
        )
        .select(
            "*",
            S.rate("valid_return_security_count", "classified_security_count", 10).alias("return_coverage_rate"),
            (F.col("return_sum").cast("decimal(30,15)") / F.nullif(F.col("valid_return_security_count"), F.lit(0)).cast("decimal(12,0)")).alias("daily_return"),
            S.rate("positive_return_security_count", "valid_return_security_count", 10).alias("positive_return_rate"),
        )
        .withColumn("equal_weight_daily_return", F.round("daily_return", 10))
    )


def ordered_growth(rows: DataFrame, keys: Sequence[str], day: str, value: str, span: int = 64) -> DataFrame:
    """Per key: ``growth``, the product of 1 + r over its days, ``worst_fall``, the lowest value
    relative to the peak before it when it starts at 1 (W19, W20).

    Days are cut into ranges of ``span``. A range's summary (product, highest and lowest value,
    worst fall inside) says all that the ranges after it need to know, so summaries are
    combined in the order of the ranges: only they are shuffled by key, and no list of a key's
    days is built. Null returns are left out; returns are at least -1.
    """
    key = list(keys)
    rows = rows.where(F.col(value).isNotNull()).select(
        *key, F.col(day).alias("_day"), (F.col(value).cast("double") + 1).alias("_f"), F.floor(F.unix_date(day) / span).alias("_range")
    )
    inside = Window.partitionBy(*key, "_range").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    valued = rows.withColumn("_nav", F.product("_f").over(inside))
    valued = valued.withColumn("_peak", F.max("_nav").over(inside))
    ranges = valued.groupBy(*key, "_range").agg(
        F.product("_f").alias("_growth"),
        F.max("_nav").alias("_high"),
        F.min("_nav").alias("_low"),
        F.min(F.coalesce(F.try_divide("_nav", "_peak"), F.lit(1.0))).alias("_fall"),
    )
    by = Window.partitionBy(*key).orderBy("_range")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    entered = ranges.withColumn("_start", F.coalesce(F.product("_growth").over(before), F.lit(1.0)))
    entered = entered.withColumn("_top", F.greatest(F.lit(1.0), F.max(F.col("_start") * F.col("_high")).over(before)))
    fall = F.least(F.col("_fall"), F.col("_start") * F.col("_low") / F.col("_top"), F.lit(1.0)) - 1
    return entered.groupBy(*key).agg(F.product("_growth").alias("growth"), F.min(fall).alias("worst_fall"))


def grade_return_summary(daily: DataFrame) -> DataFrame:
    """Period statistics per broker and grade from the daily table."""
    keys = ["broker_id", "raw_classification"]
    growth = ordered_growth(daily, keys, "return_date", "daily_return").select(*keys, "growth")
    return (
        daily.groupBy(*keys)
        .agg(
            F.min("return_date").alias("return_start_date"),
            F.max("return_date").alias("return_end_date"),
            F.count("*").alias("classified_trading_day_count"),
            F.count("daily_return").alias("valid_return_trading_day_count"),
            F.sum("classified_security_count").alias("classified_stock_day_count"),
            F.sum("valid_return_security_count").alias("valid_return_stock_day_count"),
            F.sum(F.col("daily_return").cast("decimal(28,18)")).alias("_daily_sum"),
            F.sum(F.col("return_sum").cast("decimal(28,15)")).alias("_stock_sum"),
            F.sum("positive_return_security_count").alias("positive_return_stock_day_count"),
        )
        .join(growth, keys, "left")
        .select(
            "broker_id",
            "raw_classification",
            "return_start_date",
            "return_end_date",
            "classified_trading_day_count",
            "valid_return_trading_day_count",
            "classified_stock_day_count",
            "valid_return_stock_day_count",
            "positive_return_stock_day_count",
            S.rate("valid_return_stock_day_count", "classified_stock_day_count", 10).alias("return_coverage_rate"),
            F.round(F.col("_daily_sum").cast("double") / F.nullif("valid_return_trading_day_count", F.lit(0)), 10).alias("mean_equal_weight_daily_return"),
            F.round(F.col("growth") - 1, 10).alias("compounded_equal_weight_return"),
            F.round(F.col("_stock_sum").cast("double") / F.nullif("valid_return_stock_day_count", F.lit(0)), 10).alias("stock_day_weighted_mean_return"),
            S.rate("positive_return_stock_day_count", "valid_return_stock_day_count", 10).alias("positive_return_rate"),
        )
    )


def return_input_findings(summary: DataFrame, brokers: Sequence[str], adjustment: str) -> DataFrame:
    """Findings on what the returns were made of (G25): prices that are not post-adjusted (BM505)
    and brokers without any grade that returns could be given to (BM504)."""
    spark = summary.sparkSession
    every = R.literal_rows(spark, ("broker_id",), [(b,) for b in brokers])
    empty = every.join(summary.select("broker_id").distinct(), "broker_id", "left_anti").select(
        F.lit("BM504_BROKER_RETURN_CLASSIFICATION_EMPTY").alias("code"), F.lit("INFO").alias("severity"), "broker_id"
    )
    if adjustment == R.RETURN_PRICE_ADJUSTMENT:
        return empty
    other = [("BM505_GRADE_RETURN_INPUT_NOT_POST_ADJUSTED", "WARNING", None)]
    return empty.unionByName(spark.createDataFrame(other, "code string, severity string, broker_id string"))


# --- two-model snapshot tables ---------------------------------------------
def grade_snapshot(history: DataFrame, position: int, end: date) -> DataFrame:
    """Last grade per security up to a date, for one broker position of the cells."""
    return (
        history.where(F.col("classification_date") <= F.lit(end))
        .groupBy(*R.KEY)
        .agg(F.max_by(F.get("grades", F.lit(position)), "classification_date").alias("grade"))
        .where(F.col("grade") != "")
    )


def _two_models(legacy: DataFrame, new: DataFrame) -> DataFrame:
    tag = lambda df, m: df.withColumn("model", F.lit(m))
    return tag(legacy, "legacy").unionByName(tag(new, "new")).where(F.col("grade").isin(*R.GRADES))


def _with_total(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """Per-grade rows on the full grade grid plus a total row."""
    rolled = df.rollup("grade").agg(*aggs).withColumn("grade", F.coalesce("grade", F.lit("TOTAL")))
    grid = R.literal_rows(df.sparkSession, ("grade",), [(g,) for g in (*R.GRADES, "TOTAL")])
    return F.broadcast(grid).join(rolled, "grade", "left")


def grade_count_comparison(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """Security counts and shares per grade of two models with a total row."""
    is_old = F.col("model") == "legacy"
    counted = _with_total(
        _two_models(legacy, new),
        [F.count_if(is_old).alias("legacy_count"), F.count_if(~is_old).alias("new_count")],
    ).fillna(0)
    total = Window.partitionBy(F.lit(1))
    share = lambda c: S.rate(c, F.max(c).over(total))
    out = counted.select("grade", "legacy_count", "new_count", share("legacy_count").alias("legacy_share"), share("new_count").alias("new_share"))
    inner = F.col("grade") != "TOTAL"
    return out.select(
        "*",
        F.when(inner, F.col("new_count") - F.col("legacy_count")).alias("count_change"),
        F.when(inner, F.col("new_share") - F.col("legacy_share")).alias("share_change"),
    )


def latest_market_caps(caps: DataFrame, end: date) -> DataFrame:
    """Caps of the latest capitalisation date up to a date; negatives are no caps."""
    upto = caps.where(F.col(DAY) <= F.lit(end))
    last = upto.agg(F.max(DAY).alias(DAY))  # one row
    return upto.join(last, DAY).where(F.col("total_market_cap") >= 0).select(*R.KEY, "total_market_cap")


def grade_cap_comparison(legacy: DataFrame, new: DataFrame, caps: DataFrame) -> DataFrame:
    """Market cap per grade of two models with coverage counts and a total row."""
    joined = _two_models(legacy, new).join(caps, list(R.KEY), "left")
    is_old = F.col("model") == "legacy"
    cap = F.col("total_market_cap")
    table = _with_total(
        joined,
        [
            F.sum(F.when(is_old, cap)).alias("legacy_sum"),
            F.count(F.when(is_old, cap)).alias("legacy_covered"),
            F.sum(F.when(~is_old, cap)).alias("new_sum"),
            F.count(F.when(~is_old, cap)).alias("new_covered"),
        ],
    ).fillna(0)
    total = Window.partitionBy(F.lit(1))

    def share(c: str) -> Column:
        whole = F.max(c).over(total)
        return F.round(F.col(c).cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), 6)

    inner = F.col("grade") != "TOTAL"
    return table.select(
        "grade",
        F.round(F.col("legacy_sum").cast("double") / YI, 6).alias("legacy_cap_yi"),
        share("legacy_sum").alias("legacy_share"),
        "legacy_covered",
        F.round(F.col("new_sum").cast("double") / YI, 6).alias("new_cap_yi"),
        share("new_sum").alias("new_share"),
        "new_covered",
        F.when(inner, F.round((F.col("new_sum") - F.col("legacy_sum")).cast("double") / YI, 6)).alias("cap_change_yi"),
    )


def grade_market_stats(history: DataFrame, prices: DataFrame, window: tuple, models: Sequence[tuple[str, int]]) -> DataFrame:
    """Amplitude, volatility, drawdown and turnover per model and grade.

    ``prices`` needs amplitude, simple_return (may be null) and amount; ``models``
    are (label, broker position) pairs. The grade of T-1 applies to day T.
    """
    start, end = window
    grid = prices.where(F.col(DAY).between(F.lit(start), F.lit(end))).select(
        *R.KEY, DAY, "amplitude", "simple_return", "amount"
    )
    stacked = active_grades(history.where(F.col("classification_date") <= F.lit(end)), grid)
    known = stacked.withColumn("known", carry(F.col("hist.grades"), before())).where(F.col("grid").isNotNull())
    labels = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(p).alias("pos")) for m, p in models])
    rows = known.select(*R.KEY, DAY, "grid.*", "known", F.explode(labels).alias("m")).select(
        *R.KEY, DAY, "amplitude", "simple_return", "amount", "m.model", F.upper(F.get("known", F.col("m.pos"))).alias("grade")
    ).where(F.col("grade").isin(*R.GRADES))
    # two folds that both combine map-side: per grade-day, then per grade
    per_day = rows.groupBy("model", "grade", DAY).agg(
        F.sum("amplitude").alias("amplitude"),
        F.sum("amount").alias("amount"),
        F.count("*").alias("n"),
        (F.sum("simple_return").cast("double") / F.nullif(F.count("simple_return"), F.lit(0))).alias("daily_return"),
    )
    distinct = rows.groupBy("model", "grade").agg(F.count_distinct(F.struct(*R.KEY)).alias("distinct_stock_count"))
    stats = per_day.groupBy("model", "grade").agg(
        F.sum("amplitude").cast("double").alias("amplitude"),
        F.sum("amount").cast("double").alias("amount"),
        F.sum("n").alias("valid_stock_day_count"),
        F.count("daily_return").alias("valid_trading_day_count"),
        F.stddev_samp("daily_return").alias("sd"),
    )
    falls = ordered_growth(per_day, ["model", "grade"], DAY, "daily_return").select("model", "grade", "worst_fall")
    grid_rows = R.literal_rows(history.sparkSession, ("model", "grade"), [(m, g) for m, _ in models for g in R.GRADES])
    dense = (
        F.broadcast(grid_rows)
        .join(stats, ["model", "grade"], "left")
        .join(distinct, ["model", "grade"], "left")
        .join(falls, ["model", "grade"], "left")
        .fillna(0, ["valid_stock_day_count", "valid_trading_day_count", "distinct_stock_count"])
    )
    n = F.nullif(F.col("valid_stock_day_count"), F.lit(0))
    enough = F.col("valid_trading_day_count") >= 2
    return dense.select(
        "model",
        "grade",
        F.round(F.col("amplitude") / n, 6).alias("mean_amplitude"),
        F.when(enough, F.round(F.col("sd") * F.sqrt(F.lit(252.0)), 6)).alias("annual_volatility"),
        F.round("worst_fall", 6).alias("maximum_drawdown"),
        F.round(F.col("amount") / n / YI, 9).alias("mean_amount_yi"),
        "valid_trading_day_count",
        "valid_stock_day_count",
        "distinct_stock_count",
        F.when(F.col("valid_stock_day_count") == 0, "NO_VALID_SAMPLE")
        .when(F.col("valid_trading_day_count") == 0, "ADJUSTED_RETURN_PENDING")
        .otherwise("READY")
        .alias("status"),
    )


# --- period tables ----------------------------------------------------------
def period_report(assessed: DataFrame, grade_days: DataFrame, label: str) -> DataFrame:
    """Events per grade and type over the mean daily grade count, in percent.

    ``assessed`` holds one row per event (event_type, grade); ``grade_days`` the
    observed source rows (source_date, grade) without any forward fill.
    """
    totals = grade_days.groupBy("grade").agg(F.count("*").alias("stock_days"))
    days = grade_days.agg(F.count_distinct("source_date").alias("source_day_count"))  # one row
    counts = assessed.groupBy("event_type", "grade").agg(F.count("*").alias("event_count"))
    grid = R.literal_rows(
        assessed.sparkSession, ("event_type", "grade"), [(t, g) for t in R.EVENT_VIEWS[:2] for g in R.GRADES]
    )
    dense = (
        F.broadcast(grid)
        .join(counts, ["event_type", "grade"], "left")
        .join(totals, "grade", "left")
        .withColumn("one", F.lit(1))
        .join(F.broadcast(days.withColumn("one", F.lit(1))), "one")
        .fillna(0, ["event_count", "stock_days"])
    )
    # count / (stock_days / days) * 100, divided once so nothing is rounded early
    percent = S.ratio(F.col("event_count") * F.col("source_day_count") * 100, "stock_days")
    return dense.select(
        F.lit(label).alias("model"),
        "event_type",
        "grade",
        "event_count",
        "source_day_count",
        "stock_days",
        S.rate("stock_days", "source_day_count", 0).cast("bigint").alias("mean_daily_count"),
        F.round(percent, 2).alias("event_percent"),
        F.when(F.col("source_day_count") == 0, "MISSING")
        .when(F.col("stock_days") == 0, "ZERO")
        .otherwise("DEFINED")
        .alias("denominator_status"),
    )


def grade_banding(assessed: DataFrame, daily_grades: DataFrame) -> DataFrame:
    """Events, stock-days, daily mean and ratio text per grade."""
    totals = daily_grades.groupBy("grade").agg(F.count("*").alias("stock_days"))
    days = daily_grades.agg(F.count_distinct(DAY).alias("trading_days")).withColumn("one", F.lit(1))
    counts = assessed.groupBy("grade").agg(F.count("*").alias("risk_event_count"))
    grid = R.literal_rows(assessed.sparkSession, ("grade", "one"), [(g, 1) for g in R.GRADES])
    return (
        F.broadcast(grid)
        .join(counts, "grade", "left")
        .join(totals, "grade", "left")
        .join(F.broadcast(days), "one")
        .fillna(0, ["risk_event_count", "stock_days"])
        .select(
            "grade",
            "risk_event_count",
            "stock_days",
            "trading_days",
            S.rate("stock_days", "trading_days", 2).alias("daily_average"),
            S.percent_text(F.col("risk_event_count") * F.col("trading_days"), "stock_days").alias("ratio_display"),
        )
    )


def apply_overrides(grades: DataFrame, overrides: DataFrame, days: DataFrame) -> DataFrame:
    """Per-security grade overrides on every day, with what they changed.

    ``overrides`` (key, override_grade) is a reviewed list; it joins by key, so a
    large one shuffles like any other table.
    """
    forced = overrides.select(*R.KEY, "override_grade").join(
        days.select("market_code", DAY), "market_code"
    )
    return grades.join(forced, [*R.KEY, DAY], "full_outer").select(
        *R.KEY,
        DAY,
        F.coalesce("override_grade", "grade").alias("grade"),
        F.when(F.col("grade").isNull(), "ADDED")
        .when(F.col("override_grade").isNotNull() & (F.col("override_grade") != F.col("grade")), "CHANGED")
        .otherwise("KEPT")
        .alias("override_effect"),
    )
