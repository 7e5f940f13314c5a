"""Universe eligibility and the input gate of the event run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.panel import (
    DAY,
    by_day,
    carry,
    expected_days,
    lifecycle,
    market_daily,
    st_daily,
    stack_by_day,
    trading_window,
)

REQUIRED = {
    "broker": ("market_code", "security_code", "classification_date"),
    "master": ("market_code", "security_code", "status_date", "board_code", "listed_date", "delisted_date"),
    "calendar": ("market_code", "calendar_date", "is_trading_day"),
    "market": (
        "market_code", "security_code", "trading_date", "trading_status", "close_price", "limit_down_price",
        "source_record_id",
    ),
    "st": (
        "market_code", "security_code", "risk_status_type", "risk_status_value", "status_start_date",
        "source_record_id",
    ),
}


def business_universe(
    primary: DataFrame, supplemental: DataFrame | None, end: date, digits: str = R.CODE_DIGITS
) -> DataFrame:
    """Distinct (classification_date, security) of all source files up to a date."""
    files = primary.select("biz_date", "stk_code")
    if supplemental is not None:
        files = files.unionByName(supplemental.select("biz_date", "stk_code"))
    return (
        files.where(F.col("biz_date") <= F.lit(end))
        .select(
            F.col("biz_date").alias("classification_date"),
            S.security_market("stk_code", digits).alias("market_code"),
            S.canonical_security("stk_code", digits).alias("security_code"),
        )
        .distinct()
    )


def universe_summary(universe: DataFrame) -> DataFrame:
    key = F.struct(*R.KEY)
    return universe.agg(
        F.count("*").alias("canonical_row_count"),
        F.count_distinct(key).alias("security_count"),
        F.count_distinct(F.when(F.col("market_code") == "XBSE", key)).alias("bse_security_count"),
        F.min("classification_date").alias("min_classification_date"),
        F.max("classification_date").alias("max_classification_date"),
    )


def universe_split(universe: DataFrame, master: DataFrame, rules: R.RiskRules) -> DataFrame:
    """ELIGIBLE / EXCLUDED / MASTER_MISSING per security of the universe.

    The excluded market goes before the master lookup, excluded boards after it.
    """
    raw = universe.where(F.col("classification_date") <= F.lit(rules.observation_end)).select(*R.KEY).distinct()
    latest = lifecycle(master, rules.observation_end)
    board = S.canonical_board("board_code", rules.board_aliases)
    return raw.join(latest, list(R.KEY), "left").select(
        *R.KEY,
        "listed_date",
        "delisted_date",
        F.when(F.col("market_code").isin(*rules.excluded_markets), "EXCLUDED")
        .when(F.col("board_code").isNull(), "MASTER_MISSING")
        .when(board.isin(*rules.excluded_boards), "EXCLUDED")
        .otherwise("ELIGIBLE")
        .alias("eligibility"),
        F.when(
            F.col("market_code").isin(*rules.excluded_markets) | board.isin(*rules.excluded_boards),
            "BOARD_EXCLUDED_BSE",
        ).alias("reason"),
    )


def partition_proof(raw: DataFrame, eligible: DataFrame, excluded: DataFrame) -> DataFrame:
    """Securities that break raw = eligible + excluded (U2); empty when it is a partition."""
    tag = lambda df, r, e, x: df.select(*R.KEY, F.lit(r).alias("r"), F.lit(e).alias("e"), F.lit(x).alias("x"))
    folded = (
        tag(raw, 1, 0, 0)
        .unionByName(tag(eligible, 0, 1, 0))
        .unionByName(tag(excluded, 0, 0, 1))
        .groupBy(*R.KEY)
        .agg(F.max("r").alias("r"), F.max("e").alias("e"), F.max("x").alias("x"))
    )
    return folded.where((F.col("e") + F.col("x") != 1) | (F.col("r") != 1)).select(
        *R.KEY,
        F.when(F.col("r") == 0, "NOT_IN_RAW")
        .when(F.col("e") + F.col("x") == 0, "UNASSIGNED")
        .otherwise("ASSIGNED_TWICE")
        .alias("violation"),
    )


def missing_fields(tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """(table, field) pairs a schema lacks; decided from the plans alone."""
    return [(t, f) for t, fields in REQUIRED.items() for f in fields if f not in tables[t].columns]


def missing_board_requests(panel_market: DataFrame, master: DataFrame) -> DataFrame:
    """Earliest limit-down candidate day without a dated board, per security.

    ``panel_market`` holds the candidate days (key, trading_date). The first master
    date decides, so no as-of join is needed.
    """
    first = master.groupBy(*R.KEY).agg(F.min("status_date").alias("first_status"))
    return (
        panel_market.join(first, list(R.KEY), "left")
        .where(F.col("first_status").isNull() | (F.col("first_status") > F.col(DAY)))
        .groupBy(*R.KEY)
        .agg(F.min(DAY).alias("request_date"))
    )


def candidate_days(market: DataFrame, risk_status: DataFrame, scale: int = 6, securities: DataFrame | None = None) -> DataFrame:
    """Days that meet the limit-down predicate outside the excluded market.

    ``securities`` (key, listed_date, delisted_date) leaves only days of their right-open
    lifecycles: an ST row of the termination day itself makes no candidate there.
    """
    merged = stack_by_day({"mkt": market_daily(market), "st": st_daily(risk_status)})
    found = merged.where(
        ~F.col("market_code").isin("XBSE")
        & S.is_limit_down("st.is_st", "mkt.trading_status", "mkt.close_price", "mkt.limit_down_price", scale)
    ).select(*R.KEY, DAY)
    if securities is None:
        return found
    alive = found.join(securities.select(*R.KEY, "listed_date", "delisted_date"), list(R.KEY))
    return alive.where(S.in_lifecycle(DAY, "listed_date", "delisted_date")).select(*R.KEY, DAY)


def coverage_findings(split: DataFrame, days: DataFrame, market: DataFrame, risk_status: DataFrame, master: DataFrame, rules: R.RiskRules) -> DataFrame:
    """Gate findings of the eligible securities: market, ST, board and baseline evidence (Q13).

    One panel carries all four checks, so the expected grid is built and shuffled once.
    """
    eligible = split.where(F.col("eligibility") == "ELIGIBLE")
    grid = expected_days(eligible, trading_window(days, rules)).select(*R.KEY, DAY, "listed_date")
    boards = master.groupBy(*R.KEY).agg(F.min("status_date").alias(DAY)).withColumn("has_board", F.lit(True))
    merged = stack_by_day(
        {"grid": grid, "mkt": market_daily(market), "st": st_daily(risk_status), "brd": boards}
    )
    start = F.lit(rules.observation_start)
    prior = carry(F.when((F.col(DAY) < start) & F.col("st").isNotNull(), F.lit(True)))
    board_known = carry(F.col("brd.has_board"))
    scanned = merged.select(
        *R.KEY, DAY, "grid", "mkt", "st", prior.alias("has_prior"), board_known.alias("board_known")
    ).where(F.col("grid").isNotNull())
    first = F.row_number().over(by_day()) == 1
    inside = F.coalesce(F.col("grid.listed_date") >= start, F.lit(False))
    baseline = F.when(inside, F.col("st").isNotNull()).otherwise(F.col("has_prior").isNotNull())
    candidate = S.is_limit_down(
        "st.is_st", "mkt.trading_status", "mkt.close_price", "mkt.limit_down_price", rules.decimal_scale
    )
    codes = F.array_compact(
        F.array(
            F.when(F.col("mkt").isNull(), "RISK_GATE_UNIVERSE_MARKET_COVERAGE_MISSING"),
            F.when(F.col("st").isNull(), "RISK_GATE_UNIVERSE_ST_COVERAGE_MISSING"),
            F.when(F.col("st").isNotNull() & F.col("st.is_st").isNull(), "RISK_GATE_ST_LITERAL_UNKNOWN"),
            F.when(candidate & F.col("board_known").isNull(), "RISK_GATE_BOARD_MISSING"),
            F.when(F.col("is_first") & ~baseline, "RISK_GATE_ST_BASELINE_MISSING"),
        )
    )
    return scanned.withColumn("is_first", first).select(*R.KEY, DAY, F.explode(codes).alias("code")).select(
        "code",
        F.lit("ERROR").alias("severity"),
        *R.KEY,
        F.when(F.col("code") != "RISK_GATE_ST_BASELINE_MISSING", F.col(DAY)).alias("fact_date"),
    )


def gate_findings(
    tables: dict[str, DataFrame], days: DataFrame, rules: R.RiskRules, *, prevalidation_allow_run: bool = True
) -> DataFrame:
    """All findings of the input gate (Q13). A missing field stops every other check."""
    spark = tables["broker"].sparkSession
    schema = "code string, severity string, market_code string, security_code string, fact_date date"
    fixed = []
    if not prevalidation_allow_run:
        fixed.append(("RISK_GATE_PREVALIDATION_REJECTED", "ERROR", None, None, None))
    fixed += [("RISK_GATE_REQUIRED_FIELD_MISSING", "ERROR", t, f, None) for t, f in missing_fields(tables)]
    head = spark.createDataFrame(fixed, schema)
    if any(row[0] == "RISK_GATE_REQUIRED_FIELD_MISSING" for row in fixed):
        return head
    split = universe_split(tables["broker"], tables["master"], rules)

    def coded(df: DataFrame, code: str) -> DataFrame:
        return df.select(
            F.lit(code).alias("code"), F.lit("ERROR").alias("severity"), *R.KEY, F.lit(None).cast("date").alias("fact_date")
        )

    out = head
    code = rf"^{rules.code_digits}(\.(XSHG|XSHE|XBSE))?$"
    for name in ("broker", "master", "market", "st"):
        bad = tables[name].where(~F.col("security_code").rlike(code)).select(*R.KEY).distinct()
        out = out.unionByName(coded(bad, "RISK_GATE_SECURITY_CODE_INVALID"))
    out = out.unionByName(coded(split.where(F.col("eligibility") == "MASTER_MISSING"), "RISK_GATE_UNIVERSE_MASTER_MISSING"))
    empty = tables["broker"].agg(F.count("*").alias("n")).where("n = 0").select(
        F.lit(None).cast("string").alias("market_code"), F.lit(None).cast("string").alias("security_code")
    )
    out = out.unionByName(coded(empty, "RISK_GATE_UNIVERSE_EMPTY"))
    unknown = unknown_literals(tables["st"]).select(
        F.lit(None).cast("string").alias("market_code"), F.col("literal").alias("security_code")
    )
    out = out.unionByName(coded(unknown, "RISK_GATE_ST_LITERAL_UNKNOWN"))
    return out.unionByName(coverage_findings(split, days, tables["market"], tables["st"], tables["master"], rules))


def unknown_literals(risk_status: DataFrame) -> DataFrame:
    """ST values that are no known literal, with their rows (P5). None may stay: an unknown
    state would count as "not ST" and hide or invent events."""
    text = F.lower(F.trim(F.col("risk_status_value").cast("string")))
    rows = risk_status.where((F.upper("risk_status_type") == "ST") & S.parse_st("risk_status_value").isNull())
    return rows.groupBy(F.coalesce(text, F.lit("")).alias("literal")).agg(F.count("*").alias("affected_rows"))


def allow_run(findings: DataFrame) -> DataFrame:
    """One row: may the event run start, and how many findings block it."""
    errors = F.count_if(F.col("severity") == "ERROR")
    return findings.agg((errors == 0).alias("allow_run"), errors.alias("error_count"), F.count("*").alias("finding_count"))
