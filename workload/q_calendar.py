"""Queries on calendar ranges, panel joins and carried state."""

from datetime import date

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import calendar, foundation, gate, grades, panel, quality, store
from earlybell.operators.panel import DAY
from workload.domain import CODE_DIGITS, END, RULES, START, Domain
from workload.q_assess import dbl
from workload.registry import query

MARKETS3 = "(SELECT unnest(['XSHG','XSHE','XBSE']) AS market_code) m"


@query(
    "c1_trading_day_index",
    f"SELECT market_code, d AS trading_date, ord::INTEGER AS ordinal, prev_d AS previous_day, next_d AS next_day FROM tdays CROSS JOIN {MARKETS3}",
)
def c1(d: Domain):
    return d.index


@query(
    "c1_trading_day_difference",
    """SELECT s.market_code, s.security_code, listed_date, last_day, (b.ord - a.ord)::INTEGER AS sessions FROM
    (SELECT market_code, security_code, min(d) AS listed_date, max(d) AS last_day FROM ev GROUP BY 1, 2) s
    LEFT JOIN tdays a ON a.d = s.listed_date LEFT JOIN tdays b ON b.d = s.last_day""",
)
def c1b(d: Domain):
    span = d.events.groupBy(*R.KEY).agg(F.min("d").alias("listed_date"), F.max("d").alias("last_day"))
    return calendar.trading_day_difference(span, d.index, "listed_date", "last_day", "sessions")


@query(
    "c2_previous_trading_day",
    """SELECT m.market_code, n.d AS calendar_date, isodow(n.d) < 6 AS is_trading_day,
    (SELECT max(t.d) FROM tdays t WHERE t.d < n.d) AS previous_trading_day, (SELECT max(t.d) FROM tdays t WHERE t.d <= n.d) AS latest_trading_day
    FROM natural_days n CROSS JOIN (SELECT unnest(['cn','XSHG']) AS market_code) m""",
)
def c2(d: Domain):
    return calendar.natural_day_lookup(d.calendar)


@query(
    "c3_last_completed_session",
    f"SELECT market_code, (SELECT max(d) FROM tdays WHERE d <= DATE '2024-01-28') AS effective_end FROM {MARKETS3}",
)
def c3(d: Domain):
    return calendar.last_completed_session(d.days, date(2024, 1, 28))


@query("c4_latest_shared_day", "SELECT max(d) AS safe_end_date FROM tdays WHERE d < DATE '2024-01-30'")
def c4(d: Domain):
    return calendar.latest_shared_day(d.days, R.RISK_MARKETS, END)


def _dated_facts(d: Domain):
    price = d.daily.select(F.lit("daily_price_unadjusted").alias("dataset_id"), "market_code", F.col(DAY).alias("business_date"))
    st = d.st_changes.select(F.lit("daily_st_status").alias("dataset_id"), "market_code", F.col(DAY).alias("business_date"))
    return price.unionByName(st)


COVER_SQL = """facts AS (SELECT 'daily_price_unadjusted' AS dataset_id, market_code, d FROM daily UNION ALL SELECT 'daily_st_status', market_code, d FROM st_changes),
    cov AS (SELECT g.dataset_id, g.market_code, min(d) AS minimum_business_date, max(d) AS maximum_business_date, count(DISTINCT d) AS distinct_business_dates,
      count(d) AS row_count FROM (SELECT * FROM (SELECT unnest(['daily_price_unadjusted','daily_st_status','daily_price_limits']) AS dataset_id)
      CROSS JOIN (SELECT unnest(['XSHG','XSHE','XBSE']) AS market_code)) g LEFT JOIN facts f USING (dataset_id, market_code) GROUP BY 1, 2)"""
COVERED = ("daily_price_unadjusted", "daily_st_status", "daily_price_limits")


@query(
    "c6_coverage",
    COVER_SQL
    + """ SELECT *, CASE WHEN minimum_business_date IS NOT NULL THEN 'AVAILABLE' WHEN dataset_id = 'daily_price_limits' AND market_code = 'XBSE'
    THEN 'OPTIONAL_NOT_APPLICABLE' ELSE 'MISSING' END AS coverage_state FROM cov""",
)
def c6(d: Domain):
    return calendar.coverage(_dated_facts(d), COVERED, R.MARKETS, [("daily_price_limits", "XBSE")])


@query(
    "c5_common_data_as_of",
    COVER_SQL
    + " SELECT CASE WHEN count(*) = count(maximum_business_date) THEN min(maximum_business_date) END AS data_as_of FROM cov WHERE dataset_id <> 'daily_price_limits' AND market_code <> 'XBSE'",
)
def c5(d: Domain):
    return calendar.common_data_as_of(calendar.coverage(_dated_facts(d), COVERED[:2], R.RISK_MARKETS))


@query(
    "c7_missing_ranges",
    """g AS (SELECT s.market_code, s.security_code, n.d FROM sec s JOIN natural_days n ON n.d >= s.listed_date AND (s.delisted_date IS NULL OR n.d < s.delisted_date)
      ANTI JOIN daily y ON y.security_code = s.security_code AND y.d = n.d),
    i AS (SELECT *, d - row_number() OVER (PARTITION BY security_code ORDER BY d)::INTEGER AS island FROM g)
    SELECT market_code, security_code, min(d) AS start_date, max(d) AS end_date, count(*) AS missing_days FROM i GROUP BY market_code, security_code, island""",
)
def c7(d: Domain):
    every_day = d.calendar.where(F.col("market_code") == "XSHG").select(F.col("calendar_date").alias(DAY))
    all_markets = every_day.select(F.explode(F.array(*[F.lit(m) for m in R.MARKETS])).alias("market_code"), DAY)
    expected = panel.expected_days(d.life, all_markets).withColumnRenamed(DAY, "business_date")
    existing = d.daily.withColumnRenamed(DAY, "business_date")
    return calendar.missing_ranges(expected, existing, R.KEY)


@query(
    "c8_quarter_ranges",
    """b AS (SELECT o_custkey, min(o_orderdate)::DATE AS s, max(o_orderdate)::DATE AS e FROM orders GROUP BY 1),
    q AS (SELECT *, unnest(generate_series(date_trunc('quarter', s)::DATE, e, INTERVAL 3 MONTH))::DATE AS q FROM b)
    SELECT o_custkey, greatest(s, q) AS range_start, least(e, (q + INTERVAL 3 MONTH)::DATE - 1) AS range_end, year(q) || 'Q' || quarter(q) AS quarter FROM q""",
)
def c8(d: Domain):
    day = F.col("o_orderdate").cast("date")
    bounds = d.table("orders").groupBy("o_custkey").agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    return calendar.quarter_ranges(bounds)


@query(
    "c9_interval_days",
    """SELECT market_code, security_code, unnest(generate_series(listed_date, coalesce(delisted_date, listed_date), INTERVAL 1 DAY))::DATE AS business_date FROM sec""",
)
def c9(d: Domain):
    return calendar.interval_days(d.life, "listed_date", "delisted_date").select(*R.KEY, "business_date")


@query(
    "c10_monthly_to_daily",
    """snap AS (SELECT biz_date AS sd, stk_code, B01 AS g FROM wide WHERE isodow(biz_date) = 7 OR biz_date = DATE '2024-01-01'),
    bd AS (SELECT max(sd) AS sd, b FROM (SELECT DISTINCT sd, (SELECT max(t.d) FROM tdays t WHERE t.d <= sd) AS b FROM snap) GROUP BY b),
    act AS (SELECT t.d, coalesce((SELECT max(sd) FROM bd WHERE bd.b < t.d), (SELECT sd FROM bd WHERE bd.b = t.d AND bd.b = (SELECT min(b) FROM bd))) AS sd FROM tdays t)
    SELECT a.d AS trading_date, a.sd AS snapshot_date, s.stk_code, CASE WHEN s.g = '' THEN 'G' ELSE s.g END AS grade FROM act a JOIN snap s ON s.sd = a.sd""",
)
def c10(d: Domain):
    sunday = F.dayofweek("biz_date") == 1
    sections = d.wide.where(sunday | (F.col("biz_date") == F.lit(date(2024, 1, 1)))).select(
        F.col("biz_date").alias("snapshot_date"), "stk_code", F.col("B01").alias("grade")
    )
    cal = d.calendar.where(F.col("market_code") == "XSHG")
    return calendar.monthly_to_daily(sections, cal, date(2024, 1, 1), END)


@query(
    "c11_uncovered_days",
    "SELECT t.d AS trading_date FROM tdays t ANTI JOIN (SELECT DISTINCT d FROM ev WHERE event_type = 'click' AND amt >= 250) h ON h.d = t.d",
)
def c11(d: Domain):
    large = d.events.where((F.col("event_type") == "click") & (F.col("amt") >= 250)).select(F.col("d").alias("classification_date"))
    one = d.days.where(F.col("market_code") == "XSHG").select(DAY)
    return calendar.uncovered_days(one, large)


# --- joins ------------------------------------------------------------------
@query("j1_expected_security_days", "SELECT market_code, security_code, d AS trading_date, ord::INTEGER AS ordinal FROM life_days")
def j1(d: Domain):
    return panel.expected_days(d.life, d.days).select(*R.KEY, DAY, "ordinal")


@query("j2_calendar_fallback", f"SELECT market_code, d AS trading_date FROM tdays CROSS JOIN {MARKETS3}")
def j2(d: Domain):
    return d.days


@query("j3_board_as_of", "SELECT market_code, security_code, d AS trading_date, board_code FROM panel")
def j3(d: Domain):
    return d.panel.select(*R.KEY, DAY, "board_code")


@query(
    "j7_adjusted_price_join",
    """SELECT s.market_code, s.security_code, s.d AS trading_date, s.is_st, y.close_price::DOUBLE AS adjusted_close FROM st_known s
    LEFT JOIN daily y ON y.security_code = s.security_code AND y.d = s.d""",
)
def j7(d: Domain):
    return dbl(store.attach_adjusted_prices(d.st_known, d.daily))


@query(
    "j8_missing_facts",
    """SELECT 'MDFRQ018' AS rule_id, 'daily_price_unadjusted' AS dataset_id, market_code, market_code || '|' || security_code || '|' || d::VARCHAR AS issue_key
    FROM life_days l ANTI JOIN daily y ON y.security_code = l.security_code AND y.d = l.d""",
)
def j8(d: Domain):
    return foundation.missing_expected(
        panel.expected_days(d.life, d.days), d.daily, "MDFRQ018", "daily_price_unadjusted"
    )


@query(
    "j9_null_safe_match",
    """m AS (SELECT security_code, market_code, min(d) AS listed_date, CASE WHEN user_id % 7 = 0 THEN (min(d) + 21)::DATE END AS delisted_date
      FROM ev WHERE event_type <> 'view' GROUP BY user_id, security_code, market_code)
    SELECT 'MISSING_OR_MISMATCH|' || s.security_code AS issue_key FROM sec s ANTI JOIN m ON m.security_code = s.security_code AND m.listed_date = s.listed_date
      AND m.delisted_date IS NOT DISTINCT FROM s.delisted_date
    UNION ALL SELECT 'EXTRA|' || m.security_code FROM m ANTI JOIN sec s ON s.security_code = m.security_code""",
)
def j9(d: Domain):
    found = foundation.master_matches_universe(
        d.life, _other_life(d), ("market_code", "listed_date", "delisted_date")
    )
    return found.select("issue_key")


def _other_life(d: Domain):
    """A second lifecycle source that ignores view events, so some listing dates differ."""
    return (
        d.events.where(F.col("event_type") != "view")
        .groupBy("user_id", *R.KEY)
        .agg(F.min("d").alias("listed_date"))
        .select(*R.KEY, "listed_date", F.when(F.col("user_id") % 7 == 0, F.date_add("listed_date", 21)).alias("delisted_date"))
    )


def _limits(d: Domain):
    return d.daily.where("has_error").select(
        *R.KEY,
        DAY,
        (F.col("close_price") * F.lit("1.1").cast("decimal(3,1)")).cast("decimal(20,6)").alias("limit_up_price"),
        F.col("close_price").alias("limit_down_price"),
    )


def _suspension(d: Domain):
    """Suspension rows on every lifecycle session: quiet sessions are suspended."""
    grid = panel.expected_days(d.life, d.days).select(*R.KEY, DAY, "ordinal")
    merged = panel.stack_by_day({"g": grid, "t": d.daily.select(*R.KEY, DAY, "n")}).where(F.col("g").isNotNull())
    return merged.select(*R.KEY, DAY, F.col("t").isNull().alias("is_suspended"))


SUSP_SQL = """limits AS (SELECT market_code, security_code, d, (close_price * 1.1)::DECIMAL(20,6) AS limit_up_price, close_price AS limit_down_price FROM daily WHERE has_error),
    susp AS (SELECT l.market_code, l.security_code, l.d, y.n IS NULL AS is_suspended FROM life_days l LEFT JOIN daily y ON y.security_code = l.security_code AND y.d = l.d)"""


@query(
    "j10_market_daily_assembly",
    SUSP_SQL
    + """, k AS (SELECT security_code, d FROM daily UNION SELECT security_code, d FROM susp WHERE is_suspended)
    SELECT split_part(k.security_code, '.', 2) AS market_code, k.security_code, k.d AS trading_date,
      CASE WHEN coalesce(s.is_suspended, false) THEN '停牌' ELSE '正常成交' END AS trading_status, y.close_price::DOUBLE AS close_price,
      l.limit_up_price::DOUBLE AS limit_up_price, l.limit_down_price::DOUBLE AS limit_down_price,
      last_value(y.close_price IGNORE NULLS) OVER (PARTITION BY k.security_code ORDER BY k.d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::DOUBLE AS previous_close
    FROM k LEFT JOIN daily y USING (security_code, d) LEFT JOIN limits l USING (security_code, d) LEFT JOIN susp s USING (security_code, d)""",
)
def j10(d: Domain):
    return dbl(panel.assemble_market_daily(d.daily, _limits(d), _suspension(d)))


@query(
    "j11_typed_three_way",
    SUSP_SQL
    + """ SELECT y.market_code || '|' || y.security_code || '|' || y.d::VARCHAR AS business_key, y.close_price::DOUBLE AS close_price, l.limit_up_price::DOUBLE AS limit_up_price,
      l.limit_down_price::DOUBLE AS limit_down_price, s.is_suspended, s.is_suspended IS NOT NULL AS is_complete
    FROM daily y LEFT JOIN limits l USING (security_code, d) LEFT JOIN susp s USING (security_code, d)""",
)
def j11(d: Domain):
    keyed = lambda df: df.withColumn("business_key", S.event_key(*R.KEY, DAY))
    prices = keyed(d.daily).select("business_key", "close_price")
    return dbl(panel.typed_three_way(prices, keyed(_limits(d)), keyed(_suspension(d))))


@query(
    "j17_master_supplement",
    """base AS (SELECT market_code, security_code, status_date, board_code, listed_date, delisted_date FROM master WHERE status_date <= DATE '2024-01-02')
    SELECT market_code, security_code, status_date, board_code, listed_date, delisted_date, NULL AS trading_eligibility_status FROM base
    UNION ALL SELECT market_code, security_code, DATE '2024-01-30', board_code, listed_date, delisted_date,
      CASE WHEN delisted_date <= DATE '2024-01-30' THEN '终止' ELSE '正常' END FROM sec s
    WHERE security_code IN (SELECT security_code FROM wide) AND security_code NOT IN (SELECT security_code FROM base)""",
)
def j17(d: Domain):
    base = d.master.where(F.col("status_date") <= F.lit(date(2024, 1, 2)))
    stored = d.securities.select(
        *R.KEY, "board_code", F.col("listed_date").alias("listing_date"), F.col("delisted_date").alias("termination_date")
    )
    requested = d.wide.select(
        S.security_market("stk_code", CODE_DIGITS).alias("market_code"),
        S.canonical_security("stk_code", CODE_DIGITS).alias("security_code"),
    )
    return store.supplement_master(base, requested, stored, END)


OTHER_SQL = """other AS (SELECT security_code, market_code, min(d) AS listed_date, CASE WHEN user_id % 7 = 0 THEN (min(d) + 21)::DATE END AS delisted_date
      FROM ev WHERE event_type <> 'view' GROUP BY user_id, security_code, market_code)"""


@query(
    "j18_lifecycle_supplement",
    OTHER_SQL
    + """, s AS (SELECT * FROM sec WHERE listed_date <= DATE '2024-01-02'), r AS (SELECT * FROM other WHERE market_code <> 'XBSE')
    SELECT coalesce(s.market_code, r.market_code) AS market_code, coalesce(s.security_code, r.security_code) AS security_code,
      CASE WHEN s.security_code IS NULL THEN r.listed_date ELSE s.listed_date END AS listed_date,
      CASE WHEN s.security_code IS NULL THEN r.delisted_date ELSE s.delisted_date END AS delisted_date,
      CASE WHEN s.security_code IS NULL THEN 'SUPPLEMENTED' WHEN r.security_code IS NOT NULL AND (s.listed_date, s.delisted_date) IS DISTINCT FROM (r.listed_date, r.delisted_date)
        THEN 'CONFLICT' ELSE 'SNAPSHOT' END AS origin
    FROM s FULL JOIN r ON r.security_code = s.security_code""",
)
def j18(d: Domain):
    snapshot = d.life.where(F.col("listed_date") <= F.lit(date(2024, 1, 2)))
    return store.supplement_lifecycle(snapshot, _other_life(d))


@query(
    "j22_lifecycle_reference",
    OTHER_SQL
    + """ SELECT coalesce(m.market_code, o.market_code) AS market_code, coalesce(m.security_code, o.security_code) AS security_code,
      CASE WHEN m.security_code IS NULL THEN o.listed_date ELSE m.listed_date END AS listed_date, CASE WHEN m.security_code IS NULL THEN o.delisted_date ELSE m.delisted_date END AS delisted_date
    FROM (SELECT DISTINCT market_code, security_code, listed_date, delisted_date FROM master WHERE listed_date <= DATE '2024-01-02') m FULL JOIN other o ON o.security_code = m.security_code""",
)
def j22(d: Domain):
    effective = d.master.where(F.col("listed_date") <= F.lit(date(2024, 1, 2))).withColumnRenamed("status_date", "effective_start")
    return store.lifecycle_reference(_other_life(d), effective)


@query(
    "j19_history_st_reconciliation",
    """h AS (SELECT DISTINCT security_code FROM wide WHERE isodow(biz_date) < 6 AND B01 <> 'A'), s AS (SELECT DISTINCT security_code FROM ev WHERE event_type = 'signup' AND amt >= 100)
    SELECT CASE WHEN l.security_code IS NULL THEN 'BM204_LIFECYCLE_EVIDENCE_MISSING' WHEN h AND o THEN 'BM203_ST_STATUS_MISSING' WHEN h THEN 'BM108_HISTORY_ONLY_SECURITY_OUTSIDE_OBSERVATION'
      WHEN o THEN 'BM109_SECURITY_HISTORY_MISSING' ELSE 'BM107_ST_ONLY_SECURITY_OUTSIDE_OBSERVATION' END AS code,
      CASE WHEN l.security_code IS NULL OR (h AND o) THEN 'ERROR' WHEN NOT h AND o THEN 'WARNING' ELSE 'INFO' END AS severity, split_part(x.security_code, '.', 2) AS market_code, x.security_code
    FROM (SELECT security_code, true AS h FROM h ANTI JOIN s USING (security_code) UNION ALL SELECT security_code, false FROM s ANTI JOIN h USING (security_code)) x
    LEFT JOIN (SELECT *, listed_date <= DATE '2024-01-30' AND (delisted_date IS NULL OR delisted_date >= DATE '2024-01-24') AS o FROM sec WHERE listed_date < DATE '2024-01-10') l ON l.security_code = x.security_code""",
)
def j19(d: Domain):
    history = d.cells.where(F.get("grades", F.lit(0)) != "A")
    st = d.events.where((F.col("event_type") == "signup") & (F.col("amt") >= 100))
    known = d.life.where(F.col("listed_date") < F.lit(date(2024, 1, 10)))
    return quality.history_st_reconciliation(history, st, known, date(2024, 1, 24), END)


@query(
    "j20_missing_board_requests",
    """c AS (SELECT l.market_code, l.security_code, l.d FROM life_days l JOIN daily y ON y.security_code = l.security_code AND y.d = l.d
        LEFT JOIN st_known k ON k.security_code = l.security_code AND k.d = l.d WHERE y.has_error AND NOT coalesce(k.is_st, false) AND l.market_code <> 'XBSE'),
    b AS (SELECT security_code, min(status_date) AS f FROM master WHERE status_date > listed_date GROUP BY 1)
    SELECT c.market_code, c.security_code, min(c.d) AS request_date FROM c LEFT JOIN b USING (security_code) WHERE b.f IS NULL OR b.f > c.d GROUP BY 1, 2""",
)
def j20(d: Domain):
    late = d.master.where(F.col("status_date") > F.col("listed_date"))
    return gate.missing_board_requests(gate.candidate_days(d.market, d.risk_status, securities=d.life), late)


# --- carried state ----------------------------------------------------------
@query("w9_st_forward_fill", "SELECT market_code, security_code, d AS trading_date, is_st FROM st_known")
def w9(d: Domain):
    return d.st_known


@query(
    "w14_previous_known_close",
    """SELECT * FROM (SELECT market_code, security_code, d AS trading_date, close_price::DOUBLE AS close_price,
      lag(close_price) OVER (PARTITION BY security_code ORDER BY d)::DOUBLE AS previous_close FROM daily) WHERE trading_date >= DATE '2024-01-08'""",
)
def w14(d: Domain):
    return dbl(panel.previous_known_close(d.daily.select(*R.KEY, DAY, "close_price"), START))


PRICES_SQL = """prices AS (SELECT y.market_code, y.security_code, y.d, y.close_price, y.low_amt, y.high_amt, y.amount,
      (SELECT p.close_price FROM daily p JOIN tdays tp ON tp.d = p.d WHERE p.security_code = y.security_code AND tp.ord = t.ord - 1) AS previous_close
      FROM daily y JOIN tdays t ON t.d = y.d)"""


def session_prices(d: Domain):
    """Session rows with the close of exactly the previous session."""
    rows = d.daily.select(*R.KEY, DAY, "close_price", "low_amt", "high_amt", "amount")
    return panel.previous_session_close(rows, d.index)


@query(
    "w15_previous_session_close",
    PRICES_SQL + " SELECT market_code, security_code, d AS trading_date, close_price::DOUBLE AS close_price, previous_close::DOUBLE AS previous_close FROM prices",
)
def w15(d: Domain):
    return dbl(session_prices(d).select(*R.KEY, DAY, "close_price", "previous_close"))


@query(
    "w16_effective_ranges",
    """SELECT market_code, security_code, status_date AS effective_start, board_code,
    (lead(status_date) OVER (PARTITION BY security_code ORDER BY status_date) - 1)::DATE AS effective_end FROM master""",
)
def w16(d: Domain):
    return store.effective_ranges(
        d.master.select(*R.KEY, F.col("status_date").alias("effective_start"), "board_code")
    )


@query(
    "w17_close_and_open",
    OTHER_SQL
    + """, st AS (SELECT *, (lead(status_date) OVER (PARTITION BY security_code ORDER BY status_date) - 1)::DATE AS eend FROM master WHERE status_date < DATE '2024-01-15'),
    old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY security_code ORDER BY status_date DESC) AS rn FROM st) WHERE rn = 1),
    inc AS (SELECT o.market_code, o.security_code, o.listed_date, o.delisted_date, s.board_code FROM other o JOIN sec s USING (security_code)),
    j AS (SELECT i.market_code, i.security_code, i.board_code AS nb, i.listed_date AS nl, i.delisted_date AS nt, o.board_code AS ob, o.listed_date AS ol, o.delisted_date AS ot,
      o.status_date AS os, o.eend AS oe, o.security_code IS NOT NULL AS k FROM inc i LEFT JOIN old o USING (security_code)),
    c AS (SELECT *, CASE WHEN NOT k THEN 'UNKNOWN_SECURITY' WHEN ol IS DISTINCT FROM nl THEN 'LISTING_DATE_CHANGED' WHEN ob IS DISTINCT FROM nb THEN 'BOARD_CHANGED' END AS conflict FROM j)
    SELECT market_code, security_code, conflict AS action, nb AS board_code, nt AS termination_date, os AS effective_start, oe AS effective_end FROM c WHERE conflict IS NOT NULL
    UNION ALL SELECT market_code, security_code, 'TERMINATED', ob, nt, os, (nt - 1)::DATE FROM c WHERE conflict IS NULL AND nt <= DATE '2024-01-15' AND ot IS DISTINCT FROM nt
    UNION ALL SELECT market_code, security_code, 'CLOSED', ob, ot, os, DATE '2024-01-14' FROM c WHERE conflict IS NULL AND coalesce(nt > DATE '2024-01-15', true) AND coalesce(oe >= DATE '2024-01-15', true)
    UNION ALL SELECT market_code, security_code, 'OPENED', nb, nt, DATE '2024-01-15', (nt - 1)::DATE FROM c WHERE conflict IS NULL AND coalesce(nt > DATE '2024-01-15', true)""",
)
def w17(d: Domain):
    day = date(2024, 1, 15)
    ranges = store.effective_ranges(
        d.master.where(F.col("status_date") < F.lit(day)).select(
            *R.KEY,
            F.col("status_date").alias("effective_start"),
            "board_code",
            F.col("listed_date").alias("listing_date"),
            F.col("delisted_date").alias("termination_date"),
        )
    )
    incoming = _other_life(d).join(d.securities.select(*R.KEY, "board_code"), list(R.KEY)).select(
        *R.KEY, "board_code", F.col("listed_date").alias("listing_date"), F.col("delisted_date").alias("termination_date")
    )
    return store.close_and_open(ranges, incoming, day)


@query(
    "r7_latest_per_group",
    """SELECT market_code, security_code, arg_max(close_price, d)::DOUBLE AS previous_close, max(d) AS price_date FROM daily WHERE d < DATE '2024-01-08' GROUP BY 1, 2""",
)
def r7(d: Domain):
    return dbl(store.previous_close_seed(d.daily, START))


@query(
    "q13_risk_input_gate",
    """cov AS (SELECT p.market_code, p.security_code, p.d, p.n, p.is_st, y.n AS seen, p.listed_date,
        row_number() OVER (PARTITION BY p.security_code ORDER BY p.d) AS rn FROM panel p LEFT JOIN daily y ON y.security_code = p.security_code AND y.d = p.d),
    prior AS (SELECT DISTINCT c.security_code FROM st_changes c JOIN st_grid g ON g.security_code = c.security_code AND g.d = c.d WHERE c.d < DATE '2024-01-08')
    SELECT 'RISK_GATE_UNIVERSE_MARKET_COVERAGE_MISSING' AS code, market_code, security_code, d AS fact_date FROM cov WHERE seen IS NULL
    UNION ALL SELECT 'RISK_GATE_UNIVERSE_ST_COVERAGE_MISSING', c.market_code, c.security_code, c.d FROM cov c
      LEFT JOIN st_changes k ON k.security_code = c.security_code AND k.d = c.d WHERE k.d IS NULL
    UNION ALL SELECT 'RISK_GATE_ST_BASELINE_MISSING', c.market_code, c.security_code, NULL FROM cov c
      LEFT JOIN prior x ON x.security_code = c.security_code LEFT JOIN st_changes k ON k.security_code = c.security_code AND k.d = c.d
      WHERE rn = 1 AND CASE WHEN listed_date >= DATE '2024-01-08' THEN k.d IS NULL ELSE x.security_code IS NULL END""",
)
def q13(d: Domain):
    """Gate on sparse inputs (event days only), so that the coverage rules have something to find."""
    sparse = d.daily.select(
        *R.KEY,
        DAY,
        F.lit("TRADED").alias("trading_status"),
        "close_price",
        F.lit(None).cast("decimal(20,6)").alias("limit_down_price"),
        F.col("last_id").cast("string").alias("source_record_id"),
    )
    grid_days = panel.expected_days(
        d.life.withColumn("delisted_date", F.date_add("delisted_date", 1)), d.days
    ).select(*R.KEY, DAY)
    status = d.st_changes.join(grid_days, [*R.KEY, DAY], "left_semi").select(
        *R.KEY,
        F.lit("ST").alias("risk_status_type"),
        F.col("is_st").cast("string").alias("risk_status_value"),
        F.col(DAY).alias("status_start_date"),
        F.lit("x").alias("source_record_id"),
    )
    broker = d.securities.select(*R.KEY, F.lit(END).alias("classification_date"))
    tables = {"broker": broker, "master": d.master, "calendar": d.calendar, "market": sparse, "st": status}
    return gate.gate_findings(tables, d.days, RULES).select("code", *R.KEY, "fact_date")


@query(
    "g13_return_price_quality",
    PRICES_SQL
    + """, p AS (SELECT *, CASE WHEN day(d) % 5 = 0 THEN 2 ELSE 1 END AS k, previous_close > 0 AND close_price >= 0 AS valid FROM prices)
    SELECT sum(k)::BIGINT AS source_row_count, sum(k)::BIGINT AS normal_row_count, count(*) FILTER (WHERE valid) AS valid_return_row_count,
      coalesce(sum(k) FILTER (WHERE valid IS NOT TRUE), 0)::BIGINT AS invalid_price_row_count, coalesce(sum(k - 1) FILTER (WHERE valid), 0)::BIGINT AS duplicate_row_count,
      count(*) FILTER (WHERE valid AND abs(close_price - previous_close) > 0.3 * previous_close) AS extreme_return_count FROM p""",
)
def g13(d: Domain):
    """Session prices, those of every fifth calendar day twice."""
    prices = session_prices(d).withColumn("trading_status", F.lit("TRADED"))
    return grades.price_quality(prices.unionByName(prices.where(F.day(DAY) % 5 == 0)))


@query(
    "g25_return_findings",
    PRICES_SQL
    + """, p AS (SELECT *, day(d) % 5 = 0 AS twice, previous_close > 0 AND close_price >= 0 AS valid FROM prices)
    SELECT 'BM502' AS code, market_code, security_code, d AS fact_date FROM p WHERE valid AND twice
    UNION ALL SELECT 'BM503', market_code, security_code, d FROM p WHERE valid AND abs(close_price - previous_close) > 0.3 * previous_close""",
)
def g25_returns(d: Domain):
    prices = session_prices(d).withColumn("trading_status", F.lit("TRADED"))
    return grades.return_findings(prices.unionByName(prices.where(F.day(DAY) % 5 == 0)))
