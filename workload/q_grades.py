"""Queries on per-grade statistics, returns and model comparison."""

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import assess, compare, grades, metrics, panel, ranking
from earlybell.operators.panel import DAY
from workload.domain import BROKERS, END, MAPPING, START, Domain
from workload.q_assess import GRADE, RANK_SQL, SUMMARY_SQL, _summary, dbl
from workload.q_calendar import PRICES_SQL, session_prices
from workload.registry import half_up, query

BUCKETS = "(SELECT unnest(['A','B','C','D','E','F','G','BLANK','UNKNOWN']) AS classification)"


def _pressure_detail(d: Domain, broker: str):
    own = d.stored_pressure_assessments.where(F.col("broker_id") == broker)
    return grades.pressure_detail(d.stored_pressure, own)


PRESS_SQL = f"""pa AS (SELECT p.*, r.broker_id, {GRADE.format(r="r.raw", s="r.sel_d")} AS classification,
      p.market_code || '|' || p.security_code || '|NON_ST_LIMIT_DOWN_PRESSURE_OBSERVATION|' || p.first_d::VARCHAR AS event_key
      FROM press p JOIN tdays t ON t.d = p.first_d JOIN bruns r ON r.security_code = p.security_code AND r.d = t.prev_d)"""


def press_summary(broker: str, name: str) -> str:
    return f"""{name}0 AS (SELECT classification, count(*) AS n, count(DISTINCT security_code) AS s, count(*) FILTER (WHERE upgraded) AS u, sum(len)::BIGINT AS ld
        FROM pa WHERE broker_id = '{broker}' GROUP BY 1),
      {name} AS (SELECT b.classification, coalesce(n, 0) AS observation_frequency, coalesce(s, 0) AS distinct_security_count, coalesce(u, 0) AS upgraded_event_count,
        coalesce(ld, 0) AS total_limit_down_days, {half_up("coalesce(u,0)", "coalesce(n,0)")} AS upgrade_rate, {half_up("coalesce(ld,0)", "coalesce(n,0)")} AS average_limit_down_days,
        CASE WHEN n > 0 THEN dense_rank() OVER (ORDER BY coalesce(n, 0) DESC) END::INTEGER AS frequency_rank,
        {half_up("coalesce(n,0)", f"(SELECT coalesce(sum(n), 0)::BIGINT FROM {name}0)")} AS event_share FROM {BUCKETS} b LEFT JOIN {name}0 USING (classification))"""


@query("g8_pressure_grade_summary", PRESS_SQL + "," + press_summary("B03", "ps") + " SELECT * FROM ps")
def g8(d: Domain):
    return dbl(grades.pressure_grade_summary(_pressure_detail(d, "B03")))


@query(
    "g8_pressure_totals",
    PRESS_SQL
    + f""" SELECT count(*) AS observation_count, count(DISTINCT security_code) AS distinct_security_count, count(*) FILTER (WHERE upgraded) AS upgraded_event_count,
      count(DISTINCT security_code) FILTER (WHERE upgraded) AS upgraded_security_count, count(*) FILTER (WHERE open_end) AS open_event_count,
      count(*) FILTER (WHERE classification = 'BLANK') AS blank_event_count, count(*) FILTER (WHERE classification = 'UNKNOWN') AS unknown_event_count,
      {half_up("count(*) FILTER (WHERE upgraded)", "count(*)")} AS upgrade_rate FROM pa WHERE broker_id = 'B03'""",
)
def g8b(d: Domain):
    return dbl(grades.pressure_totals(_pressure_detail(d, "B03")))


@query(
    "j6_one_to_one_check",
    """lk AS (SELECT security_code || '|' || first_d::VARCHAR AS k FROM press), rk AS (SELECT security_code || '|' || first_fact_date::VARCHAR AS k FROM risk_ev)
    SELECT coalesce(l.k, r.k) AS event_key, CASE WHEN ln > 1 THEN 'LEFT_KEY_DUPLICATE' WHEN rn > 1 THEN 'RIGHT_KEY_DUPLICATE' ELSE 'PARTNER_MISSING' END AS finding
    FROM (SELECT k, count(*) AS ln FROM lk GROUP BY 1) l FULL JOIN (SELECT k, count(*) AS rn FROM rk GROUP BY 1) r ON r.k = l.k
    WHERE ln > 1 OR rn > 1 OR (ln = 1 AND rn IS NULL)""",
)
def j6(d: Domain):
    short = lambda df: df.select(S.event_key("security_code", "first_fact_date").alias("event_key"))
    return grades.one_to_one_findings(short(d.stored_pressure), short(d.stored_events))


def event_summary_sql(broker: str, name: str) -> str:
    g = GRADE.format(r="raw", s="sel_d")
    return f"""{name}d AS (SELECT a.*, e.consecutive_length, {g} AS classification FROM assess a
        JOIN risk_ev e ON e.security_code = a.security_code AND e.event_type = a.event_type AND e.first_fact_date = a.first_fact_date
        WHERE a.broker_id = '{broker}' AND a.event_type = 'NON_ST_CONTINUOUS_LIMIT_DOWN'),
      {name}0 AS (SELECT classification, count(*) AS n, count(DISTINCT security_code) AS s, sum(consecutive_length)::BIGINT AS ld, count(wdays) AS w, sum(wdays)::BIGINT AS ws FROM {name}d GROUP BY 1),
      {name} AS (SELECT b.classification, coalesce(n, 0) AS event_frequency, coalesce(s, 0) AS distinct_security_count, coalesce(ld, 0) AS total_limit_down_days,
        coalesce(w, 0) AS defined_warning_days_count, {half_up("coalesce(ld,0)", "coalesce(n,0)")} AS average_limit_down_days,
        {half_up("coalesce(ws,0)", "coalesce(w,0)")} AS average_warning_days,
        CASE WHEN b.classification IN ('F','G') THEN coalesce(n, 0) WHEN b.classification <> 'UNKNOWN' THEN 0 END AS intercept_event_count,
        CASE WHEN n > 0 THEN dense_rank() OVER (ORDER BY coalesce(n, 0) DESC) END::INTEGER AS frequency_rank,
        {half_up("coalesce(n,0)", f"(SELECT coalesce(sum(n), 0)::BIGINT FROM {name}0)")} AS event_share FROM {BUCKETS} b LEFT JOIN {name}0 USING (classification))"""


def _event_detail(d: Domain, broker: str):
    return grades.event_detail(d.stored_events, d.stored_assessments, broker, R.LIMIT_DOWN_EVENT)


@query("g9_event_grade_summary", event_summary_sql("B03", "es") + " SELECT * FROM es")
def g9(d: Domain):
    return dbl(grades.event_grade_summary(_event_detail(d, "B03")))


@query(
    "g9_event_totals",
    event_summary_sql("B03", "es")
    + f""", c AS (SELECT *, classification IN ('F','G') AS f FROM esd)
    SELECT count(*) AS event_count, count(DISTINCT security_code) AS distinct_security_count, count(*) FILTER (WHERE f) AS intercept_event_count,
      count(DISTINCT security_code) FILTER (WHERE f) AS intercept_security_count, count(wdays) FILTER (WHERE f) AS warning_days_count,
      min(wdays) FILTER (WHERE f) AS warning_days_min, max(wdays) FILTER (WHERE f) AS warning_days_max, median(wdays) FILTER (WHERE f)::DOUBLE AS warning_days_median,
      {half_up("count(*) FILTER (WHERE f)", "count(*)")} AS coverage_rate, {half_up("coalesce(sum(wdays) FILTER (WHERE f), 0)", "count(wdays) FILTER (WHERE f)")} AS warning_days_mean FROM c""",
)
def g9b(d: Domain):
    return dbl(grades.event_totals(_event_detail(d, "B03")))


@query(
    "g10_threshold_comparison",
    ",".join([PRESS_SQL, press_summary("B03", "ln"), press_summary("B01", "lo"), event_summary_sql("B03", "sn"), event_summary_sql("B01", "so")])
    + """ SELECT classification, sn.event_frequency AS strict_new_frequency, sn.event_share AS strict_new_share, so.event_frequency AS strict_old_frequency, so.event_share AS strict_old_share,
      ln.observation_frequency AS loose_new_frequency, ln.event_share AS loose_new_share, ln.upgraded_event_count AS loose_new_upgrade_count, ln.upgrade_rate AS loose_new_upgrade_rate,
      lo.observation_frequency AS loose_old_frequency, lo.event_share AS loose_old_share, lo.upgraded_event_count AS loose_old_upgrade_count, lo.upgrade_rate AS loose_old_upgrade_rate,
      sn.event_frequency - so.event_frequency AS strict_frequency_delta, round(sn.event_share - so.event_share, 6) AS strict_share_delta,
      ln.observation_frequency - lo.observation_frequency AS loose_frequency_delta, round(ln.event_share - lo.event_share, 6) AS loose_share_delta,
      round(ln.upgrade_rate - lo.upgrade_rate, 6) AS loose_upgrade_rate_delta
    FROM sn JOIN so USING (classification) JOIN ln USING (classification) JOIN lo USING (classification)""",
)
def g10(d: Domain):
    return dbl(
        grades.threshold_comparison(
            grades.event_grade_summary(_event_detail(d, "B03")),
            grades.event_grade_summary(_event_detail(d, "B01")),
            grades.pressure_grade_summary(_pressure_detail(d, "B03")),
            grades.pressure_grade_summary(_pressure_detail(d, "B01")),
        )
    )


# --- returns ----------------------------------------------------------------
def _returns(d: Domain):
    return grades.simple_returns(session_prices(d).withColumn("trading_status", F.lit("TRADED")))


def _daily_returns(d: Domain):
    return grades.grade_returns_daily(d.eligible, d.days, (START, END), d.cells, _returns(d), BROKERS)


RET_SQL = (
    PRICES_SQL
    + f""", lagged AS (SELECT a.security_code, a.broker_id, a.d, lag(a.raw) OVER (PARTITION BY a.security_code, a.broker_id ORDER BY a.d) AS raw, a.listed_date, a.delisted_date FROM act_rows a),
    rr AS (SELECT l.broker_id, l.raw, l.d, p.close_price::DOUBLE / p.previous_close::DOUBLE - 1 AS r FROM lagged l JOIN eligible e USING (security_code)
      LEFT JOIN prices p ON p.security_code = l.security_code AND p.d = l.d
      WHERE l.raw <> '' AND l.d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30' AND l.d >= l.listed_date AND (l.delisted_date IS NULL OR l.d < l.delisted_date)),
    rd AS (SELECT broker_id, raw AS raw_classification, d AS return_date, count(*) AS classified_security_count, count(r) AS valid_return_security_count, avg(r) AS ret, sum(r) AS rs,
      count(*) FILTER (WHERE r > 0) AS positive_return_security_count, {half_up("count(r)", "count(*)", 10)} AS return_coverage_rate,
      {half_up("count(*) FILTER (WHERE r > 0)", "count(r)", 10)} AS positive_return_rate FROM rr GROUP BY 1, 2, 3)"""
)


@query(
    "g11_grade_daily_returns",
    RET_SQL
    + """ SELECT broker_id, raw_classification, return_date, classified_security_count, valid_return_security_count, round(ret, 8) AS equal_weight_daily_return,
    positive_return_security_count, return_coverage_rate, positive_return_rate FROM rd""",
)
def g11(d: Domain):
    return dbl(_daily_returns(d).withColumn("equal_weight_daily_return", F.round("daily_return", 8)).drop("return_sum", "daily_return"))


@query(
    "g12_grade_return_summary",
    RET_SQL
    + f""" SELECT broker_id, raw_classification, min(return_date) AS return_start_date, max(return_date) AS return_end_date, count(*) AS classified_trading_day_count,
      count(ret) AS valid_return_trading_day_count, sum(classified_security_count)::BIGINT AS classified_stock_day_count, sum(valid_return_security_count)::BIGINT AS valid_return_stock_day_count,
      sum(positive_return_security_count)::BIGINT AS positive_return_stock_day_count, {half_up("sum(valid_return_security_count)", "sum(classified_security_count)", 10)} AS return_coverage_rate,
      round(avg(ret), 6) AS mean_equal_weight_daily_return, round(log10(product(1 + ret)), 6) AS compounded_log10,
      round(sum(rs) / nullif(sum(valid_return_security_count), 0)::DOUBLE, 6) AS stock_day_weighted_mean_return,
      {half_up("sum(positive_return_security_count)", "sum(valid_return_security_count)", 10)} AS positive_return_rate FROM rd GROUP BY 1, 2""",
)
def g12(d: Domain):
    summary = grades.grade_return_summary(_daily_returns(d))
    return dbl(
        summary.withColumn("compounded_log10", F.round(F.log10(F.col("compounded_equal_weight_return") + 1), 6))
        .withColumn("mean_equal_weight_daily_return", F.round("mean_equal_weight_daily_return", 6))
        .withColumn("stock_day_weighted_mean_return", F.round("stock_day_weighted_mean_return", 6))
        .drop("compounded_equal_weight_return")
    )


@query(
    "g25_return_input_findings",
    RET_SQL
    + """ SELECT 'BM504_BROKER_RETURN_CLASSIFICATION_EMPTY' AS code, 'INFO' AS severity, b.broker_id FROM (SELECT unnest(['B01','B02','B03','B09']) AS broker_id) b WHERE b.broker_id NOT IN (SELECT broker_id FROM rd)
    UNION ALL SELECT 'BM505_GRADE_RETURN_INPUT_NOT_POST_ADJUSTED', 'WARNING', NULL""",
)
def g25_inputs(d: Domain):
    """Returns of unadjusted closes, asked for one broker more than has a history."""
    return grades.return_input_findings(grades.grade_return_summary(_daily_returns(d)), (*BROKERS, "B09"), "UNADJUSTED")


@query(
    "g27_ranked_overview",
    SUMMARY_SQL
    + RANK_SQL
    + ", "
    + RET_SQL
    + """, best AS (SELECT *, CASE WHEN composite_score IS NOT NULL THEN rank() OVER (PARTITION BY event_type_view ORDER BY composite_score DESC NULLS LAST) END::INTEGER AS composite_rank FROM sc),
    g AS (SELECT broker_id, raw_classification, count(ret) AS valid_return_trading_day_count, sum(valid_return_security_count)::BIGINT AS valid_return_stock_day_count, round(log10(product(1 + ret)), 6) AS compounded_log10 FROM rd GROUP BY 1, 2),
    t AS (SELECT sum(hit_event_count)::BIGINT AS total_hit_events, sum(defined_sample_count)::BIGINT AS total_defined_warnings, sum(identified_days_unknown_count)::BIGINT AS total_unknown_warnings FROM summ WHERE event_type_view = 'ALL_RISK_EVENTS')
    SELECT b.broker_id, s.event_hit_rate, b.event_hit_rate_rank, b.warning_rate_rank, b.composite_score, b.composite_rank, CASE WHEN b.cnt = 3 THEN 'COMPLETE' ELSE 'INCOMPLETE_SAMPLE' END AS sample_status,
      g.raw_classification, g.valid_return_trading_day_count, g.valid_return_stock_day_count, g.compounded_log10, t.*
    FROM best b JOIN summ s USING (broker_id, event_type_view) LEFT JOIN g ON g.broker_id = b.broker_id CROSS JOIN t WHERE b.event_type_view = 'ALL_RISK_EVENTS'""",
)
def g27_ranked(d: Domain):
    summary = grades.grade_return_summary(_daily_returns(d)).select(
        "broker_id",
        "raw_classification",
        "valid_return_trading_day_count",
        "valid_return_stock_day_count",
        F.round(F.log10(F.col("compounded_equal_weight_return") + 1), 6).alias("compounded_log10"),
    )
    return dbl(ranking.ranked_overview(_summary(d), summary, expected=len(BROKERS)))


@query(
    "w20_compounded_return",
    """p AS (SELECT security_code, d, close_price::DOUBLE / lag(close_price) OVER (PARTITION BY security_code ORDER BY d)::DOUBLE - 1 AS r FROM daily)
    SELECT security_code, round(ln(product(1 + r)), 6) AS log_growth FROM p WHERE r IS NOT NULL GROUP BY 1""",
)
def w20(d: Domain):
    folded = grades.ordered_growth(_own_returns(d), ["security_code"], DAY, "r", span=8)
    return folded.select("security_code", F.round(F.ln("growth"), 6).alias("log_growth"))


def _own_returns(d: Domain):
    """Return against the last known close; one row per security-day."""
    known = panel.previous_known_close(d.daily.select(*R.KEY, DAY, "close_price"))
    return known.where(F.col("previous_close").isNotNull()).select(
        "security_code", DAY, (F.col("close_price").cast("double") / F.col("previous_close").cast("double") - 1).alias("r")
    )


@query(
    "w19_maximum_drawdown",
    """p AS (SELECT security_code, d, close_price::DOUBLE AS c, first_value(close_price) OVER (PARTITION BY security_code ORDER BY d)::DOUBLE AS c0,
        lag(close_price) OVER (PARTITION BY security_code ORDER BY d) AS pc FROM daily),
    n AS (SELECT security_code, d, c / c0 AS nav, greatest(1.0::DOUBLE, max(c / c0) OVER (PARTITION BY security_code ORDER BY d)) AS peak FROM p WHERE pc IS NOT NULL)
    SELECT security_code, round(least(0.0::DOUBLE, min(nav / peak - 1)), 6) AS maximum_drawdown FROM n GROUP BY 1""",
)
def w19(d: Domain):
    folded = grades.ordered_growth(_own_returns(d), ["security_code"], DAY, "r", span=8)
    return folded.select("security_code", F.round("worst_fall", 6).alias("maximum_drawdown"))


# --- two-model tables -------------------------------------------------------
SNAPSHOT_SQL = """sn AS (SELECT CASE broker_id WHEN 'B01' THEN 'legacy' ELSE 'new' END AS model, security_code, arg_max(raw, d) AS grade FROM hist
      WHERE d <= DATE '2024-01-30' AND broker_id IN ('B01','B03') GROUP BY 1, 2),
    gl AS (SELECT unnest(['A','B','C','D','E','F','G']) AS grade)"""


@query(
    "g14_grade_count_comparison",
    SNAPSHOT_SQL
    + f""", c AS (SELECT g.grade, count(*) FILTER (WHERE model = 'legacy') AS o, count(*) FILTER (WHERE model = 'new') AS n FROM gl g LEFT JOIN sn USING (grade) GROUP BY 1),
    t AS (SELECT sum(o)::BIGINT AS ot, sum(n)::BIGINT AS nt FROM c),
    r AS (SELECT grade, o, n FROM c UNION ALL SELECT 'TOTAL', ot, nt FROM t),
    x AS (SELECT grade, o, n, {half_up("o", "ot")} AS os, {half_up("n", "nt")} AS ns FROM r, t)
    SELECT grade, o AS legacy_count, n AS new_count, os AS legacy_share, ns AS new_share, CASE WHEN grade <> 'TOTAL' THEN n - o END AS count_change,
      CASE WHEN grade <> 'TOTAL' THEN round(ns - os, 6) END AS share_change FROM x""",
)
def g14(d: Domain):
    return dbl(grades.grade_count_comparison(grades.grade_snapshot(d.cells, 0, END), grades.grade_snapshot(d.cells, 2, END)))


@query(
    "g15_grade_cap_comparison",
    SNAPSHOT_SQL
    + """, cp AS (SELECT security_code, amount * 1000000 AS cap FROM daily WHERE d = (SELECT max(d) FROM daily WHERE d <= DATE '2024-01-30')),
    j AS (SELECT s.model, s.grade, p.cap FROM sn s LEFT JOIN cp p USING (security_code)),
    c AS (SELECT g.grade, coalesce(sum(cap) FILTER (WHERE model = 'legacy'), 0) AS o, count(cap) FILTER (WHERE model = 'legacy') AS oc,
      coalesce(sum(cap) FILTER (WHERE model = 'new'), 0) AS n, count(cap) FILTER (WHERE model = 'new') AS nc FROM gl g LEFT JOIN j USING (grade) GROUP BY 1),
    t AS (SELECT sum(o) AS ot, sum(n) AS nt, sum(oc)::BIGINT AS oct, sum(nc)::BIGINT AS nct FROM c),
    r AS (SELECT grade, o, oc, n, nc FROM c UNION ALL SELECT 'TOTAL', ot, oct, nt, nct FROM t)
    SELECT grade, round(o::DOUBLE / 1e8, 6) AS legacy_cap_yi, round(o::DOUBLE / nullif(ot::DOUBLE, 0), 6) AS legacy_share, oc AS legacy_covered,
      round(n::DOUBLE / 1e8, 6) AS new_cap_yi, round(n::DOUBLE / nullif(nt::DOUBLE, 0), 6) AS new_share, nc AS new_covered,
      CASE WHEN grade <> 'TOTAL' THEN round((n - o)::DOUBLE / 1e8, 6) END AS cap_change_yi FROM r, t""",
)
def g15(d: Domain):
    caps = d.daily.select(*R.KEY, DAY, (F.col("amount") * 1_000_000).alias("total_market_cap"))
    return dbl(
        grades.grade_cap_comparison(
            grades.grade_snapshot(d.cells, 0, END),
            grades.grade_snapshot(d.cells, 2, END),
            grades.latest_market_caps(caps, END),
        )
    )


@query(
    "g16_grade_market_stats",
    PRICES_SQL
    + """, lagged AS (SELECT security_code, broker_id, d, lag(raw) OVER (PARTITION BY security_code, broker_id ORDER BY d) AS raw FROM act_rows WHERE broker_id IN ('B01','B03')),
    rr AS (SELECT CASE l.broker_id WHEN 'B01' THEN 'legacy' ELSE 'new' END AS model, l.raw AS grade, p.d, p.security_code, (p.high_amt - p.low_amt)::DOUBLE / p.previous_close::DOUBLE AS amp,
      p.close_price::DOUBLE / p.previous_close::DOUBLE - 1 AS r, p.amount FROM prices p JOIN lagged l ON l.security_code = p.security_code AND l.d = p.d
      WHERE p.previous_close IS NOT NULL AND p.d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30' AND l.raw IN ('A','B','C','D','E','F','G')),
    dd AS (SELECT model, grade, d, avg(r) AS dr FROM rr GROUP BY 1, 2, 3),
    nav AS (SELECT model, grade, d, exp(sum(ln(1 + dr)) OVER (PARTITION BY model, grade ORDER BY d)) AS nav FROM dd),
    pk AS (SELECT model, grade, nav, greatest(1.0::DOUBLE, max(nav) OVER (PARTITION BY model, grade ORDER BY d)) AS peak FROM nav),
    dw AS (SELECT model, grade, least(0.0::DOUBLE, min(nav / peak - 1)) AS mdd FROM pk GROUP BY 1, 2),
    vol AS (SELECT model, grade, count(dr) AS nd, stddev_samp(dr) AS sd FROM dd GROUP BY 1, 2),
    st AS (SELECT model, grade, avg(amp) AS amp, sum(amount)::DOUBLE / count(*) / 1e8 AS amt, count(*) AS n, count(DISTINCT security_code) AS ns FROM rr GROUP BY 1, 2)
    SELECT m.model, g.grade, round(amp, 6) AS mean_amplitude, CASE WHEN nd >= 2 THEN round(sd * sqrt(252), 6) END AS annual_volatility, round(mdd, 6) AS maximum_drawdown,
      round(amt, 9) AS mean_amount_yi, coalesce(nd, 0) AS valid_trading_day_count, coalesce(n, 0) AS valid_stock_day_count, coalesce(ns, 0) AS distinct_stock_count,
      CASE WHEN n IS NULL THEN 'NO_VALID_SAMPLE' ELSE 'READY' END AS status
    FROM (SELECT unnest(['legacy','new']) AS model) m CROSS JOIN (SELECT unnest(['A','B','C','D','E','F','G']) AS grade) g
    LEFT JOIN st ON st.model = m.model AND st.grade = g.grade LEFT JOIN vol ON vol.model = m.model AND vol.grade = g.grade LEFT JOIN dw ON dw.model = m.model AND dw.grade = g.grade""",
)
def g16(d: Domain):
    prices = session_prices(d).where(F.col("previous_close").isNotNull())
    rows = prices.select(
        *R.KEY,
        DAY,
        ((F.col("high_amt") - F.col("low_amt")).cast("decimal(20,6)") / F.col("previous_close")).cast("decimal(28,18)").alias("amplitude"),
        (F.col("close_price") / F.col("previous_close") - F.lit(1)).cast("decimal(28,18)").alias("simple_return"),
        "amount",
    )
    return dbl(grades.grade_market_stats(d.cells, rows, (START, END), [("legacy", 0), ("new", 2)]))


# --- period tables ----------------------------------------------------------
def _b03_events(d: Domain):
    own = d.stored_assessments.where(F.col("broker_id") == "B03")
    return own.withColumn("grade", S.grade_bucket("raw_classification", "selected_classification_date"))


@query(
    "g17_period_report",
    f"""src AS (SELECT d, CASE WHEN raw IN ('A','B','C','D','E','F','G') THEN raw WHEN raw = '' THEN 'BLANK' ELSE 'UNKNOWN' END AS grade FROM hist
        WHERE broker_id = 'B03' AND market_code <> 'XBSE' AND d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'),
    n AS (SELECT count(DISTINCT d) AS days FROM src), s AS (SELECT grade, count(*) AS sd FROM src GROUP BY 1),
    e AS (SELECT event_type, {GRADE.format(r="raw", s="sel_d")} AS grade, count(*) AS c FROM assess WHERE broker_id = 'B03' GROUP BY 1, 2)
    SELECT 'new' AS model, t.event_type, g.grade, coalesce(c, 0) AS event_count, days AS source_day_count, coalesce(sd, 0) AS stock_days,
      ((coalesce(sd, 0) * 2 + days) // (2 * days))::BIGINT AS mean_daily_count, {half_up("coalesce(c,0) * days * 100", "coalesce(sd,0)", 2)} AS event_percent,
      CASE WHEN coalesce(sd, 0) = 0 THEN 'ZERO' ELSE 'DEFINED' END AS denominator_status
    FROM (SELECT unnest(['NON_ST_CONTINUOUS_LIMIT_DOWN','NEW_ST']) AS event_type) t CROSS JOIN (SELECT unnest(['A','B','C','D','E','F','G']) AS grade) g CROSS JOIN n
    LEFT JOIN s USING (grade) LEFT JOIN e ON e.event_type = t.event_type AND e.grade = g.grade""",
)
def g17(d: Domain):
    raw = F.get("grades", F.lit(2))
    source = d.cells.where(
        (F.col("market_code") != "XBSE") & F.col("classification_date").between(F.lit(START), F.lit(END))
    ).select(F.col("classification_date").alias("source_date"), S.grade_bucket(raw, "classification_date").alias("grade"))
    return dbl(grades.period_report(_b03_events(d), source, "new"))


def _daily_grades(d: Domain):
    """Complete daily single-broker history: the grade active at each session's close."""
    grid = panel.expected_days(d.eligible, d.days).select(*R.KEY, DAY, "ordinal")
    active = assess.active_grades(d.cells, grid).where(F.col("grid").isNotNull() & F.col("active").isNotNull())
    return active.select(*R.KEY, DAY, F.get("active.grades", F.lit(2)).alias("grade"))


@query(
    "g18_interception_table",
    f"""ca AS (SELECT *, CASE WHEN final_bucket IN ('DANGEROUS','NON_DANGEROUS') THEN final_bucket = 'DANGEROUS' END AS hit FROM assess_v WHERE broker_id = 'B03'),
    hs AS (SELECT v, security_code, count(*) AS n, count(*) FILTER (WHERE hit) AS h, count(*) FILTER (WHERE hit IS NULL) AS u FROM ca GROUP BY 1, 2),
    ht AS (SELECT v, sum(n)::BIGINT AS n, sum(h)::BIGINT AS h, sum(u)::BIGINT AS u, count(*) AS sn, count(*) FILTER (WHERE h > 0) AS sh, count(*) FILTER (WHERE h = 0 AND u > 0) AS su FROM hs GROUP BY 1)
    SELECT 'B03' AS broker_id, v.v AS event_type_view, coalesce(n, 0) AS risk_event_count, coalesce(h, 0) AS hit_event_count, coalesce(u, 0) AS unknown_event_count,
      {half_up("coalesce(h,0)", "coalesce(n,0)")} AS event_hit_rate, coalesce(sn, 0) AS risk_security_count, coalesce(sh, 0) AS hit_risk_security_count,
      coalesce(su, 0) AS unknown_security_count, {half_up("coalesce(sh,0)", "coalesce(sn,0)")} AS security_hit_rate, CASE WHEN n > 0 THEN 'DEFINED' ELSE 'NOT_APPLICABLE' END AS result_status
    FROM views v LEFT JOIN ht USING (v)""",
)
def g18(d: Domain):
    verdicts = assess.cutoff_only_assessments(
        d.stored_events, _daily_grades(d), d.st_known, d.index, "B03", MAPPING
    )
    return dbl(metrics.hit_rates(verdicts, ["B03"]))


@query(
    "g19_grade_banding",
    """dg AS (SELECT a.d, a.raw FROM act_rows a JOIN eligible e USING (security_code) WHERE a.broker_id = 'B03' AND a.raw IS NOT NULL AND a.d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'
        AND a.d >= a.listed_date AND (a.delisted_date IS NULL OR a.d < a.delisted_date)),
    n AS (SELECT count(DISTINCT d) AS days FROM dg), s AS (SELECT raw AS grade, count(*) AS sd FROM dg GROUP BY 1), e AS (SELECT raw AS grade, count(*) AS c FROM assess WHERE broker_id = 'B03' GROUP BY 1),
    x AS (SELECT grade, coalesce(c, 0) AS risk_event_count, coalesce(sd, 0) AS stock_days, days AS trading_days,
      ((coalesce(sd, 0) * 200 + days) // (2 * days))::DOUBLE / 100 AS daily_average, (coalesce(c, 0) * days * 20000 + sd) // (2 * sd) AS p
      FROM (SELECT unnest(['A','B','C','D','E','F','G']) AS grade) CROSS JOIN n LEFT JOIN s USING (grade) LEFT JOIN e USING (grade))
    SELECT grade, risk_event_count, stock_days, trading_days, daily_average, printf('%d.%02d%%', (p // 100)::BIGINT, (p % 100)::BIGINT) AS ratio_display FROM x""",
)
def g19(d: Domain):
    inside = _daily_grades(d).where(F.col(DAY).between(F.lit(START), F.lit(END)))
    raw = d.stored_assessments.where(F.col("broker_id") == "B03").select(F.col("raw_classification").alias("grade"))
    return dbl(grades.grade_banding(raw, inside))


@query(
    "p23_grade_overrides",
    """dg AS (SELECT a.market_code, a.security_code, a.d, a.raw FROM act_rows a JOIN eligible e USING (security_code) WHERE a.broker_id = 'B03' AND a.raw IS NOT NULL
        AND a.d >= a.listed_date AND (a.delisted_date IS NULL OR a.d < a.delisted_date)),
    ov AS (SELECT o.market_code, o.security_code, t.d FROM (SELECT market_code, security_code FROM ev WHERE market_code <> 'XBSE' GROUP BY 1, 2 HAVING max(amt) >= 300) o CROSS JOIN tdays t)
    SELECT override_effect, grade, count(*) AS n FROM (SELECT CASE WHEN o.d IS NOT NULL THEN 'G' ELSE g.raw END AS grade,
      CASE WHEN g.d IS NULL THEN 'ADDED' WHEN o.d IS NOT NULL AND g.raw <> 'G' THEN 'CHANGED' ELSE 'KEPT' END AS override_effect
      FROM dg g FULL JOIN ov o ON o.security_code = g.security_code AND o.d = g.d) GROUP BY 1, 2""",
)
def p23(d: Domain):
    forced = (
        d.events.where(F.col("market_code") != "XBSE")
        .groupBy(*R.KEY)
        .agg(F.max("amt").alias("m"))
        .where("m >= 300")
        .select(*R.KEY, F.lit("G").alias("override_grade"))
    )
    return grades.apply_overrides(_daily_grades(d), forced, d.days).groupBy("override_effect", "grade").agg(
        F.count("*").alias("n")
    )


# --- model comparison -------------------------------------------------------
def _pairs(d: Domain):
    new = d.stored_assessments.where(F.col("broker_id") == "B03")
    legacy = d.stored_assessments.where(F.col("broker_id") == "B01")
    return compare.paired_assessments(new, legacy)


PAIR_SQL = """pr AS (SELECT n.event_key, n.security_code, n.event_type, coalesce(n.raw, '') AS new_classification, coalesce(l.raw, '') AS legacy_classification,
      coalesce(n.is_hit, false) AS new_hit, coalesce(l.is_hit, false) AS legacy_hit, n.wdays AS new_warning_days, l.wdays AS legacy_warning_days
      FROM assess n JOIN assess l USING (event_key) WHERE n.broker_id = 'B03' AND l.broker_id = 'B01'),
    df AS (SELECT *, new_warning_days - legacy_warning_days AS warning_days_delta FROM pr WHERE new_hit <> legacy_hit OR new_warning_days IS DISTINCT FROM legacy_warning_days OR new_classification <> legacy_classification)"""


@query("j16_model_pairs", PAIR_SQL + " SELECT *, true AS in_new, true AS in_legacy FROM pr")
def j16(d: Domain):
    return _pairs(d)


@query(
    "g20_model_comparison",
    PAIR_SQL
    + f""" SELECT count(*) AS event_count, count(*) FILTER (WHERE new_hit) AS new_hit_count, count(*) FILTER (WHERE legacy_hit) AS legacy_hit_count,
      count(*) FILTER (WHERE new_hit AND NOT legacy_hit) AS gained_hit_count, count(*) FILTER (WHERE legacy_hit AND NOT new_hit) AS lost_hit_count,
      count(*) FILTER (WHERE new_warning_days IS DISTINCT FROM legacy_warning_days) AS warning_changed_count,
      {half_up("coalesce(sum(new_warning_days), 0)", "count(new_warning_days)")} AS new_average_warning_days,
      {half_up("coalesce(sum(legacy_warning_days), 0)", "count(legacy_warning_days)")} AS legacy_average_warning_days FROM pr""",
)
def g20(d: Domain):
    return dbl(compare.model_comparison_totals(_pairs(d)))


@query("g20_event_differences", PAIR_SQL + " SELECT * FROM df")
def g20b(d: Domain):
    return compare.event_differences(_pairs(d)).drop("in_new", "in_legacy")


@query(
    "g21_migration_matrix",
    PAIR_SQL
    + " SELECT coalesce(nullif(legacy_classification, ''), 'UNKNOWN') AS from_grade, coalesce(nullif(new_classification, ''), 'UNKNOWN') AS to_grade, count(*) AS event_count FROM pr GROUP BY 1, 2",
)
def g21(d: Domain):
    return compare.migration_matrix(_pairs(d))


TAG_SQL = PAIR_SQL + """, tg AS (SELECT *, array_to_string(list_filter([CASE WHEN new_hit AND NOT legacy_hit THEN 'gained_hit' END, CASE WHEN legacy_hit AND NOT new_hit THEN 'lost_hit' END,
      CASE WHEN new_hit <> legacy_hit THEN 'hit_changed' END, CASE WHEN new_warning_days IS DISTINCT FROM legacy_warning_days THEN 'warning_changed' END,
      CASE WHEN new_classification <> legacy_classification THEN 'classification_changed' END], lambda x: x IS NOT NULL), ',') AS change_types FROM df)"""


@query(
    "g22_difference_explorer",
    TAG_SQL
    + " SELECT event_key, change_types, coalesce(nullif(legacy_classification, ''), 'UNKNOWN') || '>' || coalesce(nullif(new_classification, ''), 'UNKNOWN') AS classification_transition FROM tg WHERE change_types LIKE '%hit_changed%'",
)
def g22(d: Domain):
    tagged = compare.tagged_differences(compare.event_differences(_pairs(d)))
    return compare.filter_differences(tagged, change_type="hit_changed").select(
        "event_key", F.array_join("change_types", ",").alias("change_types"), "classification_transition"
    )


@query(
    "g22_difference_summary",
    TAG_SQL
    + """ SELECT count(*) AS total_difference_count, count(*) FILTER (WHERE change_types LIKE '%gained_hit%') AS gained_hit_count, count(*) FILTER (WHERE change_types LIKE '%lost_hit%') AS lost_hit_count,
      count(*) FILTER (WHERE change_types LIKE '%warning_changed%') AS warning_changed_count, count(*) FILTER (WHERE change_types LIKE '%classification_changed%') AS classification_changed_count FROM tg""",
)
def g22b(d: Domain):
    return compare.difference_summary(compare.tagged_differences(compare.event_differences(_pairs(d))))


@query(
    "j12_two_sided_diff",
    """a AS (SELECT l_orderkey AS k, min(year(l_shipdate)) AS lo, max(year(l_shipdate)) AS hi FROM lineitem GROUP BY 1)
    SELECT k, difference FROM (SELECT coalesce(a.k, o.o_orderkey) AS k, CASE WHEN lo <> hi THEN 'LOCAL_CONFLICT' WHEN a.k IS NULL THEN 'MISSING' WHEN o.o_orderkey IS NULL THEN 'EXTRA'
      WHEN lo <> year(o_orderdate) THEN 'DIFFERENT' END AS difference FROM a FULL JOIN orders o ON o.o_orderkey = a.k) WHERE difference IS NOT NULL""",
)
def j12(d: Domain):
    actual = d.table("lineitem").select(F.col("l_orderkey").alias("k"), F.year("l_shipdate").alias("y"))
    expected = d.table("orders").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"))
    return compare.two_sided_diff(actual, expected, ["k"], ["y"])


@query(
    "j13_diff_with_lifecycle",
    """e AS (SELECT security_code, d, count(DISTINCT event_type) FILTER (WHERE amt >= 60) AS kinds, arg_max(event_type, event_id) AS label FROM ev GROUP BY 1, 2),
    a AS (SELECT security_code, d, count(DISTINCT event_type) FILTER (WHERE amt >= 60) AS kinds, arg_max(event_type, event_id) AS label FROM ev WHERE event_type <> 'view' GROUP BY 1, 2),
    j AS (SELECT e.security_code, e.d, CASE WHEN a.d IS NULL THEN 'MISSING' WHEN a.kinds <> e.kinds OR a.label <> e.label THEN 'DIFFERENT' END AS difference, a.kinds IS NOT DISTINCT FROM e.kinds AS same_kinds
      FROM e LEFT JOIN a ON a.security_code = e.security_code AND a.d = e.d)
    SELECT s.market_code, s.security_code, j.d AS business_date, difference, CASE WHEN difference = 'MISSING' AND o THEN 'OUTSIDE_LIFECYCLE' WHEN difference = 'DIFFERENT' AND o AND same_kinds THEN 'ELIGIBILITY_LABEL_ONLY' ELSE 'FAILURE' END AS assessment
    FROM j JOIN (SELECT * FROM sec) s ON s.security_code = j.security_code, LATERAL (SELECT coalesce(j.d < s.listed_date OR j.d >= s.delisted_date, false) AS o) WHERE difference IS NOT NULL""",
)
def j13(d: Domain):
    def side(events):
        return events.groupBy(*R.KEY, F.col("d").alias("business_date")).agg(
            F.count_distinct(F.when(F.col("amt") >= 60, F.col("event_type"))).alias("kinds"),
            F.max_by("event_type", "event_id").alias("label"),
        )

    actual = side(d.events.where(F.col("event_type") != "view"))
    return compare.diff_with_lifecycle(actual, side(d.events), d.life, ["kinds", "label"], eligibility="label")


@query(
    "r3_dense_frequency_rank",
    "SELECT broker_id, raw AS raw_classification, count(*) AS n, dense_rank() OVER (PARTITION BY broker_id ORDER BY count(*) DESC)::INTEGER AS frequency_rank FROM hist GROUP BY 1, 2",
)
def r3(d: Domain):
    counts = d.long.groupBy("broker_id", "raw_classification").agg(F.count("*").alias("n"))
    return ranking.dense_frequency_rank(counts, "n", "frequency_rank", ["broker_id"])


@query(
    "r3_global_frequency_rank",
    "SELECT security_code, count(*) AS n, dense_rank() OVER (ORDER BY count(*) DESC)::INTEGER AS frequency_rank FROM hist GROUP BY 1",
)
def r3_global(d: Domain):
    counts = d.long.groupBy("security_code").agg(F.count("*").alias("n"))
    return ranking.dense_frequency_rank(counts, "n", "frequency_rank")
