"""Queries on point-in-time assessment, exposures and broker metrics."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import assess, metrics, panel, ranking
from workload.domain import BROKERS, CODE_DIGITS, END, MAPPING, RAW_VALUES, START, Domain
from workload.registry import half_up, query


def dbl(df, *cols):
    """Decimals as doubles, for a value comparison that does not depend on scale."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
    )


@query(
    "j4_cutoff_record",
    """SELECT event_key, broker_id, cutoff AS cutoff_trading_date, sel_d AS selected_classification_date, raw AS raw_classification FROM assess""",
)
def j4(d: Domain):
    return d.stored_assessments.select(
        "event_key", "broker_id", "cutoff_trading_date", "selected_classification_date", "raw_classification"
    )


@query(
    "j5_event_broker_rows",
    "SELECT event_key, count(*) AS broker_rows, count(DISTINCT broker_id) AS brokers FROM assess GROUP BY event_key",
)
def j5(d: Domain):
    return d.stored_assessments.groupBy("event_key").agg(
        F.count("*").alias("broker_rows"), F.count_distinct("broker_id").alias("brokers")
    )


@query(
    "w8_active_classification",
    """SELECT market_code, security_code, d AS trading_date, max(sel_d) AS active_date,
    max(CASE WHEN broker_id = 'B01' THEN raw END) AS b01, max(CASE WHEN broker_id = 'B03' THEN raw END) AS b03
    FROM act_rows WHERE d >= listed_date AND (delisted_date IS NULL OR d < delisted_date) GROUP BY 1, 2, 3""",
)
def w8(d: Domain):
    grid = panel.expected_days(d.life, d.days).select(*R.KEY, "trading_date", "ordinal")
    rows = assess.active_grades(d.cells, grid).where(F.col("grid").isNotNull())
    return rows.select(
        *R.KEY,
        "trading_date",
        F.col("active.classification_date").alias("active_date"),
        F.get("active.grades", F.lit(0)).alias("b01"),
        F.get("active.grades", F.lit(2)).alias("b03"),
    )


@query(
    "w10_dangerous_run_start",
    """SELECT market_code, security_code, broker_id, d AS trading_date, final_bucket,
    (SELECT x.d FROM tdays x WHERE x.ord = start_ord) AS dangerous_run_start_date, coalesce(start_ord = 1, false) AS run_left_censored
    FROM bruns WHERE security_code IN (SELECT security_code FROM risk_ev)""",
)
def w10(d: Domain):
    scope = d.stored_events.select(*R.KEY).distinct()
    open_life = scope.select(
        *R.KEY, F.lit(None).cast("date").alias("listed_date"), F.lit(None).cast("date").alias("delisted_date")
    )
    states = assess.broker_states(
        assess.state_grid(open_life, d.days),
        d.cells.join(scope, list(R.KEY), "left_semi"),
        d.st_known.join(scope, list(R.KEY), "left_semi"),
        BROKERS,
        MAPPING,
    )
    return assess.dangerous_runs(states).select(
        *R.KEY, "broker_id", "trading_date", "final_bucket", "dangerous_run_start_date", "run_left_censored"
    )


@query(
    "w11_warning_days",
    "SELECT event_key, broker_id, start_d AS dangerous_run_start_date, wdays::BIGINT AS warning_trading_days FROM assess WHERE wstatus = 'DEFINED'",
)
def w11(d: Domain):
    return d.assessments.where(F.col("warning_days_status") == "DEFINED").select(
        "event_key", "broker_id", "dangerous_run_start_date", F.col("warning_trading_days").cast("bigint").alias("warning_trading_days")
    )


@query(
    "w12_assessment_status",
    """SELECT event_key, broker_id, final_bucket, resolution AS classification_resolution, ident AS identification_status, is_hit,
    wstatus AS warning_days_status, CASE WHEN final_bucket = 'DANGEROUS' THEN start_d END AS dangerous_run_start_date, wdays AS warning_trading_days, reason_code,
    CASE WHEN is_st IS NULL THEN 'UNKNOWN' WHEN is_st THEN 'ST' ELSE 'NON_ST' END AS cutoff_st_state FROM assess""",
)
def w12(d: Domain):
    return d.assessments.select(
        "event_key",
        "broker_id",
        "final_bucket",
        "classification_resolution",
        "identification_status",
        "is_hit",
        "warning_days_status",
        "dangerous_run_start_date",
        "warning_trading_days",
        "reason_code",
        "cutoff_st_state",
    )


@query(
    "w13_daily_exposures",
    """SELECT broker_id, d AS snapshot_date, count(*) FILTER (WHERE final_bucket = 'DANGEROUS') AS dangerous,
    count(*) FILTER (WHERE final_bucket = 'UNKNOWN') AS unknown, count(*) AS securities FROM expo GROUP BY 1, 2""",
)
def w13(d: Domain):
    bucket = F.col("final_bucket")
    return d.exposure_states.groupBy("broker_id", "snapshot_date").agg(
        F.count_if(bucket == "DANGEROUS").alias("dangerous"),
        F.count_if(bucket == "UNKNOWN").alias("unknown"),
        F.count("*").alias("securities"),
    )


@query(
    "g1_event_views",
    """SELECT v.v AS event_type_view, b.broker_id, count(a.event_key) AS assessment_count
    FROM bv b JOIN views v ON v.v = b.v LEFT JOIN assess_v a ON a.v = b.v AND a.broker_id = b.broker_id GROUP BY 1, 2""",
)
def g1(d: Domain):
    rows = metrics.with_views(d.stored_assessments).groupBy("broker_id", "event_type_view").agg(
        F.count("*").alias("assessment_count")
    )
    grid = metrics.view_grid(d.spark, BROKERS)
    return F.broadcast(grid).join(rows, ["broker_id", "event_type_view"], "left").fillna(0)


HIT_SQL = f"""hs AS (SELECT broker_id, v, security_code, count(*) AS n, count(*) FILTER (WHERE is_hit) AS h, count(*) FILTER (WHERE is_hit IS NULL) AS u
      FROM assess_v GROUP BY 1, 2, 3),
    ht AS (SELECT broker_id, v, sum(n) AS n, sum(h) AS h, sum(u) AS u, count(*) AS sn, count(*) FILTER (WHERE h > 0) AS sh,
             count(*) FILTER (WHERE h = 0 AND u > 0) AS su FROM hs GROUP BY 1, 2),
    hits AS (SELECT b.broker_id, b.v AS event_type_view, coalesce(n, 0)::BIGINT AS risk_event_count, coalesce(h, 0)::BIGINT AS hit_event_count,
      coalesce(u, 0)::BIGINT AS unknown_event_count, {half_up("coalesce(h,0)", "coalesce(n,0)")} AS event_hit_rate,
      coalesce(sn, 0)::BIGINT AS risk_security_count, coalesce(sh, 0)::BIGINT AS hit_risk_security_count, coalesce(su, 0)::BIGINT AS unknown_security_count,
      {half_up("coalesce(sh,0)", "coalesce(sn,0)")} AS security_hit_rate,
      CASE WHEN n > 0 THEN 'DEFINED' ELSE 'NOT_APPLICABLE' END AS result_status
      FROM bv b LEFT JOIN ht USING (broker_id, v))"""


@query("g2_hit_rates", HIT_SQL + " SELECT * FROM hits")
def g2(d: Domain):
    return dbl(metrics.hit_rates(d.stored_assessments, BROKERS))


DAYS_SQL = f"""wd AS (SELECT broker_id, v, count(wdays) AS n, count(*) FILTER (WHERE ident = 'IDENTIFIED' AND wstatus = 'UNKNOWN') AS iu,
      count(*) FILTER (WHERE ident = 'NOT_IDENTIFIED') AS ni, count(*) FILTER (WHERE ident = 'UNKNOWN') AS un,
      min(wdays) AS mn, max(wdays) AS mx, median(wdays) AS md, sum(wdays) AS sm FROM assess_v GROUP BY 1, 2),
    wdist AS (SELECT b.broker_id, b.v AS event_type_view, coalesce(n, 0) AS defined_sample_count, coalesce(iu, 0) AS identified_days_unknown_count,
      coalesce(ni, 0) AS not_identified_count, coalesce(un, 0) AS unknown_assessment_count, mn AS warning_days_min, mx AS warning_days_max,
      md::DOUBLE AS warning_days_median, {half_up("coalesce(sm,0)", "coalesce(n,0)")} AS warning_days_mean,
      CASE WHEN n > 0 THEN 'DEFINED' ELSE 'NOT_APPLICABLE' END AS result_status FROM bv b LEFT JOIN wd USING (broker_id, v))"""


@query("g3_warning_days_distribution", DAYS_SQL + " SELECT * FROM wdist")
def g3(d: Domain):
    return dbl(metrics.warning_days_distribution(d.stored_assessments, BROKERS))


LAST_SQL = """le AS (SELECT security_code, max(first_fact_date) FILTER (WHERE event_type = 'NON_ST_CONTINUOUS_LIMIT_DOWN') AS l0,
      max(first_fact_date) FILTER (WHERE event_type = 'NEW_ST') AS l1, max(first_fact_date) AS l2 FROM risk_ev GROUP BY 1)"""
SNAP_SQL = (
    LAST_SQL
    + f""",
    sn AS (SELECT e.broker_id, e.d, v.v, count(*) FILTER (WHERE final_bucket = 'DANGEROUS') AS den, count(*) FILTER (WHERE final_bucket = 'UNKNOWN') AS unk,
      count(*) FILTER (WHERE final_bucket = 'DANGEROUS' AND CASE v.v WHEN 'NON_ST_CONTINUOUS_LIMIT_DOWN' THEN l0 WHEN 'NEW_ST' THEN l1 ELSE l2 END > e.d) AS num
      FROM expo e CROSS JOIN views v LEFT JOIN le USING (security_code) GROUP BY 1, 2, 3),
    snap AS (SELECT b.broker_id, b.v AS event_type_view, 'SNAPSHOT' AS aggregation_scope, t.d AS snapshot_trading_date, coalesce(num, 0) AS dangerous_risk_security_count,
      coalesce(den, 0) AS dangerous_security_count, coalesce(unk, 0) AS unknown_classification_security_count,
      {half_up("coalesce(num,0)", "coalesce(den,0)")} AS warning_rate, CASE WHEN den > 0 THEN 'DEFINED' ELSE 'NOT_APPLICABLE' END AS result_status
      FROM bv b CROSS JOIN wdays t LEFT JOIN sn ON sn.broker_id = b.broker_id AND sn.v = b.v AND sn.d = t.d)"""
)
PERIOD_SQL = f"""fx AS (SELECT broker_id, security_code, min(d) FILTER (WHERE final_bucket = 'DANGEROUS') AS fd, bool_or(coalesce(final_bucket = 'UNKNOWN', false)) AS unk
      FROM expo GROUP BY 1, 2),
    pd AS (SELECT f.broker_id, v.v, count(fd) AS den, count(*) FILTER (WHERE unk) AS unk,
      count(*) FILTER (WHERE CASE v.v WHEN 'NON_ST_CONTINUOUS_LIMIT_DOWN' THEN l0 WHEN 'NEW_ST' THEN l1 ELSE l2 END > fd) AS num
      FROM fx f CROSS JOIN views v LEFT JOIN le USING (security_code) GROUP BY 1, 2),
    period AS (SELECT b.broker_id, b.v AS event_type_view, 'OBSERVATION_PERIOD' AS aggregation_scope, NULL::DATE AS snapshot_trading_date,
      coalesce(num, 0) AS dangerous_risk_security_count, coalesce(den, 0) AS dangerous_security_count, coalesce(unk, 0) AS unknown_classification_security_count,
      {half_up("coalesce(num,0)", "coalesce(den,0)")} AS warning_rate, CASE WHEN den > 0 THEN 'DEFINED' ELSE 'NOT_APPLICABLE' END AS result_status
      FROM bv b LEFT JOIN pd USING (broker_id, v))"""


def _window_days(d: Domain):
    """Sessions of the observation window on the default calendar."""
    return d.days.where(
        (F.col("market_code") == "XSHG") & F.col("trading_date").between(F.lit(START), F.lit(END))
    )


def _snapshot(d: Domain):
    return metrics.warning_rates_snapshot(d.exposure_states, d.stored_events, BROKERS, _window_days(d))


def _period(d: Domain):
    return metrics.warning_rates_period(d.exposure_states, d.stored_events, BROKERS)


@query("g4_warning_rate_snapshot", SNAP_SQL + " SELECT * FROM snap")
def g4(d: Domain):
    return dbl(_snapshot(d))


@query("g5_warning_rate_period", LAST_SQL + "," + PERIOD_SQL + " SELECT * FROM period")
def g5(d: Domain):
    return dbl(_period(d))


SUMMARY_SQL = HIT_SQL + "," + DAYS_SQL + "," + LAST_SQL + "," + PERIOD_SQL + """,
    summ AS (SELECT h.broker_id, h.event_type_view,
      CASE h.event_type_view WHEN 'NON_ST_CONTINUOUS_LIMIT_DOWN' THEN '非ST连续跌停风险股票' WHEN 'NEW_ST' THEN '新增ST风险股票' ELSE '两类风险股票合计' END AS risk_type_zh,
      w.defined_sample_count, w.identified_days_unknown_count, w.warning_days_min, w.warning_days_max, w.warning_days_median, w.warning_days_mean,
      h.risk_event_count, h.hit_event_count, h.event_hit_rate, h.risk_security_count, h.hit_risk_security_count, h.security_hit_rate,
      p.dangerous_risk_security_count, p.dangerous_security_count, p.unknown_classification_security_count, p.warning_rate
      FROM hits h JOIN wdist w USING (broker_id, event_type_view) JOIN period p USING (broker_id, event_type_view))"""


def _summary(d: Domain):
    return metrics.final_summary(
        metrics.warning_days_distribution(d.stored_assessments, BROKERS),
        metrics.hit_rates(d.stored_assessments, BROKERS),
        _period(d),
    )


@query("g6_final_summary", SUMMARY_SQL + " SELECT * FROM summ")
def g6(d: Domain):
    return dbl(_summary(d))


GRADE = "CASE WHEN regexp_full_match(upper(trim(coalesce({r},''))), '[A-G]') THEN upper(trim({r})) WHEN trim(coalesce({r},'')) = '' AND {s} IS NOT NULL THEN 'BLANK' ELSE 'UNKNOWN' END"
G7_SQL = f"""gx AS (SELECT *, {GRADE.format(r="raw", s="sel_d")} AS grade FROM assess_v WHERE broker_id = 'B03'),
    gg AS (SELECT v, grade, count(*) AS n, count(*) FILTER (WHERE is_hit) AS h, count(*) FILTER (WHERE is_hit IS NULL) AS u,
      count(DISTINCT security_code) AS sn, count(DISTINCT security_code) FILTER (WHERE is_hit) AS sh, count(wdays) AS wn,
      min(wdays) AS mn, max(wdays) AS mx, median(wdays) AS md, sum(wdays) AS sm FROM gx GROUP BY 1, 2)
    SELECT 'B03' AS broker_id, v.v AS event_type_view, g.grade, coalesce(n, 0) AS risk_event_count, coalesce(h, 0) AS hit_event_count,
      coalesce(u, 0) AS unknown_event_count, {half_up("coalesce(h,0)", "coalesce(n,0)")} AS event_hit_rate, coalesce(sn, 0) AS risk_security_count,
      coalesce(sh, 0) AS hit_risk_security_count, {half_up("coalesce(sh,0)", "coalesce(sn,0)")} AS security_hit_rate,
      coalesce(wn, 0) AS defined_warning_days_count, mn AS warning_days_min, mx AS warning_days_max, md::DOUBLE AS warning_days_median,
      {half_up("coalesce(sm,0)", "coalesce(wn,0)")} AS warning_days_mean, CASE WHEN n > 0 THEN 'DEFINED' ELSE 'NOT_APPLICABLE' END AS result_status
    FROM views v CROSS JOIN (SELECT unnest(['A','B','C','D','E','F','G','BLANK','UNKNOWN']) AS grade) g LEFT JOIN gg ON gg.v = v.v AND gg.grade = g.grade"""


@query("g7_grade_event_summary", G7_SQL)
def g7(d: Domain):
    return dbl(metrics.grade_event_summary(d.stored_assessments, "B03"))


@query(
    "g7_grade_event_detail",
    f"SELECT event_key, upper(trim(coalesce(raw, ''))) AS raw_classification, {GRADE.format(r='raw', s='sel_d')} AS grade, is_hit, wdays AS warning_days FROM assess WHERE broker_id = 'B03'",
)
def g7_detail(d: Domain):
    return metrics.grade_event_detail(d.stored_assessments, "B03").select(
        "event_key", "raw_classification", "grade", "is_hit", F.col("warning_trading_days").alias("warning_days")
    )


@query(
    "g25_assessment_findings",
    """SELECT reason_code AS code, 'WARNING' AS severity, ident || '/' || wstatus AS message, broker_id, market_code, security_code, first_fact_date AS fact_date
    FROM assess WHERE reason_code IN ('BM203_ST_STATUS_MISSING','BM301_MAPPING_UNKNOWN','BM303_DANGEROUS_RUN_LEFT_CENSORED','BM305_NO_BROKER_START_FOR_ST_OVERRIDE','BM109_SECURITY_HISTORY_MISSING')""",
)
def g25(d: Domain):
    return assess.assessment_findings(d.stored_assessments)


@query(
    "g26_count_reconciliation",
    """e AS (SELECT count(*) AS n FROM risk_ev), a AS (SELECT count(*) AS n, count(DISTINCT (event_key, broker_id)) AS k FROM assess), w AS (SELECT count(*) AS n FROM wdays)
    SELECT 'BM402_ASSESSMENT_COUNT' AS check_name, e.n * 3 AS expected, a.n AS actual, e.n * 3 = a.n AS passed FROM e, a
    UNION ALL SELECT 'BM401_ASSESSMENT_KEYS', n, k, n = k FROM a
    UNION ALL SELECT 'BM402_WARNING_RATE_COUNT', (n + 1) * 9, (n + 1) * 9, true FROM w
    UNION ALL SELECT 'BM402_WARNING_DAY_COUNT', 9, 9, true UNION ALL SELECT 'BM402_HIT_RATE_COUNT', 9, 9, true""",
)
def g26(d: Domain):
    rates = _snapshot(d).unionByName(_period(d))
    return metrics.count_reconciliation(
        d.stored_events,
        d.stored_assessments,
        metrics.warning_days_distribution(d.stored_assessments, BROKERS),
        metrics.hit_rates(d.stored_assessments, BROKERS),
        rates,
        BROKERS,
        _window_days(d),
    )


@query(
    "g27_peer_overview",
    SUMMARY_SQL
    + """ SELECT sum(defined_sample_count)::BIGINT AS defined_warning_count, sum(identified_days_unknown_count)::BIGINT AS unknown_warning_count,
    sum(hit_event_count)::BIGINT AS hit_event_count, count(*) AS broker_count, count(*) = 3 AS complete_sample FROM summ WHERE event_type_view = 'ALL_RISK_EVENTS'""",
)
def g27(d: Domain):
    return ranking.peer_overview(_summary(d), expected=len(BROKERS))


@query(
    "r1_competition_rank",
    HIT_SQL
    + """ SELECT broker_id, event_type_view, event_hit_rate, CASE WHEN event_hit_rate IS NOT NULL THEN
    rank() OVER (PARTITION BY event_type_view ORDER BY event_hit_rate DESC NULLS LAST)::INTEGER END AS hit_rank FROM hits""",
)
def r1(d: Domain):
    hits = metrics.hit_rates(d.stored_assessments, BROKERS).select("broker_id", "event_type_view", "event_hit_rate")
    return dbl(ranking.competition_rank(hits, "event_hit_rate", "hit_rank"))


R2_RANK = "CASE WHEN {m} IS NOT NULL THEN rank() OVER (PARTITION BY event_type_view ORDER BY {m} DESC NULLS LAST) END::INTEGER AS {m}_rank"


RANK_SQL = (
    ", rk AS (SELECT broker_id, event_type_view, count(*) OVER (PARTITION BY event_type_view) AS cnt, "
    + "count(*) FILTER (WHERE event_hit_rate IS NOT NULL AND security_hit_rate IS NOT NULL AND warning_rate IS NOT NULL AND warning_days_median IS NOT NULL) OVER (PARTITION BY event_type_view) AS full_cnt, "
    + ", ".join(R2_RANK.format(m=m) for m in R.RANKING_METRICS)
    + """ FROM summ),
    sc AS (SELECT *, CASE WHEN cnt = 3 AND full_cnt = 3 THEN round(((3 - event_hit_rate_rank) / 2.0::DOUBLE * 100 + (3 - security_hit_rate_rank) / 2.0::DOUBLE * 100
      + (3 - warning_rate_rank) / 2.0::DOUBLE * 100 + (3 - warning_days_median_rank) / 2.0::DOUBLE * 100) / 4, 6) END AS composite_score FROM rk)"""
)


@query(
    "r2_composite_score",
    SUMMARY_SQL
    + RANK_SQL
    + """
    SELECT broker_id, event_type_view, event_hit_rate_rank, security_hit_rate_rank, warning_rate_rank, warning_days_median_rank, warning_days_mean_rank,
      composite_score, CASE WHEN composite_score IS NOT NULL THEN rank() OVER (PARTITION BY event_type_view ORDER BY composite_score DESC NULLS LAST) END::INTEGER AS composite_rank,
      CASE WHEN cnt = 3 THEN 'COMPLETE' ELSE 'INCOMPLETE_SAMPLE' END AS sample_status FROM sc""",
)
def r2(d: Domain):
    ranked = ranking.broker_rankings(_summary(d), expected=len(BROKERS))
    return dbl(
        ranked.select(
            "broker_id",
            "event_type_view",
            *[f"{m}_rank" for m in R.RANKING_METRICS],
            "composite_score",
            "composite_rank",
            "sample_status",
        )
    )


DRILL_SQL = f"""dr AS (SELECT *, CASE WHEN is_hit THEN 'HIT' WHEN is_hit IS NULL THEN 'UNKNOWN' ELSE 'MISSED' END AS hs FROM assess WHERE broker_id = 'B02'),
    ds AS (SELECT security_code, market_code, count(*) AS event_count, count(*) FILTER (WHERE hs = 'HIT') AS hit_event_count,
      count(*) FILTER (WHERE hs = 'UNKNOWN') AS unknown_event_count, count(wdays) AS defined_warning_count, max(wdays) AS warning_days_earliest,
      median(wdays)::DOUBLE AS warning_days_median, max(risk_date) AS latest_risk_date,
      {half_up("count(*) FILTER (WHERE hs = 'HIT')", "count(*)")} AS event_hit_rate FROM dr GROUP BY 1, 2)"""


@query("g23_drilldown_securities", DRILL_SQL + " SELECT * FROM ds")
def g23(d: Domain):
    return dbl(ranking.drilldown_securities(ranking.drilldown_rows(d.stored_assessments, "B02")))


@query(
    "r5_deep_page",
    "s AS (SELECT market_code, security_code, d, close_price::DOUBLE AS close_price, row_number() OVER (ORDER BY close_price DESC, security_code, d) AS position FROM daily), n AS (SELECT count(*) AS n FROM daily) SELECT s.* FROM s, n WHERE position > 50 * (n // 100) AND position <= 50 * (n // 100 + 1)",
)
def r5_deep(d: Domain):
    """The page of 50 in the middle of all security-days by price."""
    rows = d.daily.select(*R.KEY, F.col("trading_date").alias("d"), F.col("close_price").cast("double").alias("close_price"))
    result = ranking.paged(rows, [F.desc("close_price"), "security_code", "d"])
    return result.page(d.spark, result.total // 100 + 1, 50)


@query(
    "r5_drilldown_page",
    DRILL_SQL + " SELECT * FROM ds ORDER BY event_hit_rate DESC, event_count DESC, security_code LIMIT 20 OFFSET 20",
)
def r5(d: Domain):
    rows = dbl(ranking.drilldown_securities(ranking.drilldown_rows(d.stored_assessments, "B02")))
    return ranking.page(rows, [F.desc("event_hit_rate"), F.desc("event_count"), "security_code"], 2, 20)


@query(
    "p17_hit_status",
    "SELECT broker_id, CASE WHEN is_hit THEN 'HIT' WHEN is_hit IS NULL THEN 'UNKNOWN' ELSE 'MISSED' END AS hit_status, count(*) AS n FROM assess GROUP BY 1, 2",
)
def p17(d: Domain):
    return ranking.with_hit_status(d.stored_assessments).groupBy("broker_id", "hit_status").agg(F.count("*").alias("n"))


@query(
    "q27_lookahead_guard",
    """v AS (SELECT event_key, broker_id, CASE day(first_fact_date) % 4 WHEN 0 THEN 'CUTOFF_NOT_BEFORE_FACT'
      WHEN 1 THEN CASE WHEN sel_d IS NOT NULL THEN 'SELECTED_AFTER_CUTOFF' END WHEN 2 THEN CASE WHEN sel_d IS NOT NULL THEN 'SELECTED_ON_CLOSED_DAY' END END AS violation FROM assess)
    SELECT * FROM v WHERE violation IS NOT NULL""",
)
def q27(d: Domain):
    """Sound assessments, three quarters of them moved: the cutoff onto the fact, the record
    behind the cutoff, the record onto the Sunday before."""
    turn = F.day("first_fact_date") % 4
    cutoff, selected = F.col("cutoff_trading_date"), F.col("selected_classification_date")
    sunday = F.date_sub(F.date_trunc("week", cutoff).cast("date"), 1)
    moved = d.stored_assessments.withColumn(
        "selected_classification_date",
        F.when(selected.isNull(), selected).when(turn == 1, F.date_add(cutoff, 1)).when(turn == 2, sunday).otherwise(selected),
    ).withColumn("cutoff_trading_date", F.when(turn == 0, F.col("first_fact_date")).otherwise(cutoff))
    return assess.lookahead_violations(moved, d.index)


@query(
    "j21_cutoff_st_evidence",
    """SELECT DISTINCT event_key, cutoff AS cutoff_date, CASE WHEN is_st IS NULL THEN 'MISSING' WHEN is_st THEN 'ST' ELSE 'NON_ST' END AS st_state,
    is_st AND event_type = 'NEW_ST' AS contradicts_event FROM assess""",
)
def j21(d: Domain):
    return assess.cutoff_st_evidence(d.stored_events, d.st_known, d.index)


@query(
    "r4_sorted_events",
    """SELECT market_code, security_code, event_type, first_fact_date, row_number() OVER (PARTITION BY security_code ORDER BY event_type, first_fact_date)::INTEGER AS position FROM risk_ev""",
)
def r4(d: Domain):
    w = Window.partitionBy(*R.KEY).orderBy("event_type", "first_fact_date")
    return (
        d.stored_events.select(*R.KEY, "event_type", "first_fact_date", F.row_number().over(w).alias("position"))
        .orderBy(*R.KEY, "event_type", "first_fact_date")
    )


@query(
    "w12_version_conflicts",
    """SELECT market_code, security_code, d AS classification_date, count(*) AS affected_rows FROM ev
    WHERE event_type = 'click' AND isodow(d) < 6 GROUP BY 1, 2, 3 HAVING count(DISTINCT floor(amt)::INTEGER % 9) > 1""",
)
def w12_conflicts(d: Domain):
    """A history that keeps every click of a day as a record of its own."""
    raws = F.array(*[F.lit(r) for r in RAW_VALUES])
    clicks = d.events.where("event_type = 'click'").select(
        F.col("d").alias("biz_date"),
        S.business_code("security_code").alias("stk_code"),
        *[F.get(raws, ((F.floor("amt") + 3 * k) % 9).cast("int")).alias(b) for k, b in enumerate(BROKERS)],
    )
    return assess.version_conflicts(assess.wide_to_cells(clicks, BROKERS, digits=CODE_DIGITS))


@query(
    "p8_exact_mapping",
    """SELECT h.broker_id, h.raw AS raw_classification, m.bucket AS mapped_bucket, count(*) AS n FROM hist h
    LEFT JOIN mapping m ON m.broker_id = h.broker_id AND m.raw = h.raw GROUP BY 1, 2, 3""",
)
def p8(d: Domain):
    table = MAPPING.frame(d.spark).select("broker_id", "raw_classification", "mapped_bucket")
    return (
        d.long.join(F.broadcast(table), ["broker_id", "raw_classification"], "left")
        .groupBy("broker_id", "raw_classification", "mapped_bucket")
        .agg(F.count("*").alias("n"))
    )


@query(
    "p9_final_classification",
    "SELECT broker_id, final_bucket, resolution AS classification_resolution, count(*) AS n FROM bstate WHERE security_code IN (SELECT security_code FROM eligible) AND d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30' AND d >= listed_date AND (delisted_date IS NULL OR d < delisted_date) GROUP BY 1, 2, 3",
)
def p9(d: Domain):
    inside = d.days.where(F.col("trading_date").between(F.lit(START), F.lit(END)))
    states = assess.broker_states(assess.state_grid(d.eligible, inside), d.cells, d.st_known, BROKERS, MAPPING)
    return states.groupBy("broker_id", "final_bucket", "classification_resolution").agg(F.count("*").alias("n"))


@query(
    "p10_weekend_rows",
    "SELECT isodow(biz_date) >= 6 AS is_weekend, count(*) AS rows, count(*) FILTER (WHERE B01 <> '') AS filled_b01 FROM wide GROUP BY 1",
)
def p10(d: Domain):
    return d.wide.groupBy(S.is_weekend("biz_date").alias("is_weekend")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("B01") != "").alias("filled_b01")
    )


@query(
    "p12_long_history",
    """SELECT h.market_code, h.security_code, h.d AS classification_date, h.broker_id, h.raw AS raw_classification, t.next_d AS first_usable_trading_day
    FROM hist h JOIN tdays t ON t.d = h.d""",
)
def p12(d: Domain):
    return d.long.select(
        *R.KEY, "classification_date", "broker_id", "raw_classification", "first_usable_trading_day"
    )


@query("p13_event_key", "SELECT DISTINCT event_key FROM assess")
def p13(d: Domain):
    return d.stored_events.select(S.event_key().alias("event_key"))


@query(
    "p14_rates",
    f"SELECT l_suppkey, count(*) AS n, {half_up('count(*) FILTER (WHERE l_returnflag = $$R$$)', 'count(*)')} AS return_rate, {half_up('count(*)', 'count(*) FILTER (WHERE l_quantity > 1000)')} AS undefined_rate FROM lineitem GROUP BY 1",
    prelude=False,
)
def p14(d: Domain):
    counts = d.table("lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count_if(F.col("l_quantity") > 1000).alias("z"),
    )
    return dbl(counts.select("l_suppkey", "n", S.rate("r", "n").alias("return_rate"), S.rate("n", "z").alias("undefined_rate")))


@query(
    "p15_percent_text",
    """SELECT l_suppkey, printf('%d.%02d%%', (x // 100)::BIGINT, (x % 100)::BIGINT) AS share FROM (
    SELECT l_suppkey, (count(*) FILTER (WHERE l_returnflag = 'R') * 20000 + count(*)) // (2 * count(*)) AS x FROM lineitem GROUP BY 1)""",
    prelude=False,
)
def p15(d: Domain):
    counts = d.table("lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r")
    )
    return counts.select("l_suppkey", S.percent_text("r", "n").alias("share"))


@query(
    "p16_grade_bucket",
    f"SELECT broker_id, {GRADE.format(r='raw', s='sel_d')} AS grade, count(*) AS n FROM assess GROUP BY 1, 2",
)
def p16(d: Domain):
    grade = S.grade_bucket("raw_classification", "selected_classification_date")
    return d.stored_assessments.groupBy("broker_id", grade.alias("grade")).agg(F.count("*").alias("n"))
