"""Queries W1-W7: versions, baselines, segments, events and pressure."""

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import events, panel
from workload.domain import PRESSURE, RULES, Domain
from workload.registry import query

SEGMENT_SQL = """
SELECT market_code, security_code, segment_number, board_code, threshold AS applicable_threshold, len AS consecutive_length,
       first_d AS first_fact_date, CASE WHEN len >= threshold THEN ds[threshold] END AS threshold_reached_date,
       last_d AS last_fact_date, len >= threshold AS threshold_reached, open_end AS open_at_observation_end, ids AS source_record_ids
FROM segments"""


@query("w4_limit_down_segments", SEGMENT_SQL)
def w4(d: Domain):
    return events.limit_down_segments(d.panel, RULES, batch_id="b1", snapshot_id="s1").select(
        *R.KEY,
        "segment_number",
        "board_code",
        "applicable_threshold",
        "consecutive_length",
        "first_fact_date",
        "threshold_reached_date",
        "last_fact_date",
        "threshold_reached",
        "open_at_observation_end",
        F.array_join("source_record_ids", ",").alias("source_record_ids"),
    )


@query(
    "w3_new_st_events",
    "SELECT market_code, security_code, 'NEW_ST' AS event_type, d AS first_fact_date, 'NON_ST' AS previous_st_state, 'ST' AS current_st_state FROM new_st",
)
def w3(d: Domain):
    return events.new_st_events(d.panel, RULES).select(
        *R.KEY, "event_type", "first_fact_date", "previous_st_state", "current_st_state"
    )


@query("w5_risk_events", "SELECT * FROM risk_ev")
def w5(d: Domain):
    return d.risk_events.select(
        *R.KEY, "event_type", "first_fact_date", "risk_date", "last_fact_date", "segment_number", "consecutive_length"
    )


@query(
    "w6_pressure_observations",
    """SELECT market_code, security_code, board_code, obs_thr AS observation_threshold, threshold AS formal_threshold,
    first_d AS first_fact_date, observation_date, last_d AS last_fact_date, len AS consecutive_length,
    upgraded AS upgraded_to_formal_risk, formal_date AS formal_risk_date, open_end AS open_at_observation_end FROM press""",
)
def w6(d: Domain):
    return events.pressure_observations(d.panel, RULES, PRESSURE).select(
        *R.KEY,
        "board_code",
        "observation_threshold",
        "formal_threshold",
        "first_fact_date",
        "observation_date",
        "last_fact_date",
        "consecutive_length",
        "upgraded_to_formal_risk",
        "formal_risk_date",
        "open_at_observation_end",
    )


@query(
    "w2_st_baseline",
    """SELECT market_code, security_code,
    CASE WHEN listed_date >= DATE '2024-01-08' THEN d ELSE
      (SELECT max(k.d) FROM st_known k WHERE k.security_code = s.security_code AND k.d < DATE '2024-01-08') END AS baseline_date,
    CASE WHEN listed_date >= DATE '2024-01-08' THEN is_st ELSE base_st END AS is_st,
    CASE WHEN listed_date >= DATE '2024-01-08' THEN 'FIRST_IN_LIFECYCLE_TRADING_DAY' ELSE 'LATEST_STATE_BEFORE_OBSERVATION_START' END AS reason
    FROM st_scan s WHERE rn = 1""",
)
def w2(d: Domain):
    return events.st_baselines(d.panel, RULES)


# --- versions, verification, totals -----------------------------------------
@query(
    "w1_latest_version",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate::DATE AS l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
    prelude=False,
)
def w1(d: Domain):
    rows = d.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return panel.latest_version(rows, ["l_orderkey"], "l_linenumber")


@query(
    "w7_verify_events",
    """k AS (SELECT p.*, last_value(CASE WHEN y.n IS NOT NULL THEN p.is_st END IGNORE NULLS) OVER (PARTITION BY p.security_code ORDER BY p.d) AS kst,
                y.n AS seen FROM panel p LEFT JOIN daily y ON y.security_code = p.security_code AND y.d = p.d),
    f AS (SELECT market_code, security_code, d, row_number() OVER w AS rn, coalesce(kst, b) AS cur, lag(coalesce(kst, b)) OVER w AS prv, b, listed_date FROM (
            SELECT k.*, (SELECT coalesce(x.is_st, false) FROM st_known x JOIN daily z ON z.security_code = x.security_code AND z.d = x.d
                         WHERE x.security_code = k.security_code AND x.d < DATE '2024-01-08' ORDER BY x.d DESC LIMIT 1) AS b FROM k)
          WINDOW w AS (PARTITION BY security_code ORDER BY d))
    SELECT market_code, security_code, 'NEW_ST' AS event_type, d AS first_fact_date FROM f
    WHERE cur AND NOT CASE WHEN rn > 1 THEN prv WHEN listed_date >= DATE '2024-01-08' THEN cur ELSE b END
    UNION ALL SELECT market_code, security_code, 'NON_ST_CONTINUOUS_LIMIT_DOWN', first_d FROM segments WHERE len >= threshold""",
)
def w7(d: Domain):
    """Re-derivation that only trusts days with a market row; a gap keeps the ST state."""
    seen = d.daily.select(*R.KEY, F.col("trading_date").alias("status_start_date"))
    status = d.risk_status.join(seen, [*R.KEY, "status_start_date"], "left_semi")
    scanned = panel.risk_panel(d.eligible, d.days, d.market, status, d.master, RULES, carry_st=True)
    return events.risk_events(scanned, RULES).select(*R.KEY, "event_type", "first_fact_date")


@query(
    "g24_batch_totals",
    """SELECT (SELECT count(*) FROM risk_ev) AS event_count, (SELECT count(DISTINCT security_code) FROM risk_ev) AS distinct_security_count,
    (SELECT count(*) FROM risk_ev WHERE event_type = 'NON_ST_CONTINUOUS_LIMIT_DOWN') AS limit_down_event_count,
    (SELECT count(*) FROM risk_ev WHERE event_type = 'NEW_ST') AS new_st_event_count,
    (SELECT count(*) FROM press) AS observation_event_count, (SELECT count(*) FROM press WHERE upgraded) AS upgraded_event_count,
    (SELECT count(DISTINCT security_code) FROM press) AS observed_security_count""",
)
def g24(d: Domain):
    return events.event_batch_totals(d.risk_events, d.pressure)


@query(
    "p6_limit_down_predicate",
    """SELECT l_returnflag, l_linestatus, count(*) AS rows,
    count(*) FILTER (WHERE l_returnflag <> 'R' AND l_linestatus = 'F' AND floor(l_extendedprice / 25) * 25 = floor(l_extendedprice)) AS limit_down_days
    FROM lineitem GROUP BY 1, 2""",
    prelude=False,
)
def p6(d: Domain):
    from earlybell.functions import scalars as S

    price = F.floor("l_extendedprice").cast("decimal(20,6)")
    limit = (F.floor(F.col("l_extendedprice") / 25) * 25).cast("decimal(20,6)") + F.lit("0.0000005").cast("decimal(20,7)")
    status = F.when(F.col("l_linestatus") == "F", "TRADED").otherwise("停牌")
    rows = d.table("lineitem").select(
        "l_returnflag",
        "l_linestatus",
        S.is_limit_down(F.col("l_returnflag") == "R", status, price, limit).alias("hit"),
    )
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows"), F.count_if("hit").alias("limit_down_days")
    )
