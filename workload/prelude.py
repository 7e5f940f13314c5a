"""Shared CTEs: the domain projection of ``workload.domain`` stated in SQL."""

PRELUDE = """
WITH ev AS (
  SELECT event_id, user_id, event_type, ts::DATE AS d, value::DECIMAL(18,2) AS amt,
         lpad(user_id::VARCHAR, greatest(6, length(user_id::VARCHAR))::INTEGER, '0') AS digits,
         CASE user_id % 3 WHEN 0 THEN 'XSHG' WHEN 1 THEN 'XSHE' ELSE 'XBSE' END AS market_code,
         lpad(user_id::VARCHAR, greatest(6, length(user_id::VARCHAR))::INTEGER, '0') || '.' ||
         CASE user_id % 3 WHEN 0 THEN 'XSHG' WHEN 1 THEN 'XSHE' ELSE 'XBSE' END AS security_code
  FROM events),
natural_days AS (
  SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM ev),
tdays AS (
  SELECT d, row_number() OVER (ORDER BY d) AS ord, lag(d) OVER (ORDER BY d) AS prev_d, lead(d) OVER (ORDER BY d) AS next_d
  FROM natural_days WHERE isodow(d) < 6),
wdays AS (
  SELECT d, ord, prev_d, next_d FROM tdays WHERE d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'),
sec AS (
  SELECT user_id, market_code, security_code, min(d) AS listed_date,
         CASE WHEN user_id % 7 = 0 THEN (min(d) + 21)::DATE END AS delisted_date,
         CASE WHEN user_id % 11 = 5 THEN 'BSE' WHEN user_id % 5 = 0 THEN 'GEM'
              WHEN user_id % 5 = 1 THEN 'KSH' ELSE 'MainBoard' END AS board_code
  FROM ev GROUP BY user_id, market_code, security_code),
master AS (
  SELECT market_code, security_code, listed_date AS status_date, board_code, listed_date, delisted_date FROM sec
  UNION ALL
  SELECT s.market_code, s.security_code, v.d, 'GEM', s.listed_date, s.delisted_date
  FROM (SELECT DISTINCT security_code, d FROM ev WHERE event_type = 'view' AND amt >= 60) v
  JOIN sec s USING (security_code) WHERE v.d > s.listed_date AND s.board_code <> 'BSE'),
eligible AS (
  SELECT market_code, security_code, listed_date, delisted_date FROM (
    SELECT *, row_number() OVER (PARTITION BY security_code ORDER BY status_date DESC) AS rn
    FROM master WHERE status_date <= DATE '2024-01-30')
  WHERE rn = 1 AND market_code <> 'XBSE' AND board_code <> 'BSE'),
daily AS (
  SELECT market_code, security_code, d, count(*) AS n, bool_or(event_type = 'error') AS has_error,
         sum(amt) AS amount, min(amt) AS low_amt, max(amt) AS high_amt, max(event_id) AS last_id,
         (1 + sum(amt))::DECIMAL(20,6) AS close_price
  FROM ev GROUP BY market_code, security_code, d),
life_days AS (
  SELECT s.market_code, s.security_code, t.d, t.ord, s.listed_date, s.delisted_date
  FROM sec s JOIN tdays t ON t.d >= s.listed_date AND (s.delisted_date IS NULL OR t.d < s.delisted_date)),
st_changes AS (
  SELECT market_code, security_code, d, arg_max(event_type = 'signup', event_id) AS is_st
  FROM ev WHERE event_type IN ('signup', 'purchase') GROUP BY market_code, security_code, d),
st_grid AS (
  SELECT s.market_code, s.security_code, t.d
  FROM sec s JOIN tdays t ON t.d >= s.listed_date AND (s.delisted_date IS NULL OR t.d <= s.delisted_date)),
st_known AS (
  SELECT g.market_code, g.security_code, g.d,
         last_value(c.is_st IGNORE NULLS) OVER (PARTITION BY g.security_code ORDER BY g.d) AS is_st
  FROM st_grid g LEFT JOIN st_changes c ON c.security_code = g.security_code AND c.d = g.d),
panel0 AS (
  SELECT e.market_code, e.security_code, e.listed_date, e.delisted_date, t.d, t.ord,
         y.n, y.close_price, y.has_error, y.last_id,
         coalesce(k.is_st, false) AS is_st
  FROM eligible e
  JOIN wdays t ON t.d >= e.listed_date AND (e.delisted_date IS NULL OR t.d < e.delisted_date)
  LEFT JOIN daily y ON y.security_code = e.security_code AND y.d = t.d
  LEFT JOIN st_known k ON k.security_code = e.security_code AND k.d = t.d),
panel AS (
  SELECT p.*, coalesce(NOT is_st AND has_error, false) AS is_limit_down,
         (SELECT CASE m.board_code WHEN 'MainBoard' THEN 'MAIN' WHEN 'GEM' THEN 'CHINEXT' WHEN 'KSH' THEN 'STAR' ELSE m.board_code END
          FROM master m WHERE m.security_code = p.security_code AND m.status_date <= p.d
          ORDER BY m.status_date DESC LIMIT 1) AS board_code
  FROM panel0 p),
run_rows AS (
  SELECT * FROM (
    SELECT *, sum(CASE WHEN is_limit_down THEN 0 ELSE 1 END) OVER (PARTITION BY security_code ORDER BY d) AS run_id,
           lead(d) OVER (PARTITION BY security_code ORDER BY d) IS NULL AS is_last
    FROM panel) WHERE is_limit_down),
runs AS (
  SELECT market_code, security_code, run_id, arg_min(board_code, d) AS board_code, count(*)::INTEGER AS len,
         min(d) AS first_d, max(d) AS last_d, bool_or(is_last) AS open_end,
         list(d ORDER BY d) AS ds, string_agg('ev-' || last_id::VARCHAR, ',' ORDER BY d) AS ids
  FROM run_rows GROUP BY market_code, security_code, run_id),
segments AS (
  SELECT *, CASE board_code WHEN 'MAIN' THEN 3 WHEN 'CHINEXT' THEN 2 WHEN 'STAR' THEN 2 END AS threshold,
         row_number() OVER (PARTITION BY security_code ORDER BY first_d)::INTEGER AS segment_number
  FROM runs WHERE len >= 2),
st_scan AS (
  SELECT p.*, row_number() OVER w AS rn, lag(is_st) OVER w AS lag_st,
         (SELECT coalesce(k.is_st, false) FROM st_known k WHERE k.security_code = p.security_code
          AND k.d < DATE '2024-01-08' ORDER BY k.d DESC LIMIT 1) AS base_st
  FROM panel p WINDOW w AS (PARTITION BY security_code ORDER BY d)),
new_st AS (
  SELECT market_code, security_code, d FROM st_scan
  WHERE is_st AND NOT CASE WHEN rn > 1 THEN lag_st WHEN listed_date >= DATE '2024-01-08' THEN is_st ELSE base_st END),
risk_ev AS (
  SELECT market_code, security_code, 'NON_ST_CONTINUOUS_LIMIT_DOWN' AS event_type, first_d AS first_fact_date,
         ds[threshold] AS risk_date, last_d AS last_fact_date, segment_number, len AS consecutive_length
  FROM segments WHERE len >= threshold
  UNION ALL
  SELECT market_code, security_code, 'NEW_ST', d, d, d, NULL, NULL FROM new_st),
press AS (
  SELECT market_code, security_code, board_code, obs_thr, threshold, first_d, ds[obs_thr] AS observation_date, last_d, len,
         len >= threshold AND len >= 2 AS upgraded, CASE WHEN len >= threshold AND len >= 2 THEN ds[threshold] END AS formal_date, open_end, ids
  FROM (SELECT *, CASE board_code WHEN 'MAIN' THEN 2 WHEN 'CHINEXT' THEN 1 WHEN 'STAR' THEN 1 END AS obs_thr,
               CASE board_code WHEN 'MAIN' THEN 3 WHEN 'CHINEXT' THEN 2 WHEN 'STAR' THEN 2 END AS threshold FROM runs)
  WHERE len >= obs_thr),
brokers AS (SELECT * FROM (VALUES ('B01', 0), ('B02', 1), ('B03', 2)) AS b(broker_id, k)),
clicks AS (
  SELECT d, user_id, market_code, security_code, digits, arg_max(amt, event_id) AS v
  FROM ev WHERE event_type = 'click' GROUP BY d, user_id, market_code, security_code, digits),
wide AS (
  SELECT d AS biz_date,
         digits || CASE market_code WHEN 'XSHG' THEN '.SH' WHEN 'XSHE' THEN '.SZ' ELSE '.BJ' END AS stk_code,
         market_code, security_code,
         ['A','B','C','D','E','F','G','','X'][(floor(v)::INTEGER % 9) + 1] AS B01,
         ['A','B','C','D','E','F','G','','X'][((floor(v)::INTEGER + 3) % 9) + 1] AS B02,
         ['A','B','C','D','E','F','G','','X'][((floor(v)::INTEGER + 6) % 9) + 1] AS B03
  FROM clicks),
hist AS (
  SELECT w.biz_date AS d, w.market_code, w.security_code, b.broker_id,
         CASE b.broker_id WHEN 'B01' THEN B01 WHEN 'B02' THEN B02 ELSE B03 END AS raw
  FROM wide w CROSS JOIN brokers b WHERE isodow(w.biz_date) < 6),
mapping AS (
  SELECT b.broker_id, g.raw,
         CASE WHEN (b.broker_id = 'B01' AND g.raw IN ('F','G')) OR (b.broker_id = 'B02' AND g.raw IN ('E','F','G'))
                OR (b.broker_id = 'B03' AND g.raw IN ('D','E','F','G')) THEN 'DANGEROUS' ELSE 'NON_DANGEROUS' END AS bucket
  FROM brokers b CROSS JOIN (SELECT unnest(['A','B','C','D','E','F','G']) AS raw) g),
act_rows AS (
  SELECT s.market_code, s.security_code, s.listed_date, s.delisted_date, b.broker_id, t.d, t.ord,
         last_value(CASE WHEN h.d IS NOT NULL THEN h.d END IGNORE NULLS) OVER w AS sel_d,
         last_value(h.raw IGNORE NULLS) OVER w AS raw
  FROM sec s CROSS JOIN brokers b CROSS JOIN tdays t
  LEFT JOIN hist h ON h.security_code = s.security_code AND h.broker_id = b.broker_id AND h.d = t.d
  WINDOW w AS (PARTITION BY s.security_code, b.broker_id ORDER BY t.d)),
bstate AS (
  SELECT a.*, k.is_st, m.bucket AS mapped,
         CASE WHEN k.is_st IS NULL THEN 'UNKNOWN' WHEN k.is_st THEN 'DANGEROUS' WHEN a.raw IS NULL THEN NULL
              WHEN a.raw = '' THEN 'NON_DANGEROUS' WHEN m.bucket IS NULL THEN 'UNKNOWN' ELSE m.bucket END AS final_bucket,
         CASE WHEN k.is_st IS NULL THEN 'ST_STATUS_MISSING' WHEN k.is_st THEN 'ST_OVERRIDE' WHEN a.raw IS NULL THEN 'NO_USABLE_CLASSIFICATION'
              WHEN a.raw = '' THEN 'BLANK_GENERAL' WHEN m.bucket IS NULL THEN 'MAPPING_UNKNOWN' ELSE 'EXACT_MAPPING' END AS resolution
  FROM act_rows a
  LEFT JOIN st_known k ON k.security_code = a.security_code AND k.d = a.d
  LEFT JOIN mapping m ON m.broker_id = a.broker_id AND m.raw = a.raw),
bbreaks AS (
  SELECT *, coalesce(max(CASE WHEN final_bucket IS DISTINCT FROM 'DANGEROUS' THEN ord END)
              OVER (PARTITION BY security_code, broker_id ORDER BY d), 0) AS brk
  FROM bstate),
bruns AS (
  SELECT *, CASE WHEN final_bucket = 'DANGEROUS' THEN
         min(CASE WHEN final_bucket = 'DANGEROUS' AND mapped = 'DANGEROUS' AND sel_d = d THEN ord END)
              OVER (PARTITION BY security_code, broker_id, brk ORDER BY d) END AS start_ord
  FROM bbreaks),
assess0 AS (
  SELECT e.market_code, e.security_code, e.event_type, e.first_fact_date, e.risk_date, t.ord AS fact_ord, t.prev_d AS cutoff,
         r.broker_id, r.sel_d, r.raw, r.is_st, r.final_bucket, r.resolution, r.start_ord, r.mapped,
         (SELECT x.d FROM tdays x WHERE x.ord = r.start_ord) AS start_d
  FROM risk_ev e JOIN tdays t ON t.d = e.first_fact_date
  JOIN bruns r ON r.security_code = e.security_code AND r.d = t.prev_d),
assess AS (
  SELECT *, market_code || '|' || security_code || '|' || event_type || '|' || first_fact_date::VARCHAR AS event_key,
         CASE WHEN final_bucket = 'UNKNOWN' THEN 'UNKNOWN' WHEN final_bucket = 'DANGEROUS' THEN 'IDENTIFIED' ELSE 'NOT_IDENTIFIED' END AS ident,
         CASE WHEN final_bucket = 'UNKNOWN' THEN NULL ELSE coalesce(final_bucket = 'DANGEROUS', false) END AS is_hit,
         CASE WHEN final_bucket = 'UNKNOWN' THEN 'UNKNOWN' WHEN final_bucket = 'DANGEROUS' AND start_ord > 1 THEN 'DEFINED'
              WHEN final_bucket = 'DANGEROUS' THEN 'UNKNOWN' ELSE 'NOT_APPLICABLE' END AS wstatus,
         CASE WHEN final_bucket = 'DANGEROUS' AND start_ord > 1 THEN (fact_ord - start_ord)::INTEGER END AS wdays,
         CASE WHEN final_bucket = 'UNKNOWN' THEN CASE resolution WHEN 'ST_STATUS_MISSING' THEN 'BM203_ST_STATUS_MISSING' ELSE 'BM301_MAPPING_UNKNOWN' END
              WHEN final_bucket = 'DANGEROUS' AND start_ord > 1 THEN 'BM300_IDENTIFIED'
              WHEN final_bucket = 'DANGEROUS' AND start_ord IS NULL THEN 'BM305_NO_BROKER_START_FOR_ST_OVERRIDE'
              WHEN final_bucket = 'DANGEROUS' THEN 'BM303_DANGEROUS_RUN_LEFT_CENSORED'
              WHEN sel_d IS NULL THEN 'BM302_NO_USABLE_CLASSIFICATION' ELSE 'BM306_FINAL_NON_DANGEROUS' END AS reason_code
  FROM assess0),
views AS (SELECT unnest(['NON_ST_CONTINUOUS_LIMIT_DOWN', 'NEW_ST', 'ALL_RISK_EVENTS']) AS v),
assess_v AS (SELECT a.*, v.v FROM assess a JOIN views v ON v.v = a.event_type OR v.v = 'ALL_RISK_EVENTS'),
bv AS (SELECT b.broker_id, v.v FROM brokers b CROSS JOIN views v),
expo AS (
  SELECT b.market_code, b.security_code, b.broker_id, b.d, b.final_bucket
  FROM bstate b JOIN eligible e USING (security_code)
  WHERE b.d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'
    AND b.d >= b.listed_date AND (b.delisted_date IS NULL OR b.d < b.delisted_date))
"""
