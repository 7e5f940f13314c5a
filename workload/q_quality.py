"""Queries on rule-pack data quality."""

from datetime import date

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import quality
from earlybell.operators.panel import DAY
from earlybell.sources.staging import new_path
from workload.domain import BROKERS, CODE_DIGITS, END, MAPPING, Domain
from workload.registry import query

# --- orders as a text table with a rule pack ---------------------------------
ORDER_RULE = quality.TableRule(
    "orders",
    (
        quality.FieldRule("o_orderkey", "integer"),
        quality.FieldRule("o_custkey", "integer"),
        quality.FieldRule("o_orderdate", "date"),
        quality.FieldRule("o_orderstatus", allowed=("O", "F")),
        quality.FieldRule("o_totalprice", "decimal"),
        quality.FieldRule("o_priority_rank", "integer"),
        quality.FieldRule("available_at", "datetime", nullable=True),
        quality.FieldRule("o_comment"),
        quality.FieldRule("o_clerk", required=False),
    ),
    primary_key=("o_custkey", "o_orderdate"),
    business_date="o_orderdate",
    security_code="security_code",
    pit_fields=("available_at",),
    effective_rules=(("effective_at", "o_orderdate"),),
)
PACK_START, PACK_END = date(1996, 1, 1), date(2000, 12, 31)


def _orders_text(d: Domain):
    """Orders as text, with the imperfections that depend on the data itself."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    urgent = F.col("o_orderpriority").startswith("1")
    low = F.col("o_orderpriority").startswith("5")
    return d.table("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(urgent & (F.col("o_orderstatus") == "P"), "").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(low & (F.col("o_orderstatus") == "F"), F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(day).alias("o_orderdate"),
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.substring_index("o_orderpriority", "-", -1).alias("o_priority_rank"),
        F.when(urgent, "").when(low, F.concat(day, F.lit("T08:00:00"))).otherwise(F.concat(day, F.lit("T08:00:00+08:00"))).alias("available_at"),
        F.concat(F.date_format(F.date_add("o_orderdate", F.when(low, 1).otherwise(0)), "yyyy-MM-dd"), F.lit("T00:30:00+08:00")).alias("effective_at"),
        F.when(F.length(F.col("o_custkey").cast("string")) < 3, F.col("o_custkey").cast("string")).otherwise(F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("security_code"),
    )


OT = """WITH ot AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS d, o_orderstatus AS s, o_orderpriority AS p, starts_with(o_orderpriority, '1') AS urgent, starts_with(o_orderpriority, '5') AS low,
      starts_with(o_orderpriority, '1') AND o_orderstatus = 'P' AS no_cust, starts_with(o_orderpriority, '5') AND o_orderstatus = 'F' AS bad_date FROM orders),
    f AS ("""
OT_END = ") SELECT * FROM f WHERE affected_rows > 0"


def _finding(code: str, severity: str, field: str, cond: str) -> str:
    return f"SELECT '{code}' AS code, '{severity}' AS severity, '{field}' AS field, count(*) FILTER (WHERE {cond}) AS affected_rows FROM ot"


@query(
    "q1_schema_checks",
    """SELECT t.*, CASE WHEN code = 'E002' THEN 0 ELSE n END AS affected_rows FROM (VALUES ('orders', 'E101', '严重', 'o_comment'), ('orders', 'W101', '一般', 'effective_at'),
      ('orders', 'W101', '一般', 'security_code'), ('orders', 'W102', '一般', 'o_clerk'), ('parts', 'E002', '严重', '')) AS t(table_name, code, severity, field), (SELECT count(*) AS n FROM orders)
    UNION ALL SELECT 'orders', 'E005', '严重', '', 0 FROM (SELECT count(*) AS n FROM orders WHERE o_totalprice < 0) WHERE n = 0""",
    prelude=False,
)
def q1(d: Domain):
    text = _orders_text(d)
    rule = quality.TableRule("parts", (), ("p_partkey",))
    found = quality.schema_findings(text, ORDER_RULE, d.spark).unionByName(quality.schema_findings(None, rule, d.spark))
    nothing = d.table("orders").where("o_totalprice < 0")
    return found.unionByName(quality.empty_findings(nothing, ORDER_RULE))


@query(
    "q2_field_checks",
    OT
    + " UNION ALL ".join(
        [
            _finding("E501", "严重", "o_custkey", "no_cust"),
            _finding("E201", "严重", "o_orderdate", "bad_date"),
            _finding("E202", "严重", "o_orderstatus", "s NOT IN ('O','F')"),
            _finding("E201", "严重", "o_priority_rank", "true"),
            _finding("W701", "一般", "available_at", "urgent"),
            _finding("E201", "严重", "available_at", "low"),
        ]
    )
    + OT_END,
    prelude=False,
)
def q2(d: Domain):
    text = _orders_text(d)
    return quality.counted_findings(text, "orders", quality.field_checks(ORDER_RULE, text.columns)).drop("table_name")


@query(
    "q3_primary_key",
    OT
    + """SELECT 'E301' AS code, count(*) FILTER (WHERE no_cust) AS affected_rows FROM ot UNION ALL SELECT 'E302', coalesce(sum(n), 0)::BIGINT FROM
      (SELECT count(*) AS n FROM ot WHERE NOT no_cust GROUP BY o_custkey, CASE WHEN bad_date THEN strftime(d, '%Y/%m/%d') ELSE d::VARCHAR END HAVING count(*) > 1)"""
    + OT_END,
    prelude=False,
)
def q3(d: Domain):
    return quality.primary_key_findings(_orders_text(d), ORDER_RULE).select("code", "affected_rows")


@query(
    "q4_security_code_pattern",
    OT + _finding("E401", "严重", "security_code", "length(o_custkey::VARCHAR) < 3") + OT_END,
    prelude=False,
)
def q4(d: Domain):
    text = _orders_text(d)
    checks = [c for c in quality.row_checks(ORDER_RULE, text.columns, PACK_START, PACK_END) if c[0] == "E401"]
    return quality.counted_findings(text, "orders", checks).drop("table_name")


@query(
    "q5_date_window",
    OT + _finding("E402", "严重", "o_orderdate", "NOT bad_date AND NOT d BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'") + OT_END,
    prelude=False,
)
def q5(d: Domain):
    text = _orders_text(d)
    checks = [c for c in quality.row_checks(ORDER_RULE, text.columns, PACK_START, PACK_END) if c[0] == "E402"]
    return quality.counted_findings(text, "orders", checks).drop("table_name")


@query(
    "q6_point_in_time",
    OT
    + _finding("E701", "严重", "available_at", "NOT urgent AND NOT low AND d > DATE '2000-12-31' AND d NOT IN (SELECT d FROM ot WHERE s = 'P' AND NOT urgent AND NOT low)")
    + " UNION ALL "
    + "SELECT 'W701', '一般', 'available_at', count(*) FROM ot WHERE NOT urgent AND NOT low AND d IN (SELECT d FROM ot WHERE s = 'P' AND NOT urgent AND NOT low)"
    + " UNION ALL "
    + _finding("E702", "严重", "effective_at", "low AND NOT bad_date")
    + OT_END,
    prelude=False,
)
def q6(d: Domain):
    text = _orders_text(d)
    fetched = text.where(F.col("o_orderstatus") == "P").select(S.convert("available_at", "datetime").alias("fetched_at")).where(
        F.col("fetched_at").isNotNull()
    )
    late = [c for c in quality.row_checks(ORDER_RULE, text.columns, PACK_START, PACK_END) if c[0] == "E702"]
    found = quality.pit_findings(text, ORDER_RULE, PACK_END, fetched).unionByName(quality.counted_findings(text, "orders", late))
    return found.drop("table_name")


@query(
    "q7_table_statistics",
    """SELECT 'stock_market_daily' AS table_name, count(*) AS row_count, min(d) AS min_date, max(d) AS max_date, count(DISTINCT market_code) AS market_count, count(DISTINCT security_code) AS security_count FROM daily""",
)
def q7(d: Domain):
    return quality.table_statistics(d.daily, "stock_market_daily", DAY)


@query(
    "q8_calendar_coverage",
    """a AS (SELECT market_code, security_code, d, count(*) AS n FROM ev WHERE event_type = 'click' OR amt >= 100 GROUP BY 1, 2, 3),
    s AS (SELECT market_code, security_code, d, 1 AS n FROM a), j AS (SELECT coalesce(l.market_code, a.market_code) AS market_code, coalesce(l.d, a.d) AS d, l.d IS NOT NULL AS e, a.d IS NOT NULL AS x
      FROM (SELECT market_code, security_code, d FROM life_days) l FULL JOIN a ON a.security_code = l.security_code AND a.d = l.d),
    m AS (SELECT d, market_code, count(*) FILTER (WHERE e) AS ex, count(*) FILTER (WHERE x) AS sx, count(*) FILTER (WHERE e AND NOT x) AS mi FROM j GROUP BY 1, 2),
    g AS (SELECT d, sum(ex) AS ex, sum(sx) AS rows, sum(mi) AS mi, count(*) FILTER (WHERE ex > 0 AND sx = 0) AS mm FROM m GROUP BY 1),
    o AS (SELECT g.*, t.d IS NOT NULL AS open FROM g LEFT JOIN tdays t ON t.d = g.d)
    SELECT * FROM (SELECT 'E601' AS code, '严重' AS severity, d AS trading_date, rows::BIGINT AS affected_rows FROM o WHERE NOT open
      UNION ALL SELECT 'E602', '严重', d, ex::BIGINT FROM o WHERE open AND rows = 0 UNION ALL SELECT 'E603', '严重', d, mm FROM o WHERE rows > 0
      UNION ALL SELECT 'E604', '严重', d, mi::BIGINT FROM o WHERE rows > 0
      UNION ALL SELECT 'W605', '一般', d, count(*) FROM (SELECT a.d FROM a JOIN daily y ON y.security_code = a.security_code AND y.d = a.d WHERE y.n = 1) GROUP BY d) WHERE affected_rows > 0""",
)
def q8(d: Domain):
    rows = d.events.where((F.col("event_type") == "click") | (F.col("amt") >= 100)).select(*R.KEY, F.col("d").alias(DAY)).distinct()
    status = d.daily.select(*R.KEY, DAY, F.when(F.col("n") == 1, "停牌").otherwise("正常成交").alias("trading_status"))
    return quality.market_calendar_coverage(d.days, rows.join(status, [*R.KEY, DAY]), d.life)


@query(
    "q8_lifecycle_truncation",
    """SELECT 'W805' AS code, '一般' AS severity, s.market_code, s.security_code, count(*) AS affected_rows, min(t.d) AS first_day, max(t.d) AS last_day FROM sec s JOIN tdays t ON t.d < s.listed_date GROUP BY 3, 4
    UNION ALL SELECT 'W806', '一般', s.market_code, s.security_code, count(*), min(t.d), max(t.d) FROM sec s JOIN tdays t ON t.d >= s.delisted_date GROUP BY 3, 4""",
)
def q8b(d: Domain):
    return quality.lifecycle_truncation(d.life, d.days)


@query(
    "q9_lifecycle_consistency",
    """known AS (SELECT CASE WHEN user_id % 10 = 3 THEN 'XBSE' ELSE market_code END AS market_code, security_code, (listed_date + 2)::DATE AS listed_date, delisted_date FROM sec WHERE listed_date <= DATE '2024-01-02')
    SELECT code, '严重' AS severity, count(*) AS affected_rows FROM (SELECT CASE WHEN a.security_code IS NULL THEN 'E801' WHEN k.security_code IS NULL THEN 'E802' WHEN e.d < k.listed_date THEN 'E803' WHEN e.d >= k.delisted_date THEN 'E804' END AS code
      FROM ev e LEFT JOIN known k ON k.security_code = e.security_code AND k.market_code = e.market_code LEFT JOIN known a ON a.security_code = e.security_code) WHERE code IS NOT NULL GROUP BY 1""",
)
def q9(d: Domain):
    known = d.securities.where(F.col("listed_date") <= F.lit(date(2024, 1, 2))).select(
        F.when(F.col("user_id") % 10 == 3, "XBSE").otherwise(F.col("market_code")).alias("market_code"),
        "security_code",
        F.date_add("listed_date", 2).alias("listed_date"),
        "delisted_date",
    )
    return quality.lifecycle_consistency(d.events.withColumn(DAY, F.col("d")), known, day=DAY)


@query(
    "q10_mapping_consistency",
    """r AS (SELECT h.*, m.bucket, CASE WHEN weekday(h.d) = 1 THEN 'm0' ELSE 'm1' END AS ver, CASE WHEN weekday(h.d) = 2 THEN 'DANGEROUS' ELSE m.bucket END AS stored, 'm1:' || h.broker_id || ':' || h.raw AS rid
        FROM hist h LEFT JOIN mapping m ON m.broker_id = h.broker_id AND m.raw = h.raw)
    SELECT * FROM (SELECT 'E902' AS code, count(*) FILTER (WHERE bucket IS NULL) AS affected_rows FROM r UNION ALL SELECT 'E903', count(*) FILTER (WHERE bucket IS NOT NULL AND ver <> 'm1') FROM r
      UNION ALL SELECT 'E904', count(*) FILTER (WHERE bucket IS NOT NULL AND stored <> bucket) FROM r UNION ALL SELECT 'E905', count(*) FILTER (WHERE bucket IS NOT NULL AND weekday(d) = 3) FROM r) WHERE affected_rows > 0""",
)
def q10(d: Domain):
    table = MAPPING.frame(d.spark).select("broker_id", "raw_classification", F.col("mapped_bucket").alias("b"))
    day = F.dayofweek("classification_date") - 1
    rid = F.concat_ws(":", F.lit("m1"), "broker_id", "raw_classification")
    records = d.long.join(F.broadcast(table), ["broker_id", "raw_classification"], "left").select(
        "broker_id",
        "raw_classification",
        F.when(day == 1, "m0").otherwise("m1").alias("classification_mapping_version"),
        F.when(day == 2, "DANGEROUS").otherwise(F.col("b")).alias("standardized_risk_bucket"),
        F.when(day == 3, F.concat(rid, F.lit("?"))).otherwise(rid).alias("mapping_record_id"),
    )
    return quality.mapping_consistency(records, MAPPING).select("code", "affected_rows")


@query(
    "q11_wide_history_quality",
    """w AS (SELECT *, (B01 <> '')::INTEGER + (B02 <> '')::INTEGER + (B03 <> '')::INTEGER AS filled FROM wide)
    SELECT * FROM (SELECT 'E921' AS code, count(*) FILTER (WHERE isodow(biz_date) >= 6) AS affected_rows FROM w UNION ALL SELECT 'E922', count(*) FILTER (WHERE market_code = 'XBSE') FROM w
      UNION ALL SELECT 'E923', count(*) FILTER (WHERE isodow(biz_date) < 6 AND market_code <> 'XBSE' AND filled < 3) FROM w) WHERE affected_rows > 0""",
)
def q11(d: Domain):
    return quality.wide_quality(d.wide, BROKERS, digits=CODE_DIGITS).select("code", "affected_rows")


@query(
    "q12_quarter_coverage",
    """w AS (SELECT d, count(*) AS n, count(DISTINCT security_code) AS s FROM (SELECT DISTINCT d, security_code FROM ev WHERE event_type = 'click' AND amt >= 120) GROUP BY 1),
    c AS (SELECT t.d AS td, w.d AS wd, n, s FROM (SELECT d FROM tdays) t FULL JOIN w ON w.d = t.d), md AS (SELECT median(s) AS m FROM c WHERE td IS NOT NULL)
    SELECT code, CASE code WHEN 'E925' THEN '一般' ELSE '严重' END AS severity, finding_date, affected_rows FROM (
      SELECT CASE WHEN wd IS NULL THEN 'E925' WHEN td IS NULL THEN 'E921' WHEN s < m * 0.8 THEN 'E927' END AS code, coalesce(td, wd) AS finding_date, CASE WHEN wd IS NOT NULL AND td IS NULL THEN n ELSE 1 END AS affected_rows
      FROM c, md) WHERE code IS NOT NULL""",
)
def q12(d: Domain):
    large = d.events.where((F.col("event_type") == "click") & (F.col("amt") >= 120)).select(
        F.col("d").alias("biz_date"), F.col("security_code").alias("stk_code")
    ).distinct()
    return quality.quarter_coverage(large, d.days, (date(2024, 1, 1), date(2024, 3, 31)))


@query(
    "q14_history_integrity",
    """h AS (SELECT CASE weekday(d) WHEN 5 THEN 'h2023Q4.csv' WHEN 0 THEN 'h2024Q3.csv' ELSE 'h2024Q1.csv' END AS file_name, d AS biz_date, digits || CASE market_code WHEN 'XSHG' THEN '.SH' WHEN 'XSHE' THEN '.SZ' ELSE '.BJ' END AS stk_code FROM ev WHERE event_type = 'click' AND d <= DATE '2024-01-29'),
    f AS (SELECT * FROM h WHERE file_name <> 'h2024Q3.csv'),
    k AS (SELECT file_name, biz_date, stk_code, count(*) AS n FROM f GROUP BY 1, 2, 3)
    SELECT * FROM (SELECT file_name, 'BM103_HISTORY_KEY_DUPLICATE' AS code, sum(n - 1)::BIGINT AS affected_rows, 'ERROR' AS severity FROM k GROUP BY 1
      UNION ALL SELECT file_name, 'BM104_HISTORY_QUARTER_DATE_INVALID', count(*) FILTER (WHERE file_name = 'h2023Q4.csv'), 'ERROR' FROM f GROUP BY 1
      UNION ALL SELECT file_name, 'BM106_WEEKEND_HISTORY_ROW_IGNORED', count(*) FILTER (WHERE isodow(biz_date) >= 6), 'INFO' FROM f GROUP BY 1
      UNION ALL SELECT 'h2024Q2.csv', 'BM101_HISTORY_FILE_SET_MISMATCH', 1, 'ERROR' UNION ALL SELECT DISTINCT file_name, 'BM101_HISTORY_FILE_SET_MISMATCH', 1, 'ERROR' FROM h WHERE file_name = 'h2024Q3.csv'
      UNION ALL SELECT DISTINCT file_name, 'BM102_HISTORY_SCHEMA_MISMATCH', 1, 'ERROR' FROM h WHERE file_name = 'h2024Q3.csv'
      UNION ALL SELECT '', 'BM105_HISTORY_COVERAGE_MISSING', 1, 'ERROR') WHERE affected_rows > 0""",
)
def q14(d: Domain):
    """A stored file set: Fridays in a file of another quarter, Sundays in one that is not expected
    and lacks a broker, an expected quarter without file, and a last day that is missing."""
    suffix = F.expr("CASE market_code WHEN 'XSHG' THEN '.SH' WHEN 'XSHE' THEN '.SZ' ELSE '.BJ' END")
    weekday = F.dayofweek("d")
    rows = d.events.where((F.col("event_type") == "click") & (F.col("d") <= F.lit(date(2024, 1, 29)))).select(
        F.when(weekday == 6, "h2023Q4.csv").when(weekday == 1, "h2024Q3.csv").otherwise("h2024Q1.csv").alias("quarter"),
        F.col("d").cast("string").alias("biz_date"),
        F.concat(F.substring_index("security_code", ".", 1), suffix).alias("stk_code"),
        *[F.lit("A").alias(b) for b in BROKERS],
    )
    root = new_path(d.spark, "history")
    odd = F.col("quarter") == "h2024Q3.csv"
    for part, brokers in ((rows.where(~odd), BROKERS), (rows.where(odd), BROKERS[:-1])):
        columns = ("quarter", "biz_date", "stk_code", *brokers)
        part.select(*columns).write.mode("append").partitionBy("quarter").option("header", True).csv(root)
    one = d.days.where(F.col("market_code") == "XSHG")
    expected = ("h2023Q4.csv", "h2024Q1.csv", "h2024Q2.csv")
    return quality.history_files_integrity(d.spark, root, BROKERS, one, END, expected)


@query(
    "q_verdict_roll_up",
    OT
    + """SELECT 1 AS x) SELECT 'FAIL' AS status, false AS allow_run, count(*) FILTER (WHERE sev = 'S' AND n > 0) AS severe_count, count(*) FILTER (WHERE n > 0) AS finding_count FROM (
      SELECT 'S' AS sev, 1 AS n UNION ALL SELECT 'N', 1 UNION ALL SELECT 'N', 1 UNION ALL SELECT 'N', 1
      UNION ALL SELECT 'S', count(*) FROM ot WHERE no_cust UNION ALL SELECT 'S', count(*) FROM ot WHERE bad_date UNION ALL SELECT 'S', count(*) FROM ot WHERE s = 'P' UNION ALL SELECT 'S', count(*) FROM ot
      UNION ALL SELECT 'N', count(*) FROM ot WHERE urgent UNION ALL SELECT 'S', count(*) FROM ot WHERE low UNION ALL SELECT 'S', count(*) FROM ot WHERE length(o_custkey::VARCHAR) < 3
      UNION ALL SELECT 'S', count(*) FROM ot WHERE NOT bad_date AND NOT d BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' UNION ALL SELECT 'S', count(*) FROM ot WHERE low AND NOT bad_date
      UNION ALL SELECT 'S', count(*) FROM ot WHERE no_cust UNION ALL SELECT 'S', count(*) FROM (SELECT 1 FROM ot WHERE NOT no_cust GROUP BY o_custkey, CASE WHEN bad_date THEN strftime(d, '%Y/%m/%d') ELSE d::VARCHAR END HAVING count(*) > 1)
      UNION ALL SELECT 'S', count(*) FROM ot WHERE NOT urgent AND NOT low AND d > DATE '2000-12-31')""",
    prelude=False,
)
def q_verdict(d: Domain):
    return quality.verdict(quality.validate_table(_orders_text(d), ORDER_RULE, PACK_START, PACK_END))


