"""Queries on the versioned fact store, snapshots and reconciliation checks."""

from datetime import date

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import cache_import, candidate, compare, foundation, gate, panel, ranking, store
from earlybell.operators.panel import DAY
from earlybell.sources import sinks
from earlybell.sources.staging import new_path
from workload.domain import CODE_DIGITS, END, RULES, START, Domain
from workload.imports import IMPORT_SQL, imported
from workload.q_assess import dbl
from workload.q_calendar import COVER_SQL, OTHER_SQL, SUSP_SQL, _dated_facts, _limits, _other_life, _suspension
from workload.registry import query

PAYLOAD = ("price", "quantity")


def _payload_columns(df, price, quantity):
    return (
        df.withColumn("price", F.col(price).cast("decimal(20,6)"))
        .withColumn("quantity", F.col(quantity).cast("decimal(20,6)"))
        .withColumn("payload_hash", S.payload_hash(PAYLOAD))
    )


def _store(d: Domain):
    """Facts from order lines: the order is the fact, its line number the version.

    Lines are shuffled once, by the key that the operators on facts group and join on.
    """
    lines = d.table("lineitem").withColumn("business_key", F.col("l_orderkey").cast("string")).repartition("business_key")
    rows = lines.groupBy("business_key", "l_orderkey", "l_linenumber").agg(
        F.max(F.struct("l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag")).alias("x")
    )
    flat = rows.select(
        F.lit("daily_price_unadjusted").alias("dataset_id"),
        "business_key",
        F.expr("CASE l_orderkey % 3 WHEN 0 THEN 'XSHG' WHEN 1 THEN 'XSHE' ELSE 'XBSE' END").alias("market_code"),
        F.col("x.l_shipdate").cast("date").alias("business_date"),
        F.col("l_linenumber").alias("source_record_version"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber") - 1).alias("supersedes_version"),
        F.when(F.col("x.l_returnflag") == "N", "").otherwise(F.col("x.l_returnflag")).alias("source_request_id"),
        F.col("x.l_extendedprice").alias("p"),
        F.col("x.l_quantity").alias("q"),
    )
    return _payload_columns(flat, "p", "q").drop("p", "q").withColumn(
        "partition_id", F.concat_ws("|", "market_code", F.date_format("business_date", "yyyy-MM"))
    )


def _incoming(d: Domain):
    """A batch: the latest shipped line of each order, plus orders without lines.

    One fold by the key: any line goes before the order itself.
    """
    lines = d.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("business_key"), F.lit(1).alias("line"), "l_shipdate", "l_extendedprice", "l_quantity"
    )
    bare = d.table("orders").select(
        F.col("o_orderkey").cast("string").alias("business_key"),
        F.lit(0).alias("line"),
        F.lit(None).cast(lines.schema["l_shipdate"].dataType).alias("l_shipdate"),
        F.col("o_totalprice").alias("l_extendedprice"),
        F.lit(0.0).alias("l_quantity"),
    )
    best = F.max(F.struct("line", "l_shipdate", "l_extendedprice", "l_quantity")).alias("x")
    both = lines.unionByName(bare).groupBy("business_key").agg(best).select(
        F.lit("daily_price_unadjusted").alias("dataset_id"), "business_key", "x.l_extendedprice", "x.l_quantity"
    )
    return _payload_columns(both, "l_extendedprice", "l_quantity").select(
        "dataset_id", "business_key", "price", "quantity", "payload_hash"
    )


STORE_SQL = """WITH st AS (SELECT 'daily_price_unadjusted' AS dataset_id, l_orderkey::VARCHAR AS business_key, CASE l_orderkey % 3 WHEN 0 THEN 'XSHG' WHEN 1 THEN 'XSHE' ELSE 'XBSE' END AS market_code,
      x.d::DATE AS business_date, l_linenumber AS source_record_version, CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 END AS supersedes_version,
      CASE WHEN x.f = 'N' THEN '' ELSE x.f END AS source_request_id, x.p::DECIMAL(20,6) AS price, x.q::DECIMAL(20,6) AS quantity,
      sha256('{"price":"' || x.p::DECIMAL(20,6)::VARCHAR || '","quantity":"' || x.q::DECIMAL(20,6)::VARCHAR || '"}') AS payload_hash,
      CASE l_orderkey % 3 WHEN 0 THEN 'XSHG' WHEN 1 THEN 'XSHE' ELSE 'XBSE' END || '|' || strftime(x.d, '%Y-%m') AS partition_id
    FROM (SELECT l_orderkey, l_linenumber, max({'p': l_extendedprice, 'q': l_quantity, 'd': l_shipdate, 'f': l_returnflag}) AS x FROM lineitem GROUP BY 1, 2)),
  cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY business_key ORDER BY source_record_version DESC) AS rn FROM st) WHERE rn = 1),
  inc0 AS (SELECT l_orderkey::VARCHAR AS business_key, x.p AS p, x.q AS q FROM (SELECT l_orderkey, max({'d': l_shipdate, 'p': l_extendedprice, 'q': l_quantity}) AS x FROM lineitem GROUP BY 1)
    UNION ALL SELECT o_orderkey::VARCHAR, o_totalprice, 0.0 FROM orders o ANTI JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
  inc AS (SELECT business_key, sha256('{"price":"' || p::DECIMAL(20,6)::VARCHAR || '","quantity":"' || q::DECIMAL(20,6)::VARCHAR || '"}') AS payload_hash FROM inc0),
  wr AS (SELECT i.business_key, i.payload_hash, (coalesce(c.source_record_version, 0) + 1)::INTEGER AS source_record_version, c.source_record_version AS supersedes_version
    FROM inc i LEFT JOIN cur c USING (business_key) WHERE c.business_key IS NULL OR c.payload_hash <> i.payload_hash)
"""


@query("v1_append_versions", STORE_SQL + "SELECT * FROM wr", prelude=False)
def v1(d: Domain):
    written = store.append_versions(_store(d), _incoming(d))
    return written.select("business_key", "payload_hash", "source_record_version", "supersedes_version")


@query(
    "v1_append_summary",
    STORE_SQL + "SELECT (SELECT count(*) FROM inc) AS input_rows, (SELECT count(*) FROM wr) AS written_rows, (SELECT count(*) FROM inc) - (SELECT count(*) FROM wr) AS idempotent_rows",
    prelude=False,
)
def v1b(d: Domain):
    incoming = _incoming(d)
    return store.append_summary(incoming, store.append_versions(_store(d), incoming))


@query(
    "v1_batch_conflicts",
    STORE_SQL + "SELECT dataset_id, business_key FROM st GROUP BY ALL HAVING count(DISTINCT payload_hash) > 1",
    prelude=False,
)
def v1_conflicts(d: Domain):
    """A batch that holds every line of an order under the order's key."""
    return store.batch_conflicts(_store(d))


@query(
    "v2_current_view",
    STORE_SQL + "SELECT business_key, market_code, business_date, source_record_version, price::DOUBLE AS price, payload_hash FROM cur",
    prelude=False,
)
def v2(d: Domain):
    return dbl(
        store.current_view(_store(d)).select(
            "business_key", "market_code", "business_date", "source_record_version", "price", "payload_hash"
        )
    )


WORDS = ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::HUGEINT)::VARCHAR AS w{i}" for i in range(4))


@query(
    "v3_snapshot_digest",
    STORE_SQL
    + f""", m AS (SELECT market_code, sha256(concat_ws('|', dataset_id, business_key, source_record_version::VARCHAR, payload_hash, partition_id)) AS h FROM cur),
    s AS (SELECT market_code, count(*) AS member_count, {WORDS} FROM m GROUP BY 1)
    SELECT market_code, member_count, sha256(concat_ws('|', member_count::VARCHAR, w0, w1, w2, w3)) AS member_hash FROM s""",
    prelude=False,
)
def v3(d: Domain):
    manifest = store.snapshot_manifest(_store(d)).withColumn("market_code", F.substring("partition_id", 1, 4))
    return store.member_digest(manifest, ["market_code"])


@query(
    "j14_snapshot_read",
    STORE_SQL + "SELECT business_key, source_record_version, payload_hash, source_request_id FROM cur",
    prelude=False,
)
def j14(d: Domain):
    facts = _store(d)
    return store.read_snapshot(store.snapshot_manifest(facts), facts).select(
        "business_key", "source_record_version", "payload_hash", "source_request_id"
    )


@query(
    "j15_receipt_override",
    STORE_SQL
    + """SELECT business_key, source_record_version, payload_hash FROM wr UNION ALL
    SELECT business_key, source_record_version, payload_hash FROM cur WHERE business_key NOT IN (SELECT business_key FROM wr)""",
    prelude=False,
)
def j15(d: Domain):
    facts = _store(d)
    receipts = store.append_versions(facts, _incoming(d)).withColumn("partition_id", F.lit("new"))
    return store.override_selection(store.snapshot_manifest(facts), receipts).select(
        "business_key", "source_record_version", "payload_hash"
    )


@query(
    "v8_append_receipts",
    STORE_SQL
    + """SELECT i.business_key, i.payload_hash, max(s.source_record_version) AS source_record_version FROM inc i
    LEFT JOIN st s ON s.business_key = i.business_key AND s.payload_hash = i.payload_hash GROUP BY 1, 2""",
    prelude=False,
)
def v8(d: Domain):
    return store.append_receipts(_incoming(d), _store(d)).select("business_key", "payload_hash", "source_record_version")


@query(
    "w18_version_chain",
    STORE_SQL
    + """SELECT business_key, source_record_version, expected_version FROM (SELECT *, row_number() OVER (PARTITION BY business_key ORDER BY source_record_version) AS expected_version FROM st)
    WHERE source_record_version <> expected_version OR (source_record_version = 1 AND supersedes_version IS NOT NULL) OR (source_record_version > 1 AND supersedes_version <> source_record_version - 1)""",
    prelude=False,
)
def w18(d: Domain):
    return store.version_chain_issues(_store(d), bucket=4).select("business_key", "source_record_version", "expected_version")


@query(
    "q21_payload_evidence",
    STORE_SQL
    + "SELECT 'MDFRQ016' AS rule_id, dataset_id || '|' || business_key || '|' || source_record_version::VARCHAR AS issue_key FROM st WHERE source_request_id = ''",
    prelude=False,
)
def q21(d: Domain):
    return foundation.payload_evidence(_store(d), PAYLOAD).select("rule_id", "issue_key")


@query(
    "p18_payload_hash",
    STORE_SQL + "SELECT business_key, source_record_version, payload_hash FROM st",
    prelude=False,
)
def p18(d: Domain):
    return _store(d).select("business_key", "source_record_version", "payload_hash")


# --- snapshot exports -------------------------------------------------------
def _datasets(d: Domain):
    prices = d.daily.join(_limits(d), [*R.KEY, DAY], "left")
    one = d.days.where(F.col("market_code") == "XSHG")
    return foundation.six_datasets(
        one, d.securities.drop("user_id"), prices, d.st_changes, _suspension(d), R.MARKETS, date(2024, 1, 1), END
    )


def _fact_rows(d: Domain):
    """The six datasets as fact rows of version 1."""
    out = None
    for name, df in _datasets(d).items():
        day = "effective_start" if name == "instrument_master_history" else "business_date"
        values = [c for c in df.columns if c not in ("business_date",)]
        row = df.withColumn("dataset_id", F.lit(name)).withColumn("business_key", S.business_key(name)).select(
            "dataset_id",
            "business_key",
            "market_code",
            F.col(day).alias("business_date"),
            (F.col("is_trading_day") if name == "market_calendar" else F.lit(None).cast("boolean")).alias("is_trading_day"),
            F.lit(1).alias("source_record_version"),
            S.payload_hash(values).alias("payload_hash"),
            F.concat_ws("|", F.lit(name), "market_code").alias("partition_id"),
        )
        out = row if out is None else out.unionByName(row)
    return out


SIX_SQL = (
    SUSP_SQL
    + f""", six AS (SELECT 'market_calendar' AS dataset_id, m.market_code, n.d FROM natural_days n CROSS JOIN (SELECT unnest(['XSHG','XSHE','XBSE']) AS market_code) m
    UNION ALL SELECT 'instrument_master_history', market_code, greatest(listed_date, DATE '2024-01-01') FROM sec
    UNION ALL SELECT 'daily_price_unadjusted', market_code, d FROM daily UNION ALL SELECT 'daily_price_limits', market_code, d FROM daily
    UNION ALL SELECT 'daily_st_status', c.market_code, c.d FROM st_changes c JOIN sec s USING (security_code) WHERE c.d >= s.listed_date AND (s.delisted_date IS NULL OR c.d < s.delisted_date)
    UNION ALL SELECT 'daily_suspension_status', market_code, d FROM susp)"""
)


@query("p21_six_datasets", SIX_SQL + " SELECT dataset_id, market_code, count(*) AS rows, min(d) AS first_day, max(d) AS last_day FROM six GROUP BY 1, 2")
def p21(d: Domain):
    return _fact_rows(d).groupBy("dataset_id", "market_code").agg(
        F.count("*").alias("rows"), F.min("business_date").alias("first_day"), F.max("business_date").alias("last_day")
    )


@query(
    "p19_business_key",
    SUSP_SQL
    + """, keyed AS (SELECT 'daily_price_unadjusted' AS dataset_id, market_code, security_code, d FROM daily
      UNION ALL SELECT 'daily_price_limits', market_code, security_code, d FROM daily
      UNION ALL SELECT 'daily_st_status', c.market_code, c.security_code, c.d FROM st_changes c JOIN sec s USING (security_code) WHERE c.d >= s.listed_date AND (s.delisted_date IS NULL OR c.d < s.delisted_date)
      UNION ALL SELECT 'daily_suspension_status', market_code, security_code, d FROM susp
      UNION ALL SELECT 'instrument_master_history', market_code, security_code, greatest(listed_date, DATE '2024-01-01') FROM sec)
    SELECT dataset_id, market_code || '|' || security_code || '|' || d::VARCHAR AS business_key FROM keyed
    UNION ALL SELECT 'market_calendar', market_code || '|' || d::VARCHAR FROM natural_days CROSS JOIN (SELECT unnest(['XSHG','XSHE','XBSE']) AS market_code)""",
)
def p19(d: Domain):
    return _fact_rows(d).select("dataset_id", "business_key")


@query(
    "p19_required_fields",
    """SELECT 'REQUIRED_FIELD_MISSING' AS code, 'daily_price_unadjusted' AS dataset_id, field, count(*) AS affected_rows
    FROM (SELECT CASE WHEN n % 5 = 0 THEN 'market_code' WHEN last_id % 7 = 0 THEN 'security_code' END AS field FROM daily) WHERE field IS NOT NULL GROUP BY field""",
)
def p19_required(d: Domain):
    """Daily facts, some with their market blanked and some without code."""
    facts = d.daily.select(
        F.when(F.col("n") % 5 == 0, " ").otherwise(F.col("market_code")).alias("market_code"),
        F.when(F.col("last_id") % 7 != 0, F.col("security_code")).alias("security_code"),
        F.col("trading_date").alias("business_date"),
    )
    return foundation.missing_key_parts(facts, "daily_price_unadjusted")


@query(
    "v6_evaluation_inputs",
    SIX_SQL + " SELECT dataset_id, market_code, count(*) AS rows FROM six WHERE dataset_id IN ('market_calendar','instrument_master_history','daily_st_status') GROUP BY 1, 2",
)
def v6(d: Domain):
    facts = _fact_rows(d)
    return store.evaluation_inputs(facts, store.snapshot_manifest(facts)).groupBy("dataset_id", "market_code").agg(
        F.count("*").alias("rows")
    )


def _imported_store(d: Domain):
    """The imported facts as version 1 of a store, and the manifest of all of them."""
    _, result = imported(d)
    part = F.concat_ws("|", "dataset_id", "market_code", "year", "month")
    facts = cache_import.read_import(d.spark, result.path).withColumn("source_record_version", F.lit(1)).withColumn("partition_id", part)
    return facts, store.snapshot_manifest(facts)


@query(
    "v4_calendar_export",
    IMPORT_SQL
    + """ SELECT market_code, d AS calendar_date, 1 AS record_version, flag AS is_trading_day, CASE WHEN flag THEN '正常开市' ELSE '休市' END AS trading_session_status
      FROM met WHERE verdict = 'K' AND dataset_id = 'market_calendar' AND d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'""",
)
def v4_calendar(d: Domain):
    return store.export_calendar(*_imported_store(d), START, END)


@query(
    "v4_risk_status_export",
    IMPORT_SQL
    + """ SELECT market_code, security_code, 'ST' AS risk_status_type, CASE WHEN flag THEN '生效' ELSE '未生效' END AS risk_status_value, d AS status_start_date, d AS status_end_date, 1 AS record_version
      FROM met WHERE verdict = 'K' AND dataset_id = 'daily_st_status' AND d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'""",
)
def v4_risk_status(d: Domain):
    return store.export_risk_status(*_imported_store(d), START, END)


@query(
    "v6_evaluation_tables",
    IMPORT_SQL
    + """, kept AS (SELECT * FROM met WHERE verdict = 'K'), s AS (SELECT DISTINCT k.market_code, k.security_code, x.listed_date, x.delisted_date FROM kept k JOIN sec x USING (security_code) WHERE dataset_id = 'instrument_master_history'),
    r AS (SELECT market_code, security_code, listed_date, CASE WHEN day(listed_date) = 2 THEN (delisted_date + 1)::DATE ELSE delisted_date END AS delisted_date FROM sec WHERE market_code <> 'XBSE')
    SELECT 'calendar' AS input, market_code, NULL AS security_code, d AS first_day, d AS last_day, 'true' AS value FROM kept WHERE dataset_id = 'market_calendar' AND market_code = 'XSHG' AND flag AND d <= DATE '2024-01-30'
    UNION ALL SELECT 'lifecycle', coalesce(s.market_code, r.market_code), coalesce(s.security_code, r.security_code), coalesce(s.listed_date, r.listed_date), CASE WHEN s.security_code IS NULL THEN r.delisted_date ELSE s.delisted_date END,
      CASE WHEN s.security_code IS NULL THEN 'SUPPLEMENTED' WHEN r.security_code IS NOT NULL AND (s.listed_date <> r.listed_date OR s.delisted_date IS DISTINCT FROM r.delisted_date) THEN 'CONFLICT' ELSE 'SNAPSHOT' END
      FROM s FULL JOIN r ON s.security_code = r.security_code
    UNION ALL SELECT 'st_status', market_code, security_code, d, d, CASE WHEN flag THEN '生效' ELSE '未生效' END FROM kept WHERE dataset_id = 'daily_st_status' AND d <= DATE '2024-01-30'""",
)
def v6_tables(d: Domain):
    """All typed rows; the reference knows every security, and another end for those listed on a 2nd."""
    moved = F.when(F.dayofmonth("listed_date") == 2, F.date_add("delisted_date", 1)).otherwise(F.col("delisted_date"))
    tables = store.evaluation_tables(*_imported_store(d), END, d.life.withColumn("delisted_date", moved))
    row = lambda name, code, first, last, value: tables[name].select(
        F.lit(name).alias("input"), "market_code", code.alias("security_code"), F.col(first).alias("first_day"), F.col(last).alias("last_day"), value.alias("value")
    )
    code = F.col("security_code")
    days = row("calendar", F.lit(None).cast("string"), "calendar_date", "calendar_date", F.col("is_trading_day").cast("string"))
    lives = row("lifecycle", code, "listed_date", "delisted_date", F.col("origin"))
    return days.unionByName(lives).unionByName(row("st_status", code, "status_start_date", "status_end_date", F.col("risk_status_value")))


@query("c12_snapshot_trading_dates", "SELECT d AS business_date FROM tdays")
def c12(d: Domain):
    facts = _fact_rows(d)
    return store.snapshot_trading_dates(facts, store.snapshot_manifest(facts))


@query(
    "v4_security_status_export",
    SUSP_SQL
    + """, r AS (SELECT *, (lead(status_date) OVER (PARTITION BY security_code ORDER BY status_date) - 1)::DATE AS eend FROM master),
    x AS (SELECT r.market_code, r.security_code, n.d, r.board_code, r.listed_date, r.delisted_date FROM r JOIN natural_days n ON n.d >= r.status_date AND n.d >= r.listed_date AND (r.eend IS NULL OR n.d <= r.eend)
      WHERE r.market_code <> 'XBSE')
    SELECT x.market_code, x.security_code, x.d AS status_date, x.board_code, CASE WHEN x.d >= x.delisted_date THEN 'Delisted' ELSE 'Active' END AS lifecycle_status, x.listed_date, x.delisted_date,
      CASE WHEN x.d >= x.delisted_date THEN '终止' WHEN s.is_suspended THEN '停牌' ELSE '正常' END AS trading_eligibility_status
    FROM x LEFT JOIN susp s ON s.security_code = x.security_code AND s.d = x.d""",
)
def v4(d: Domain):
    ranges = store.effective_ranges(
        d.master.select(
            *R.KEY,
            F.col("status_date").alias("effective_start"),
            "board_code",
            F.col("listed_date").alias("listing_date"),
            F.col("delisted_date").alias("termination_date"),
        )
    )
    cal = d.calendar.select(
        F.explode(F.when(F.col("market_code") == "cn", F.array(F.lit("XSHE"))).otherwise(F.array("market_code"))).alias("market_code"),
        "calendar_date",
    )
    return store.export_security_status(ranges, cal, _suspension(d))


@query(
    "v5_adjusted_price_export",
    SUSP_SQL
    + """ SELECT s.market_code, s.security_code, s.d AS trading_date, CASE WHEN s.is_suspended THEN '停牌' ELSE '正常成交' END AS trading_status,
      p.close_price::DOUBLE AS previous_close, y.close_price::DOUBLE AS close_price FROM susp s JOIN tdays t ON t.d = s.d
      LEFT JOIN daily y ON y.security_code = s.security_code AND y.d = s.d LEFT JOIN daily p ON p.security_code = s.security_code AND p.d = t.prev_d
    WHERE s.d BETWEEN DATE '2024-01-08' AND DATE '2024-01-30'""",
)
def v5(d: Domain):
    return dbl(store.export_adjusted_prices(_suspension(d), d.daily, d.index, START, END))


@query(
    "v7_adjusted_price_merge",
    """prior AS (SELECT market_code, security_code, d, close_price FROM daily WHERE d <= DATE '2024-01-18'),
    fresh AS (SELECT market_code, security_code, d, (1 + sum(amt))::DECIMAL(20,6) AS close_price FROM ev WHERE event_type <> 'view' AND d >= DATE '2024-01-18' GROUP BY 1, 2, 3),
    re AS (SELECT market_code, security_code, d, (1 + sum(amt))::DECIMAL(20,6) AS close_price FROM ev WHERE event_type <> 'view' GROUP BY 1, 2, 3),
    bad AS (SELECT p.security_code FROM prior p LEFT JOIN fresh f ON f.security_code = p.security_code AND f.d = p.d WHERE p.d = DATE '2024-01-18' AND (f.d IS NULL OR abs(p.close_price - f.close_price) > 0.0001))
    SELECT market_code, security_code, d AS trading_date, close_price::DOUBLE AS close_price, 'REBUILT' AS source FROM re WHERE security_code IN (SELECT security_code FROM bad)
    UNION ALL SELECT market_code, security_code, d, close_price::DOUBLE, 'APPENDED' FROM (SELECT * FROM prior WHERE d < DATE '2024-01-18' UNION ALL SELECT * FROM fresh)
    WHERE security_code NOT IN (SELECT security_code FROM bad)""",
)
def v7(d: Domain):
    overlap = date(2024, 1, 18)
    rebuilt = (
        d.events.where(F.col("event_type") != "view")
        .groupBy(*R.KEY, F.col("d").alias(DAY))
        .agg((F.lit(1) + F.sum("amt")).cast("decimal(20,6)").alias("close_price"))
    )
    prior = d.daily.where(F.col(DAY) <= F.lit(overlap)).select(*R.KEY, DAY, "close_price")
    fresh = rebuilt.where(F.col(DAY) >= F.lit(overlap))
    return dbl(store.merge_adjusted_prices(prior, fresh, rebuilt, overlap))


# --- reconciliation checks --------------------------------------------------
KEYTEXT = "market_code || '|' || security_code || '|' || d::VARCHAR"


@query(
    "q15_calendar_gaps",
    """w AS (SELECT DISTINCT market_code, d FROM ev WHERE market_code <> 'XBSE' AND event_type = 'error' AND amt >= 150)
    SELECT 'MDFRQ002' AS rule_id, m.market_code, 'MISSING|' || n.d::VARCHAR AS issue_key FROM natural_days n CROSS JOIN (SELECT unnest(['XSHG','XSHE']) AS market_code) m
    ANTI JOIN w ON w.market_code = m.market_code AND w.d = n.d WHERE n.d BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'""",
)
def q15(d: Domain):
    rows = d.events.where((F.col("event_type") == "error") & (F.col("amt") >= 150))
    cal = rows.select("market_code", F.col("d").alias("calendar_date"), (F.weekday("d") < 5).alias("is_trading_day")).distinct()
    return foundation.calendar_gaps(cal, R.RISK_MARKETS, date(2024, 1, 1), END).select("rule_id", "market_code", "issue_key")


@query(
    "q16_master_matches_universe",
    OTHER_SQL
    + """ SELECT 'MDFRQ003' AS rule_id, 'MISSING_OR_MISMATCH|' || s.security_code AS issue_key FROM (SELECT * FROM sec WHERE market_code <> 'XBSE') s ANTI JOIN other o ON o.security_code = s.security_code
      AND o.market_code = s.market_code AND o.listed_date = s.listed_date AND o.delisted_date IS NOT DISTINCT FROM s.delisted_date
    UNION ALL SELECT 'MDFRQ003', 'EXTRA|' || o.security_code FROM other o WHERE o.market_code = 'XBSE'""",
)
def q16(d: Domain):
    universe = d.life.where(F.col("market_code") != "XBSE")
    return foundation.master_matches_universe(
        universe, _other_life(d), ("market_code", "listed_date", "delisted_date")
    ).select("rule_id", "issue_key")


def _bars(d: Domain):
    return d.daily.select(
        *R.KEY,
        DAY,
        F.col("low_amt").alias("open_price"),
        F.col("high_amt").alias("high_price"),
        F.col("low_amt").alias("low_price"),
        F.col("high_amt").alias("close_price"),
        (F.col("n") - 1).cast("decimal(24,6)").alias("volume"),
        F.when(F.col("n") == 1, F.lit(0)).otherwise(F.col("amount")).cast("decimal(24,6)").alias("amount"),
    )


@query(
    "q17_facts_outside_lifecycle",
    """SELECT 'MDFRQ004' AS rule_id, 'daily_price_unadjusted' AS dataset_id, y.market_code, y.market_code || '|' || y.security_code || '|' || y.d::VARCHAR AS issue_key
    FROM daily y JOIN sec s USING (security_code) LEFT JOIN tdays t ON t.d = y.d
    WHERE y.d < s.listed_date OR t.d IS NULL OR y.d > s.delisted_date OR (y.d = s.delisted_date AND NOT (y.n = 1))""",
)
def q17(d: Domain):
    bars = _bars(d)
    return foundation.facts_outside_lifecycle(bars, d.life, d.days, "daily_price_unadjusted", prices=bars)


@query(
    "q17_terminal_markers",
    """SELECT 'MDFRQ019' AS rule_id, 'daily_price_unadjusted' AS dataset_id, y.market_code, y.market_code || '|' || y.security_code || '|' || y.d::VARCHAR AS issue_key
    FROM daily y JOIN sec s ON s.security_code = y.security_code AND s.delisted_date = y.d WHERE y.n = 1""",
)
def q17b(d: Domain):
    bars = _bars(d)
    return foundation.terminal_markers(bars, d.life, "daily_price_unadjusted", bars)


@query(
    "q18_daily_coverage",
    SUSP_SQL
    + f""" SELECT 'MDFRQ005' AS rule_id, 'daily_st_status' AS dataset_id, market_code, {KEYTEXT} AS issue_key FROM life_days l ANTI JOIN st_changes c ON c.security_code = l.security_code AND c.d = l.d
    UNION ALL SELECT 'MDFRQ006', 'daily_price_limits', market_code, {KEYTEXT} FROM susp s ANTI JOIN limits x ON x.security_code = s.security_code AND x.d = s.d WHERE NOT s.is_suspended AND s.market_code <> 'XBSE'""",
)
def q18(d: Domain):
    expected = panel.expected_days(d.life, d.days).select(*R.KEY, DAY)
    traded = foundation.traded_days(expected, _suspension(d)).where(F.col("market_code") != "XBSE")
    return foundation.missing_expected(expected, d.st_changes, "MDFRQ005", "daily_st_status").unionByName(
        foundation.missing_expected(traded, _limits(d), "MDFRQ006", "daily_price_limits")
    )


@query(
    "q19_price_limit_keys",
    f"SELECT 'MDFRQ007' AS rule_id, market_code, {KEYTEXT} AS issue_key FROM daily WHERE market_code <> 'XBSE' AND NOT has_error",
)
def q19(d: Domain):
    return foundation.price_limit_key_mismatch(d.daily, _limits(d)).select("rule_id", "market_code", "issue_key")


@query(
    "q19_priced_while_suspended",
    f"""SELECT 'MDFRQ008' AS rule_id, market_code, {KEYTEXT} AS issue_key FROM daily WHERE market_code <> 'XBSE' AND (security_code, d) IN (SELECT (security_code, d) FROM st_changes WHERE is_st)""",
)
def q19b(d: Domain):
    halted = d.st_changes.select(*R.KEY, DAY, F.col("is_st").alias("is_suspended"))
    return foundation.priced_while_suspended(d.daily, halted).select("rule_id", "market_code", "issue_key")


@query(
    "q20_value_checks",
    f"""SELECT 'MDFRQ009' AS rule_id, {KEYTEXT} AS issue_key FROM (SELECT market_code, security_code, d, arg_min(amt, event_id) AS o, arg_max(amt, event_id) AS c, max(amt) FILTER (WHERE event_type <> 'view') AS h, min(amt) FILTER (WHERE event_type <> 'click') AS l
      FROM ev GROUP BY 1, 2, 3) WHERE market_code <> 'XBSE' AND (h IS NULL OR l IS NULL OR h < greatest(o, l, c) OR l > least(o, h, c))
    UNION ALL SELECT 'MDFRQ010', {KEYTEXT} FROM (SELECT market_code, security_code, d, max(amt) FILTER (WHERE event_type = 'error') AS up, max(amt) FILTER (WHERE event_type = 'click') AS dn FROM ev GROUP BY 1, 2, 3)
      WHERE market_code <> 'XBSE' AND (up IS NULL OR dn IS NULL OR up < dn)
    UNION ALL SELECT 'MDFRQ011', {KEYTEXT} FROM st_known WHERE is_st IS NULL""",
)
def q20(d: Domain):
    by_day = d.events.groupBy(*R.KEY, F.col("d").alias(DAY))
    kind = F.col("event_type")
    bars = by_day.agg(
        F.min_by("amt", "event_id").alias("open_price"),
        F.max_by("amt", "event_id").alias("close_price"),
        F.max(F.when(kind != "view", F.col("amt"))).alias("high_price"),
        F.min(F.when(kind != "click", F.col("amt"))).alias("low_price"),
        F.count("*").alias("volume"),
        F.sum("amt").alias("amount"),
    )
    limits = by_day.agg(
        F.max(F.when(kind == "error", F.col("amt"))).alias("limit_up_price"),
        F.max(F.when(kind == "click", F.col("amt"))).alias("limit_down_price"),
    )
    found = (
        foundation.invalid_prices(bars)
        .unionByName(foundation.invalid_limits(limits))
        .unionByName(foundation.null_flags(d.st_known, "is_st", "daily_st_status"))
    )
    return found.select("rule_id", "issue_key")


@query(
    "q22_known_gaps",
    SUSP_SQL
    + """ SELECT market_code, count(*) AS affected_rows, CASE WHEN market_code = 'XBSE' THEN 'INFO' ELSE 'SEVERE' END AS severity FROM susp s ANTI JOIN limits x ON x.security_code = s.security_code AND x.d = s.d
    WHERE NOT s.is_suspended GROUP BY 1""",
)
def q22(d: Domain):
    expected = panel.expected_days(d.life, d.days).select(*R.KEY, DAY)
    found = foundation.missing_expected(foundation.traded_days(expected, _suspension(d)), _limits(d), "MDFRQ017", "daily_price_limits")
    return found.groupBy("market_code").agg(F.count("*").alias("affected_rows")).withColumn(
        "severity", F.when(F.col("market_code").isin(*R.RISK_MARKETS), "SEVERE").otherwise("INFO")
    )


@query(
    "q23_complete_dates",
    COVER_SQL
    + """, e AS (SELECT x.dataset_id, m.market_code, t.d FROM tdays t CROSS JOIN (SELECT unnest(['XSHG','XSHE']) AS market_code) m CROSS JOIN (SELECT unnest(['daily_price_unadjusted','daily_st_status']) AS dataset_id) x),
    a AS (SELECT DISTINCT * FROM facts WHERE market_code <> 'XBSE'),
    j AS (SELECT coalesce(e.dataset_id, a.dataset_id) AS dataset_id, coalesce(e.market_code, a.market_code) AS market_code, e.d AS ed, a.d AS ad FROM e FULL JOIN a ON a.dataset_id = e.dataset_id AND a.market_code = e.market_code AND a.d = e.d)
    SELECT dataset_id, market_code, count(ed) AS expected_dates, count(ad) AS actual_dates, count(*) FILTER (WHERE ed IS NULL OR ad IS NULL) AS mismatch_count,
      count(*) FILTER (WHERE ed IS NULL OR ad IS NULL) = 0 AS complete FROM j GROUP BY 1, 2""",
)
def q23(d: Domain):
    facts = _dated_facts(d).where(F.col("market_code") != "XBSE")
    return foundation.complete_dates(facts, d.days, ("daily_price_unadjusted", "daily_st_status"), R.RISK_MARKETS)


_MUTATED = {"daily_price_unadjusted": 23, "daily_st_status": 22, "instrument_master_history": 24}


def _candidate(d: Domain):
    """The imported facts, and what a faulty store may hold instead of them: values changed below
    an old hash, price facts of the 25th lost and those of the 26th written twice."""
    sources, result = imported(d)
    facts = cache_import.read_import(d.spark, result.path)
    day, of = F.dayofmonth("business_date"), F.col("dataset_id")
    hit = lambda name: (of == name) & (day == _MUTATED[name])
    prices = of == "daily_price_unadjusted"
    changed = (
        facts.where(~(prices & (day == 25)))
        .withColumn("close_price", F.when(hit("daily_price_unadjusted"), (F.col("close_price") + 1).cast("decimal(24,6)")).otherwise(F.col("close_price")))
        .withColumn("is_st", F.when(~hit("daily_st_status"), F.col("is_st")))
        .withColumn("board_code", F.when(hit("instrument_master_history"), "ZZ").otherwise(F.col("board_code")))
    )
    return facts, changed.unionByName(changed.where(prices & (day == 26))), cache_import.records(sources).where("verdict = 'KEPT'")


@query(
    "q24_stored_candidate",
    IMPORT_SQL
    + """, kept AS (SELECT * FROM met WHERE verdict = 'K'),
    cand AS (SELECT k.* FROM kept k WHERE NOT (dataset_id = 'daily_price_unadjusted' AND day(d) = 25) UNION ALL SELECT k.* FROM kept k WHERE dataset_id = 'daily_price_unadjusted' AND day(d) = 26),
    life2 AS (SELECT DISTINCT k.security_code, k.market_code, s.listed_date, s.delisted_date FROM kept k JOIN sec s USING (security_code) WHERE dataset_id = 'instrument_master_history'),
    cal2 AS (SELECT DISTINCT market_code, d FROM kept WHERE dataset_id = 'market_calendar' AND flag AND d BETWEEN DATE '2024-01-05' AND DATE '2024-01-30'),
    ex AS (SELECT l.security_code, c.d FROM life2 l JOIN cal2 c ON c.market_code = l.market_code AND c.d >= l.listed_date AND (l.delisted_date IS NULL OR c.d < l.delisted_date)),
    ds AS (SELECT unnest(['daily_price_unadjusted','daily_price_limits','daily_st_status','daily_suspension_status']) AS dataset_id),
    six AS (SELECT dataset_id FROM ds UNION ALL SELECT 'market_calendar' UNION ALL SELECT 'instrument_master_history'),
    dk AS (SELECT dataset_id, security_code, d, count(*) AS n FROM cand WHERE dataset_id IN (SELECT dataset_id FROM ds) GROUP BY 1, 2, 3),
    mut AS (SELECT dataset_id, count(*) AS n FROM cand WHERE (dataset_id = 'daily_price_unadjusted' AND day(d) = 23) OR (dataset_id = 'daily_st_status' AND day(d) = 22) OR (dataset_id = 'instrument_master_history' AND day(d) = 24) GROUP BY 1),
    lost AS (SELECT count(*) FILTER (WHERE day(d) = 25) AS gone, count(*) FILTER (WHERE day(d) = 26) AS twice FROM kept WHERE dataset_id = 'daily_price_unadjusted'),
    pl AS (SELECT DISTINCT p.security_code, p.d, y.*, coalesce((SELECT bool_or(NOT s.flag) FROM cand s WHERE s.dataset_id = 'daily_suspension_status' AND s.security_code = p.security_code AND s.d = p.d), false) AS live
      FROM cand p JOIN cand l ON l.dataset_id = 'daily_price_limits' AND l.security_code = p.security_code AND l.d = p.d JOIN daily y ON y.security_code = p.security_code AND y.d = p.d WHERE p.dataset_id = 'daily_price_unadjusted')
    SELECT ds.dataset_id || '_duplicate_keys' AS finding, coalesce((SELECT sum(n - 1) FROM dk WHERE dk.dataset_id = ds.dataset_id), 0)::BIGINT AS issue_count FROM ds
    UNION ALL SELECT ds.dataset_id || '_missing_keys', (SELECT count(*) FROM ex WHERE d >= CASE WHEN ds.dataset_id = 'daily_st_status' THEN DATE '2024-01-05' ELSE DATE '2024-01-08' END
      AND NOT EXISTS (SELECT 1 FROM dk WHERE dk.dataset_id = ds.dataset_id AND dk.security_code = ex.security_code AND dk.d = ex.d)) FROM ds
    UNION ALL SELECT ds.dataset_id || '_unexpected_keys', (SELECT count(*) FROM dk WHERE dk.dataset_id = ds.dataset_id
      AND NOT EXISTS (SELECT 1 FROM ex WHERE dk.security_code = ex.security_code AND dk.d = ex.d AND ex.d >= CASE WHEN ds.dataset_id IN ('daily_st_status','daily_suspension_status') THEN DATE '2024-01-05' ELSE DATE '2024-01-08' END)) FROM ds
    UNION ALL SELECT six.dataset_id || '_payload_hash_mismatch', coalesce((SELECT n FROM mut WHERE mut.dataset_id = six.dataset_id), 0) FROM six
    UNION ALL SELECT six.dataset_id || '_catalogue_missing', CASE WHEN six.dataset_id = 'daily_price_unadjusted' THEN (SELECT twice FROM lost) ELSE 0 END FROM six
    UNION ALL SELECT six.dataset_id || '_catalogue_extra', CASE WHEN six.dataset_id = 'daily_price_unadjusted' THEN (SELECT gone FROM lost) ELSE 0 END FROM six
    UNION ALL SELECT six.dataset_id || '_roundtrip_missing', CASE WHEN six.dataset_id = 'daily_price_unadjusted' THEN (SELECT gone FROM lost) ELSE 0 END FROM six
    UNION ALL SELECT six.dataset_id || '_roundtrip_extra', CASE WHEN six.dataset_id = 'daily_price_unadjusted' THEN (SELECT twice FROM lost) ELSE 0 END FROM six
    UNION ALL SELECT 'live_price_or_limit_missing', (SELECT count(*) FROM pl WHERE live AND (n = 1 OR has_error))
    UNION ALL SELECT 'invalid_price_relationship', (SELECT count(*) FROM pl WHERE close_price + CASE WHEN day(d) = 23 THEN 1 ELSE 0 END <= 0 OR amount < 0 OR close_price + CASE WHEN day(d) = 23 THEN 1 ELSE 0 END > high_amt
      OR close_price + CASE WHEN day(d) = 23 THEN 1 ELSE 0 END < low_amt)
    UNION ALL SELECT 'st_unknown', coalesce((SELECT n FROM mut WHERE dataset_id = 'daily_st_status'), 0) UNION ALL SELECT 'suspension_unknown', 0
    UNION ALL SELECT 'normalized_price_differences', coalesce((SELECT n FROM mut WHERE dataset_id = 'daily_price_unadjusted'), 0) UNION ALL SELECT 'normalized_limit_differences', 0
    UNION ALL SELECT 'normalized_st_differences', coalesce((SELECT n FROM mut WHERE dataset_id = 'daily_st_status'), 0)
    UNION ALL SELECT 'normalized_master_differences', coalesce((SELECT n FROM mut WHERE dataset_id = 'instrument_master_history'), 0)""",
)
def q24_stored(d: Domain):
    facts, changed, wanted = _candidate(d)
    baseline = date(2024, 1, 5)  # the session before START
    return candidate.validate_candidate(changed, facts, wanted, candidate.Window(baseline, START, END))


@query(
    "q24_candidate_validation",
    SUSP_SQL
    + """, k AS (SELECT security_code, d FROM life_days UNION SELECT security_code, d FROM daily UNION SELECT security_code, d FROM limits UNION SELECT security_code, d FROM susp),
    j AS (SELECT l.d IS NOT NULL AS e, s.d IS NOT NULL AS s, y.d IS NOT NULL AS p, x.d IS NOT NULL AS li, s.is_suspended AS su, y.*, x.limit_up_price AS lu, x.limit_down_price AS ld
      FROM k LEFT JOIN life_days l ON l.security_code = k.security_code AND l.d = k.d LEFT JOIN daily y ON y.security_code = k.security_code AND y.d = k.d
      LEFT JOIN limits x ON x.security_code = k.security_code AND x.d = k.d LEFT JOIN susp s ON s.security_code = k.security_code AND s.d = k.d),
    c AS (SELECT count(*) FILTER (WHERE e AND NOT s) AS suspension_missing_keys, count(*) FILTER (WHERE NOT e AND s) AS suspension_unexpected_keys, count(*) FILTER (WHERE e AND NOT p) AS price_missing_keys,
      count(*) FILTER (WHERE NOT e AND p) AS price_unexpected_keys, 0::BIGINT AS live_price_or_limit_missing,
      count(*) FILTER (WHERE p AND li AND (high_amt <= 0 OR ld > lu)) AS invalid_price_relationship, count(*) FILTER (WHERE s AND su IS NULL) AS suspension_unknown FROM j)
    UNPIVOT c ON COLUMNS(*) INTO NAME finding VALUE issue_count""".replace("UNPIVOT c ON", "SELECT finding, issue_count FROM (UNPIVOT c ON").replace("VALUE issue_count", "VALUE issue_count)"),
)
def q24(d: Domain):
    expected = panel.expected_days(d.life, d.days)
    return foundation.candidate_report(_bars(d), _limits(d), _suspension(d), expected)


@query(
    "q24_roundtrip_difference",
    """a AS (SELECT security_code, d, amt, count(*) AS n FROM ev GROUP BY 1, 2, 3), b AS (SELECT security_code, d, amt, count(*) AS n FROM ev WHERE event_type <> 'view' GROUP BY 1, 2, 3)
    SELECT coalesce(sum(a.n - coalesce(b.n, 0)), 0)::BIGINT AS roundtrip_missing, 0::BIGINT AS roundtrip_extra FROM a LEFT JOIN b ON b.security_code = a.security_code AND b.d = a.d AND b.amt = a.amt""",
)
def q24b(d: Domain):
    kept = d.events.where(F.col("event_type") != "view")
    return foundation.roundtrip_difference(d.events, kept, ("security_code", "d", "amt"))


@query(
    "q25_increment_validation",
    SUSP_SQL
    + """, k AS (SELECT security_code, d FROM life_days UNION SELECT security_code, d FROM daily UNION SELECT security_code, d FROM limits UNION SELECT security_code, d FROM susp UNION SELECT security_code, d FROM st_changes),
    j AS (SELECT k.security_code, k.d, l.d IS NOT NULL AS e, s.d IS NOT NULL AS s, y.d IS NOT NULL AS p, x.d IS NOT NULL AS li, c.d IS NOT NULL AS st, coalesce(NOT s.is_suspended, false) AS live, y.low_amt
      FROM k LEFT JOIN life_days l ON l.security_code = k.security_code AND l.d = k.d LEFT JOIN daily y ON y.security_code = k.security_code AND y.d = k.d
      LEFT JOIN limits x ON x.security_code = k.security_code AND x.d = k.d LEFT JOIN susp s ON s.security_code = k.security_code AND s.d = k.d LEFT JOIN st_changes c ON c.security_code = k.security_code AND c.d = k.d)
    SELECT f AS finding, count(*) AS n FROM (SELECT unnest([CASE WHEN e AND NOT st THEN 'ST_MISSING' END, CASE WHEN e AND NOT s THEN 'SUSPENSION_MISSING' END, CASE WHEN e AND live AND NOT p THEN 'PRICE_MISSING' END,
      CASE WHEN e AND live AND NOT li THEN 'LIMIT_MISSING' END, CASE WHEN e AND live AND p AND NOT (low_amt > 0) THEN 'PRICE_INVALID' END,
      CASE WHEN NOT e AND (p OR st OR s OR li) THEN 'OUT_OF_SCOPE_FACT' END]) AS f FROM j) WHERE f IS NOT NULL GROUP BY 1""",
)
def q25(d: Domain):
    found = foundation.increment_findings(d.life, d.days, _bars(d), _limits(d), d.st_changes, _suspension(d))
    return found.groupBy("finding").agg(F.count("*").alias("n"))


@query(
    "q28_adjusted_coverage",
    """a AS (SELECT security_code, d, count(*) AS n, max(amt) AS adj FROM ev WHERE event_type = 'error' GROUP BY 1, 2)
    SELECT count(*) AS expected_price_rows, count(*) FILTER (WHERE adj IS NULL OR adj <= 0) AS missing_post_close_rows, count(*) FILTER (WHERE a.n > 1) AS duplicate_keys
    FROM daily y LEFT JOIN a ON a.security_code = y.security_code AND a.d = y.d""",
)
def q28(d: Domain):
    adjusted = d.events.where(F.col("event_type") == "error").select(*R.KEY, F.col("d").alias(DAY), F.col("amt").alias("close_price"))
    return foundation.adjusted_coverage(d.daily, adjusted)


@query(
    "q29_raw_to_fact",
    SUSP_SQL
    + """, life AS (SELECT * FROM sec WHERE listed_date <= DATE '2024-01-02'),
    r AS (SELECT e.security_code, e.d, count(*) AS n, max(e.amt) AS a, any_value(l.security_code) AS known, coalesce(bool_or(e.d >= l.listed_date AND (l.delisted_date IS NULL OR e.d < l.delisted_date)), false) AS valid
      FROM ev e LEFT JOIN life l ON l.security_code = e.security_code WHERE e.event_type IN ('error','view') GROUP BY 1, 2),
    f AS (SELECT security_code, d, high_amt AS a FROM daily),
    j AS (SELECT r.n, r.known, coalesce(r.valid, false) AS valid, r.a AS ra, f.d IS NOT NULL AS fk, f.a AS fa, coalesce(NOT s.is_suspended, false) AS live, r.d IS NOT NULL AS rk
      FROM f FULL JOIN r ON r.security_code = f.security_code AND r.d = f.d LEFT JOIN susp s ON s.security_code = coalesce(f.security_code, r.security_code) AND s.d = coalesce(f.d, r.d))
    SELECT coalesce(sum(n) FILTER (WHERE rk AND known IS NULL), 0)::BIGINT AS unknown_master, coalesce(sum(n - 1) FILTER (WHERE valid), 0)::BIGINT AS duplicate_keys,
      count(*) FILTER (WHERE valid AND (NOT fk OR ra IS DISTINCT FROM fa)) AS value_or_key_differences, count(*) FILTER (WHERE fk AND live AND NOT valid) AS live_fact_without_raw_price FROM j""",
)
def q29(d: Domain):
    raw = d.events.where(F.col("event_type").isin("error", "view")).select(*R.KEY, F.col("d").alias(DAY), F.col("amt").alias("price"))
    facts = d.daily.select(*R.KEY, DAY, F.col("high_amt").alias("price"))
    known = d.life.where(F.col("listed_date") <= F.lit(date(2024, 1, 2)))
    return foundation.raw_to_fact(raw, facts, known, ("price",), _suspension(d))


@query(
    "q26_result_contract",
    """c AS (SELECT 'risk_events' AS table_name, (SELECT count(*) FROM risk_ev) AS expected_rows, (SELECT count(*) FROM risk_ev WHERE event_type <> 'NEW_ST') AS row_count, (SELECT count(*) FROM risk_ev WHERE event_type <> 'NEW_ST') AS key_count
      UNION ALL SELECT 'assessments', (SELECT count(*) FROM assess), (SELECT count(*) FROM assess) + (SELECT count(*) FROM assess WHERE broker_id = 'B01'), (SELECT count(*) FROM assess)
      UNION ALL SELECT 'pressure_observations', (SELECT count(*) FROM press), (SELECT count(*) FROM press), (SELECT count(*) FROM press))
    SELECT *, expected_rows = row_count AND row_count = key_count AS passed FROM c""",
)
def q26(d: Domain):
    """The manifest of a written batch against tables that lost rows, repeat rows, or are as written."""
    written = {"risk_events": d.stored_events, "assessments": d.stored_assessments, "pressure_observations": d.stored_pressure}
    manifest = sinks.write_bundle(written, new_path(d.spark, "contract"), "b1").withColumnRenamed("row_count", "expected_rows")
    found = d.stored_assessments
    tables = {
        "risk_events": (d.stored_events.where("event_type <> 'NEW_ST'"), [*R.KEY, "event_type", "first_fact_date"]),
        "assessments": (found.unionByName(found.where("broker_id = 'B01'")), ["event_key", "broker_id"]),
        "pressure_observations": (d.stored_pressure, [*R.KEY, "first_fact_date"]),
    }
    return foundation.result_contract(tables, manifest)


# --- sets and universe ------------------------------------------------------
@query(
    "u1_symmetric_difference",
    """a AS (SELECT DISTINCT security_code, d FROM ev WHERE event_type = 'error'), b AS (SELECT DISTINCT security_code, d FROM ev WHERE event_type = 'click')
    SELECT security_code, d, 'ONLY_LEFT' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT security_code, d, 'ONLY_RIGHT' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def u1(d: Domain):
    keys = lambda t: d.events.where(F.col("event_type") == t).select("security_code", "d")
    return compare.symmetric_difference(keys("error"), keys("click"))


UNIVERSE_SQL = """lm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY security_code ORDER BY status_date DESC) AS rn FROM master
        WHERE status_date <= DATE '2024-01-30' AND listed_date <= DATE '2024-01-01') WHERE rn = 1),
    us AS (SELECT w.market_code, w.security_code, CASE WHEN w.market_code = 'XBSE' THEN 'EXCLUDED' WHEN m.security_code IS NULL THEN 'MASTER_MISSING' WHEN m.board_code = 'BSE' THEN 'EXCLUDED' ELSE 'ELIGIBLE' END AS eligibility,
        CASE WHEN w.market_code = 'XBSE' OR m.board_code = 'BSE' THEN 'BOARD_EXCLUDED_BSE' END AS reason FROM (SELECT DISTINCT market_code, security_code FROM wide) w LEFT JOIN lm m USING (security_code))"""


def _split(d: Domain):
    universe = gate.business_universe(d.wide, None, END, CODE_DIGITS)
    early = d.master.where(F.col("listed_date") <= F.lit(date(2024, 1, 1)))
    return gate.universe_split(universe, early, RULES)


@query("u3_universe_split", UNIVERSE_SQL + " SELECT * FROM us")
def u3(d: Domain):
    return _split(d).select(*R.KEY, "eligibility", "reason")


@query(
    "u2_partition_proof",
    UNIVERSE_SQL + " SELECT market_code, security_code, 'UNASSIGNED' AS violation FROM us WHERE eligibility = 'MASTER_MISSING'",
)
def u2(d: Domain):
    split = _split(d)
    return gate.partition_proof(
        split, split.where(F.col("eligibility") == "ELIGIBLE"), split.where(F.col("eligibility") == "EXCLUDED")
    )


@query(
    "u4_issue_union",
    SUSP_SQL
    + """ SELECT 'MDFRQ004' AS rule_id, 'daily_st_status' AS dataset_id, count(*) AS affected_rows, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS outcome
      FROM st_changes c LEFT JOIN tdays t ON t.d = c.d JOIN sec s USING (security_code) WHERE t.d IS NULL OR c.d >= s.delisted_date
    UNION ALL SELECT 'MDFRQ007', '', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM daily WHERE market_code <> 'XBSE' AND NOT has_error
    UNION ALL SELECT 'MDFRQ011', 'daily_suspension_status', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM susp WHERE is_suspended IS NULL""",
)
def u4(d: Domain):
    found = (
        foundation.facts_outside_lifecycle(d.st_changes, d.life, d.days, "daily_st_status")
        .unionByName(foundation.price_limit_key_mismatch(d.daily, _limits(d)))
        .unionByName(foundation.null_flags(_suspension(d), "is_suspended", "daily_suspension_status"))
    )
    return foundation.check_report(
        found, [("MDFRQ004", "daily_st_status"), ("MDFRQ007", ""), ("MDFRQ011", "daily_suspension_status")]
    )


@query(
    "u5_membership_identity",
    OTHER_SQL
    + """ SELECT market_code, security_code, listed_date, 'ONLY_LEFT' AS side FROM (SELECT market_code, security_code, listed_date FROM sec EXCEPT SELECT market_code, security_code, listed_date FROM other)
    UNION ALL SELECT market_code, security_code, listed_date, 'ONLY_RIGHT' FROM (SELECT market_code, security_code, listed_date FROM other EXCEPT SELECT market_code, security_code, listed_date FROM sec)""",
)
def u5(d: Domain):
    cols = [*R.KEY, "listed_date"]
    return compare.symmetric_difference(d.life.select(*cols), _other_life(d).select(*cols))


@query(
    "u6_universe_shards",
    """u AS (SELECT *, ((row_number() OVER (PARTITION BY market_code ORDER BY security_code) + 6) // 7)::INTEGER AS shard_ordinal FROM sec WHERE listed_date <= DATE '2024-01-30' AND (delisted_date IS NULL OR delisted_date > DATE '2024-01-24'))
    SELECT market_code, shard_ordinal, count(*) AS security_count, min(security_code) AS first_code, max(security_code) AS last_code FROM u GROUP BY 1, 2""",
)
def u6(d: Domain):
    universe = foundation.discover_universe(d.life, date(2024, 1, 24), END)
    return foundation.shard_summary(foundation.shard_universe(universe, 7))


@query(
    "r6_example_keys",
    f"""i AS (SELECT {KEYTEXT} AS issue_key FROM life_days l ANTI JOIN daily y ON y.security_code = l.security_code AND y.d = l.d)
    SELECT issue_key, (SELECT count(*) FROM i) AS affected_rows FROM i ORDER BY issue_key LIMIT 20""",
)
def r6(d: Domain):
    found = foundation.missing_expected(panel.expected_days(d.life, d.days), d.daily, "MDFRQ018", "daily_price_unadjusted")
    return ranking.example_keys(found)


