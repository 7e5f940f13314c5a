"""Queries on sources, sinks, field mapping and scalar cleaning.

Files are written from the given tables into the shared folder and read back
through the operator under test.
"""

from datetime import date

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import cache_import, events, foundation, gate, panel
from earlybell.operators.panel import DAY
from earlybell.sources import mapping, readers, sinks
from earlybell.sources.staging import new_path
from workload.domain import BROKERS, CODE_DIGITS, END, START, Domain
from workload.imports import IMPORT_SQL, imported, text_files as _csv
from workload.q_assess import dbl
from workload.q_store import SIX_SQL, _fact_rows
from workload.registry import query


@query(
    "s1_text_csv",
    "SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders",
    prelude=False,
)
def s1(d: Domain):
    rows = d.table("orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )
    return readers.read_text_csv(d.spark, _csv(d, rows, "orders_csv"))


@query(
    "s2_json_records",
    "SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer",
    prelude=False,
)
def s2(d: Domain):
    """One document per file and slice of 500 keys: an object with ``data``, a list, or a bare
    record for each key that 500 divides."""
    path = new_path(d.spark, "customer_json")
    fields = ("c_custkey", "c_name", "c_mktsegment")
    rows = d.table("customer").select(F.struct(*fields).alias("r"), F.floor(F.col("c_custkey") / 500).alias("slice"))
    bare = F.col("r.c_custkey") % 500 == 0
    grouped = rows.where(~bare).groupBy("slice").agg(F.collect_list("r").alias("data"))
    docs = grouped.select(
        F.when(F.col("slice") % 2 == 0, F.to_json(F.struct("data"))).otherwise(F.to_json("data")).alias("value")
    ).union(rows.where(bare).select(F.to_json("r")))
    docs.write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json_records(d.spark, path, fields=fields)


def _preamble_files(d: Domain) -> str:
    """Files of a day and every fourth user with two lines of preamble, in two layouts; those of
    the 9th have no header, and every 23rd user's line has an open quote."""
    path = new_path(d.spark, "preamble")
    user = F.substring_index("stk_code", ".", 1).cast("long")
    part, grade = F.pmod(user, F.lit(4)), F.lit('"x, y"')
    quote = F.when(user % 23 == 5, '"').otherwise("")
    code = F.concat(quote, "stk_code")
    day = F.col("biz_date").cast("string")
    body = d.wide.select(
        "biz_date",
        part.alias("part"),
        F.when(part == 3, F.concat_ws(",", day, grade, code)).otherwise(F.concat_ws(",", day, code, grade)).alias("line"),
        F.lit(3).alias("rank"),
    )
    header = F.when(F.dayofmonth("biz_date") == 9, "no header here").when(F.col("part") == 3, "biz_date,grade,stk_code")
    first = F.array(F.lit("exported history"), F.lit('2024-01-01,"000000.SH'), header.otherwise("biz_date,stk_code,grade"))
    lead = body.select("biz_date", "part").distinct().select("biz_date", "part", F.posexplode(first).alias("rank", "line"))
    _write_ranked(lead.select("biz_date", "part", "line", "rank").unionByName(body), path)
    return f"{path}/*/*/"


def _write_ranked(lines, path: str) -> None:
    """A text file of each day and part, its lines by rank.

    The folders are the leading columns of the sort as they stand: were one of them computed
    from it, the writer would sort by the folders anew and drop the order of ranks.
    """
    (
        lines.withColumnsRenamed({"biz_date": "day", "line": "value"})
        .repartition("day", "part")
        .sortWithinPartitions("day", "part", "rank")
        .select("value", "day", "part")
        .write.partitionBy("day", "part")
        .text(path)
    )


@query(
    "s3_preamble_csv",
    "SELECT biz_date, stk_code FROM wide WHERE day(biz_date) <> 9 AND split_part(stk_code, '.', 1)::BIGINT % 23 <> 5",
)
def s3(d: Domain):
    return readers.read_preamble_csv(d.spark, _preamble_files(d)).drop("file_path")


@query(
    "s3_preamble_findings",
    """x AS (SELECT biz_date, split_part(stk_code, '.', 1)::BIGINT % 4 AS part, count(*) AS n, count(*) FILTER (WHERE split_part(stk_code, '.', 1)::BIGINT % 23 = 5) AS cut FROM wide GROUP BY 1, 2)
    SELECT code, count(*) AS files, sum(n)::BIGINT AS lines FROM (SELECT CASE WHEN day(biz_date) = 9 THEN 'HEADER_MISSING' WHEN cut > 0 THEN 'OPEN_QUOTE' END AS code, CASE WHEN day(biz_date) = 9 THEN n + 3 ELSE cut END AS n FROM x)
    WHERE code IS NOT NULL GROUP BY 1""",
)
def s3_findings(d: Domain):
    found = readers.preamble_findings(d.spark, _preamble_files(d))
    return found.groupBy("code").agg(F.count("*").alias("files"), F.sum("lines").alias("lines"))


@query(
    "s4_quarter_files",
    """q AS (SELECT DISTINCT year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS quarter_ordinal FROM orders WHERE quarter(o_orderdate) <> 2)
    SELECT 'history' || (quarter_ordinal // 4) || 'Q' || (quarter_ordinal % 4 + 1) || '.csv' AS file_name, quarter_ordinal::INTEGER AS quarter_ordinal,
      CASE WHEN quarter_ordinal - lag(quarter_ordinal) OVER (ORDER BY quarter_ordinal) > 1 THEN 'GAP_BEFORE' ELSE 'OK' END AS status FROM q""",
)
def s4(d: Domain):
    names = d.table("orders").where(F.quarter("o_orderdate") != 2).select(
        F.concat(F.lit("history"), F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string"), F.lit(".csv")).alias("file_name")
    ).distinct()
    return readers.quarter_file_set(names)


def _history_files(d: Domain):
    """The wide history written as one CSV folder per quarter and read back as text."""
    path = new_path(d.spark, "history")
    d.wide.withColumn("file", F.concat(F.year("biz_date").cast("string"), F.lit("Q"), F.quarter("biz_date").cast("string"))).write.option(
        "header", True
    ).option("emptyValue", "").partitionBy("file").csv(path)
    raw = d.spark.read.option("header", True).option("nullValue", "\u0000").schema(
        "biz_date string, stk_code string, B01 string, B02 string, B03 string, file string"
    ).csv(path)
    return raw.select(
        F.concat("file", F.lit(".csv")).alias("file_name"),
        S.convert("biz_date", "date").alias("biz_date"),
        "stk_code",
        *[F.coalesce(b, F.lit("")).alias(b) for b in BROKERS],
    )


@query(
    "s5_wide_history_stats",
    """SELECT year(biz_date) || 'Q' || quarter(biz_date) || '.csv' AS file_name, count(*) AS row_count, min(biz_date) AS date_min, max(biz_date) AS date_max, count(*) FILTER (WHERE isodow(biz_date) >= 6) AS weekend_row_count,
    count(*) FILTER (WHERE isodow(biz_date) >= 6 AND market_code <> 'XBSE') AS eligible_market_weekend_row_count,
    coalesce(sum((B01 <> '')::INTEGER + (B02 <> '')::INTEGER + (B03 <> '')::INTEGER) FILTER (WHERE isodow(biz_date) >= 6 AND market_code <> 'XBSE'), 0)::BIGINT AS weekend_nonblank_broker_cell_count FROM wide GROUP BY 1""",
)
def s5(d: Domain):
    return readers.history_file_stats(_history_files(d), BROKERS)


@query(
    "s5_history_scope",
    """SELECT CASE WHEN d < DATE '2024-01-08' THEN 'BEFORE' WHEN d <= DATE '2024-01-30' THEN 'IN_WINDOW' ELSE 'AFTER' END AS scope,
    security_code IN (SELECT security_code FROM risk_ev) AS is_event_security, count(*) AS n FROM hist WHERE broker_id = 'B01' GROUP BY 1, 2""",
)
def s5b(d: Domain):
    return readers.history_scope(d.cells, d.stored_events, START, END).groupBy("scope", "is_event_security").agg(F.count("*").alias("n"))


@query(
    "s6_business_universe",
    """u AS (SELECT biz_date, market_code, security_code FROM wide UNION SELECT d, market_code, security_code FROM ev WHERE event_type = 'signup' AND d <= DATE '2024-01-30')
    SELECT count(*) AS canonical_row_count, count(DISTINCT security_code) AS security_count, count(DISTINCT security_code) FILTER (WHERE market_code = 'XBSE') AS bse_security_count,
      min(biz_date) AS min_classification_date, max(biz_date) AS max_classification_date FROM u""",
)
def s6(d: Domain):
    extra = d.events.where(F.col("event_type") == "signup").select(
        F.col("d").alias("biz_date"), S.business_code("security_code").alias("stk_code")
    )
    return gate.universe_summary(gate.business_universe(d.wide, extra, END, CODE_DIGITS))


@query(
    "s7_merge_runs",
    """SELECT l_orderkey, arg_max(x, b)['p'] AS l_partkey, arg_max(x, b)['d']::DATE AS l_shipdate FROM (SELECT l_orderkey, b, max({'d': l_shipdate, 'p': l_partkey}) AS x FROM
      (SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS b FROM lineitem) GROUP BY 1, 2) GROUP BY 1""",
    prelude=False,
)
def s7(d: Domain):
    rows = d.table("lineitem")
    runs = [
        rows.where(F.col("l_returnflag") == flag).select("l_orderkey", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey")
        for flag in ("A", "N", "R")
    ]
    return readers.merge_runs(runs, ["l_orderkey"])


@query("s8_calendar_scan", "SELECT min(d) AS first_day, max(d) AS last_day, count(*) AS trading_days, true AS covers FROM tdays")
def s8(d: Domain):
    text = d.calendar.select(
        F.col("market_code").alias("交易市场代码"), F.col("calendar_date").cast("string").alias("日历日期"), F.col("is_trading_day").cast("string").alias("是否交易日")
    )
    scanned = readers.standard_calendar(readers.read_text_csv(d.spark, _csv(d, text, "calendar")))
    return readers.calendar_covers(scanned, date(2024, 1, 2), END)


@query(
    "s9_lifecycle_scan",
    """r AS (SELECT market_code, security_code, listed_date, delisted_date FROM sec UNION ALL SELECT market_code, security_code, min(d), NULL FROM ev WHERE event_type <> 'view' GROUP BY 1, 2)
    SELECT market_code, security_code, min(listed_date) AS listed_date,
      list(delisted_date ORDER BY listed_date, delisted_date NULLS FIRST)[1] AS delisted_date,
      CASE WHEN count(DISTINCT (listed_date, delisted_date)) > 1 THEN 'CONFLICT' ELSE 'OK' END AS status FROM r WHERE market_code <> 'XBSE' GROUP BY 1, 2""",
)
def s9(d: Domain):
    own = d.life.select("security_code", F.col("listed_date").cast("string").alias("l"), F.coalesce(F.col("delisted_date").cast("string"), F.lit("")).alias("x"))
    other = d.events.where(F.col("event_type") != "view").groupBy("security_code").agg(F.min("d").cast("string").alias("l"), F.lit("").alias("x"))
    text = own.unionByName(other).select(
        F.col("security_code").alias("order_book_id"), F.col("l").alias("listed_date_norm"), F.col("x").alias("de_listed_date_norm")
    )
    return readers.standard_lifecycle(readers.read_text_csv(d.spark, _csv(d, text, "lifecycle")), CODE_DIGITS)


@query(
    "s10_event_batch_scan",
    """SELECT 'BM001_EVENT_COUNT_MISMATCH' AS code, 1::BIGINT AS affected_rows UNION ALL SELECT 'BM003_EVENT_TYPE_INVALID', (SELECT count(*) FROM risk_ev WHERE event_type = 'NEW_ST')
    UNION ALL SELECT 'BM001_EVENT_RULE_MISMATCH', count(*) FROM risk_ev WHERE first_fact_date > DATE '2024-01-25'""",
)
def s10(d: Domain):
    text = d.stored_events.select(
        F.col("market_code").alias("交易市场代码"),
        F.col("security_code").alias("证券代码"),
        F.when(F.col("event_type") == R.NEW_ST_EVENT, "OTHER").otherwise(F.col("event_type")).alias("事件类型"),
        F.col("first_fact_date").cast("string").alias("首次事实日期"),
        F.col("risk_date").cast("string").alias("风险认定日期"),
        F.when(F.col("first_fact_date") > F.lit(date(2024, 1, 25)), "v1").otherwise("v2").alias("风险规则版本号"),
        F.lit("b1").alias("计算批次标识"),
    )
    scanned = readers.standard_events(readers.read_text_csv(d.spark, _csv(d, text, "events")))
    # the manifest of this batch claims one row more than it has
    claimed = d.stored_events.count() + 1
    return readers.event_batch_findings(scanned, claimed, "b1", "v2")


@query(
    "s11_fact_sink",
    SIX_SQL + " SELECT dataset_id, market_code, year(d)::INTEGER AS year, month(d)::INTEGER AS month, count(*) AS rows FROM six GROUP BY ALL",
)
def s11(d: Domain):
    path = new_path(d.spark, "facts")
    sinks.write_facts(_fact_rows(d), path)
    return d.spark.read.parquet(path).groupBy("dataset_id", "market_code", "year", "month").agg(F.count("*").alias("rows"))


@query(
    "s12_result_bundle",
    """SELECT 'b1' AS batch_id, 'risk_events' AS table_name, count(*) AS row_count FROM risk_ev UNION ALL SELECT 'b1', 'pressure_observations', count(*) FROM press""",
)
def s12(d: Domain):
    return sinks.write_bundle(
        {"risk_events": d.stored_events, "pressure_observations": d.stored_pressure}, new_path(d.spark, "bundle"), "b1"
    )


@query(
    "s13_localised_headers",
    """SELECT market_code AS "交易市场代码", security_code AS "证券代码", segment_number AS "连续段序号", len AS "连续跌停交易日数", first_d AS "首次事实日期", len >= threshold AS "是否达到门槛" FROM segments""",
)
def s13(d: Domain):
    segments = events.limit_down_segments(d.panel, _rules()).select(
        *R.KEY, "segment_number", "consecutive_length", "first_fact_date", "threshold_reached"
    )
    return sinks.localise(segments, sinks.SEGMENT_HEADERS)


def _rules():
    from workload.domain import RULES

    return RULES


@query(
    "s14_lifecycle_counts",
    """l AS (SELECT * FROM sec WHERE listed_date <= DATE '2024-01-02'), f AS (SELECT 'daily_price_unadjusted' AS dataset_id, security_code, d FROM daily UNION ALL SELECT 'daily_st_status', security_code, d FROM st_changes)
    SELECT dataset_id, count(*) FILTER (WHERE k AND i) AS kept_rows, count(*) FILTER (WHERE k AND NOT i) AS outside_lifecycle_rows, count(*) FILTER (WHERE NOT k) AS unknown_security_rows
    FROM (SELECT f.*, l.security_code IS NOT NULL AS k, f.d >= l.listed_date AND (l.delisted_date IS NULL OR f.d < l.delisted_date) AS i FROM f LEFT JOIN l USING (security_code)) GROUP BY 1""",
)
def s14_counts(d: Domain):
    tag = lambda df, n: df.select(F.lit(n).alias("dataset_id"), *R.KEY, F.col(DAY).alias("business_date"))
    facts = tag(d.daily, "daily_price_unadjusted").unionByName(tag(d.st_changes, "daily_st_status"))
    return foundation.outside_lifecycle_counts(facts, d.life.where(F.col("listed_date") <= F.lit(date(2024, 1, 2))))


@query(
    "s14_cache_import",
    IMPORT_SQL
    + """ SELECT dataset_id, count(*) FILTER (WHERE verdict = 'K') AS kept_rows, count(*) FILTER (WHERE verdict = 'O') AS outside_lifecycle_rows,
      count(*) FILTER (WHERE verdict = 'U') AS unknown_security_rows, count(*) FILTER (WHERE verdict = 'I') AS invalid_rows, count(*) FILTER (WHERE verdict = 'K') AS written_rows,
      count(*) FILTER (WHERE verdict = 'K' AND flag) AS set_flags, coalesce(sum(v) FILTER (WHERE verdict = 'K'), 0)::DOUBLE AS value_total FROM met GROUP BY 1""",
)
def s14(d: Domain):
    """Six datasets from five files and JSON; what was counted beside the write, and what the files hold."""
    _, result = imported(d)
    flags = F.coalesce("is_trading_day", "is_st", "is_suspended", F.lit(False))
    held = cache_import.read_import(d.spark, result.path).groupBy("dataset_id").agg(
        F.count("*").alias("written_rows"),
        F.count_if(flags).alias("set_flags"),
        F.sum(F.coalesce("close_price", "limit_up_price", F.lit(0).cast("decimal(24,6)"))).cast("double").alias("value_total"),
    )
    return result.counts.join(held, "dataset_id", "left")


@query(
    "s15_business_date_extent",
    "SELECT min(o_orderdate)::DATE AS min_date, max(o_orderdate)::DATE AS max_date, count(*) AS row_count, make_date(year(max(o_orderdate)), 1, 1) AS recommended_start, year(max(o_orderdate)) || 'Q' || quarter(max(o_orderdate)) AS quarter FROM orders",
    prelude=False,
)
def s15(d: Domain):
    return readers.business_date_extent(d.table("orders").select(F.col("o_orderdate").cast("date").alias("biz_date")))


# --- mapping and cleaning ---------------------------------------------------
ORDER_FIELDS = (
    mapping.FieldMap("order_id", "integer", exact="o_orderkey", nullable=False),
    mapping.FieldMap("customer", "integer", exact="customer_id", aliases=("o_custkey",)),
    mapping.FieldMap("status", exact="o_orderstatus", value_map={"o": "open", "f": "finished"}),
    mapping.FieldMap("order_date", "date", candidates=("o_orderdate", "order_dt"), nullable=False),
    mapping.FieldMap("amount", "decimal", aliases=("o_totalprice", "o_total"), required=True),
    mapping.FieldMap("source", context_key="source"),
    mapping.FieldMap("currency", constant="CNY"),
    mapping.FieldMap("either", aliases=("o_orderkey", "o_custkey")),
    mapping.FieldMap("absent", required=True),
)


def _raw_orders(d: Domain):
    priority = F.col("o_orderpriority")
    return d.table("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(priority.startswith("2"), "n/a").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.when(priority.startswith("3"), "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
    )


@query(
    "p1_field_mapping",
    """SELECT o_orderkey AS order_id, CASE WHEN NOT starts_with(o_orderpriority, '2') THEN o_custkey END AS customer, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' ELSE o_orderstatus END AS status,
    CASE WHEN NOT starts_with(o_orderpriority, '3') THEN o_orderdate::DATE END AS order_date, o_totalprice::DECIMAL(24,6)::DOUBLE AS amount, 'upload' AS source, 'CNY' AS currency, NULL::VARCHAR AS either, NULL::VARCHAR AS absent FROM orders""",
    prelude=False,
)
def p1(d: Domain):
    mapped, _ = mapping.map_fields(_raw_orders(d), ORDER_FIELDS, {"source": "upload"})
    return dbl(mapped)


@query(
    "p2_typed_conversion",
    """SELECT * FROM (SELECT 'customer' AS target, 'INVALID_VALUE' AS finding, count(*) FILTER (WHERE starts_with(o_orderpriority, '2')) AS affected_rows FROM orders
    UNION ALL SELECT 'order_date', 'NULL_IN_NON_NULLABLE', count(*) FILTER (WHERE starts_with(o_orderpriority, '3')) FROM orders
    UNION ALL SELECT 'either', 'PENDING', NULL UNION ALL SELECT 'absent', 'MISSING_REQUIRED', NULL)""",
    prelude=False,
)
def p2(d: Domain):
    return mapping.mapping_findings(_raw_orders(d), ORDER_FIELDS, {"source": "upload"})


@query(
    "p3_value_map",
    "SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'MACHINERY' THEN 'm' ELSE c_mktsegment END AS segment, count(*) AS n FROM customer GROUP BY 1",
    prelude=False,
)
def p3(d: Domain):
    translated = S.translate_value("c_mktsegment", {"building": "b", "machinery": "m"})
    return d.table("customer").groupBy(translated.alias("segment")).agg(F.count("*").alias("n"))


@query("p4_security_codes", "SELECT stk_code, market_code, security_code, count(*) AS n FROM wide GROUP BY 1, 2, 3")
def p4(d: Domain):
    return d.wide.groupBy(
        "stk_code",
        S.security_market("stk_code", CODE_DIGITS).alias("market_code"),
        S.canonical_security("stk_code", CODE_DIGITS).alias("security_code"),
    ).agg(F.count("*").alias("n"))


@query(
    "p5_unknown_literals",
    "SELECT event_type AS literal, count(*) AS affected_rows FROM ev WHERE event_type NOT IN ('signup', 'purchase') GROUP BY 1",
)
def p5_unknown(d: Domain):
    literal = F.expr("CASE event_type WHEN 'signup' THEN '生效' WHEN 'purchase' THEN '未生效' ELSE event_type END")
    return gate.unknown_literals(d.events.select(F.lit("st").alias("risk_status_type"), literal.alias("risk_status_value")))


@query(
    "p5_tolerant_literals",
    """SELECT p_type, CASE p_size % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS is_st, CASE p_size % 5 WHEN 0 THEN true WHEN 3 THEN false END AS flag, count(*) AS n FROM part GROUP BY 1, 2, 3""",
    prelude=False,
)
def p5(d: Domain):
    text = F.expr("CASE p_size % 5 WHEN 0 THEN ' YES ' WHEN 1 THEN '*ST' WHEN 2 THEN '未生效' WHEN 3 THEN 'No' ELSE 'maybe' END")
    return d.table("part").groupBy("p_type", S.parse_st(text).alias("is_st"), S.parse_bool(text).alias("flag")).agg(F.count("*").alias("n"))


@query(
    "p7_board_alias",
    """SELECT board_code, CASE board_code WHEN 'MainBoard' THEN 'MAIN' WHEN 'GEM' THEN 'CHINEXT' WHEN 'KSH' THEN 'STAR' ELSE board_code END AS canonical,
    CASE WHEN market_code = 'XBSE' THEN 'BSE' ELSE 'MAIN' END AS inferred, count(*) AS n FROM sec GROUP BY 1, 2, 3""",
)
def p7(d: Domain):
    from workload.domain import RULES

    return d.securities.groupBy(
        "board_code",
        S.canonical_board("board_code", RULES.board_aliases).alias("canonical"),
        S.board_from_code(S.business_code("security_code")).alias("inferred"),
    ).agg(F.count("*").alias("n"))


@query(
    "p11_wide_boolean_to_long",
    """SELECT d AS date, t.event_type AS order_book_id, coalesce(bool_or(e.amt >= 100), false) AS is_st FROM (SELECT DISTINCT d FROM ev) x CROSS JOIN (SELECT unnest(['view','signup','purchase','error','click']) AS event_type) t
    LEFT JOIN ev e USING (d, event_type) GROUP BY 1, 2""",
)
def p11(d: Domain):
    kinds = ("view", "signup", "purchase", "error", "click")
    wide = d.events.groupBy(F.col("d").alias("date")).agg(
        *[F.max((F.col("event_type") == k) & (F.col("amt") >= 100)).alias(k) for k in kinds]
    )
    return readers.long_boolean(wide, "is_st")


@query(
    "p20_pit_status_rows",
    """SELECT 'XSHG' AS market_code, lpad(c_custkey::VARCHAR, 10, '0') || '.XSHG' AS security_code, DATE '2024-01-30' AS status_date, c_mktsegment AS board_code, 'CS' AS security_type,
    CASE WHEN c_acctbal < 0 THEN 'Delisted' ELSE 'Active' END AS lifecycle_status, DATE '2020-01-02' AS listed_date, CASE WHEN c_acctbal < 0 THEN DATE '2024-01-01' END AS delisted_date,
    CASE WHEN c_acctbal < 0 THEN '终止' ELSE '正常' END AS trading_eligibility_status FROM customer""",
    prelude=False,
)
def p20(d: Domain):
    gone = F.col("c_acctbal") < 0
    instruments = d.table("customer").select(
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.lit(".XSHG")).alias("order_book_id"),
        F.lit("").alias("exchange"),
        F.col("c_mktsegment").alias("board_type"),
        F.lit(None).cast("string").alias("type"),
        F.when(gone, "Delisted").otherwise("Active").alias("status"),
        F.lit("2020-01-02").alias("listed_date"),
        F.when(gone, "2024-01-01").otherwise("0000-00-00").alias("de_listed_date"),
    )
    return mapping.pit_status_rows(instruments, END)


@query(
    "p22_daily_flags",
    """SELECT l.market_code, l.security_code, l.d AS trading_date, CASE WHEN coalesce(k.a, false) THEN '生效' ELSE '未生效' END AS risk_status_value, CASE WHEN k.close IS NOT NULL THEN '正常成交' ELSE '停牌' END AS trading_status,
      k.close::DOUBLE AS close_price, CASE WHEN k.lo THEN k.close::DOUBLE END AS limit_down_price FROM life_days l
    LEFT JOIN (SELECT security_code, d, bool_or(event_type IN ('signup','click')) AS a, max(amt) FILTER (WHERE event_type <> 'view') AS close, bool_or(event_type = 'error') AS lo FROM ev GROUP BY 1, 2) k
      ON k.security_code = l.security_code AND k.d = l.d""",
)
def p22(d: Domain):
    kind = F.col("event_type")
    vendor = d.events.groupBy(*R.KEY, F.col("d").alias(DAY)).agg(
        F.max(kind == "signup").alias("is_st"),
        F.max(kind == "click").alias("is_star_st"),
        F.max(F.when(kind != "view", F.col("amt"))).alias("close"),
        F.max(kind == "error").alias("low_limit"),
    )
    return dbl(mapping.daily_flags(panel.expected_days(d.life, d.days), vendor))


@query(
    "p24_numeric_text",
    """SELECT p_partkey, CASE WHEN p_retailprice % 1 = 0 THEN p_retailprice::BIGINT::VARCHAR ELSE rtrim(printf('%.2f', p_retailprice), '0') END AS price_text, 'n/a' AS other FROM part""",
    prelude=False,
)
def p24(d: Domain):
    padded = F.concat(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("00"))
    return d.table("part").select("p_partkey", S.numeric_text(padded).alias("price_text"), S.numeric_text(F.lit("n/a")).alias("other"))
