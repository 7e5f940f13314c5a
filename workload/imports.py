"""A batch of standard files from the given tables, and its import, with the SQL twin's view of it."""

from functools import cache

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import cache_import
from earlybell.sources import readers
from earlybell.sources.staging import new_path
from workload.domain import Domain


def text_files(d: Domain, df, name: str) -> str:
    path = new_path(d.spark, name)
    df.write.option("header", True).option("emptyValue", "").csv(path)
    return path


@cache
def imported(d: Domain) -> tuple[cache_import.ImportSources, cache_import.ImportResult]:
    """The import of a domain's batch, written once and read by several queries."""
    sources = _import_sources(d)
    return sources, cache_import.import_batch(sources, new_path(d.spark, "imported"))


def _import_sources(d: Domain) -> cache_import.ImportSources:
    """The standard files of a batch, written as text and read again, with defects by rule.

    Every 17th user has no master row, every 13th has its listing row twice; the first days
    of months have no readable calendar flag; ST states of the 13th are no known literal;
    the other market's rows are out of an import's scope. Suspensions are JSON intervals.
    """
    text = lambda c: F.col(c).cast("string")
    master = d.master.join(d.securities.select("user_id", *R.KEY), list(R.KEY)).where("user_id % 17 <> 3")
    twice = master.where("user_id % 13 = 0 AND status_date = listed_date")
    master = master.unionByName(twice).select(
        *R.KEY, F.lit("CS").alias("security_type"), "board_code", *[text(c) for c in ("status_date", "listed_date", "delisted_date")]
    )
    flag = F.when(F.dayofmonth("calendar_date") == 1, "yes").otherwise(text("is_trading_day"))
    days = d.calendar.select("market_code", "calendar_date", "is_trading_day").where("market_code = 'cn'")
    days = days.select("market_code", text("calendar_date").alias("calendar_date"), flag.alias("is_trading_day"))
    market = d.daily.select(
        *R.KEY,
        text("trading_date").alias("trading_date"),
        F.lit("正常成交").alias("trading_status"),
        text("low_amt").alias("open_price"),
        text("high_amt").alias("high_price"),
        text("low_amt").alias("low_price"),
        text("close_price").alias("close_price"),
        F.when(F.col("n") > 1, text("n")).otherwise("").alias("volume"),
        text("amount").alias("turnover"),
        text("high_amt").alias("limit_up_price"),
        F.when(F.col("has_error"), "").otherwise(text("low_amt")).alias("limit_down_price"),
    )
    state = F.when(F.dayofmonth("trading_date") == 13, "待定").when(F.col("is_st"), "生效").otherwise("未生效")
    st = d.st_changes.select(
        *R.KEY,
        F.lit("ST").alias("risk_status_type"),
        state.alias("risk_status_value"),
        text("trading_date").alias("status_start_date"),
        text("trading_date").alias("status_end_date"),
    )
    last = F.when(F.col("has_error"), F.date_add("trading_date", 1)).otherwise(F.col("trading_date"))
    halts = d.daily.select(
        F.struct(
            F.col("security_code").alias("order_book_id"),
            text("trading_date").alias("start_date"),
            last.cast("string").alias("end_date"),
            text("has_error").alias("is_suspended"),
        ).alias("r"),
        F.floor(F.substring_index("security_code", ".", 1).cast("long") / 500).alias("slice"),
        F.trunc("trading_date", "month").alias("month"),
    )
    path = new_path(d.spark, "suspension_json")
    # a month of 500 securities at most: a file for each day of them would be opened for a few rows
    docs = halts.groupBy("slice", "month").agg(F.collect_list("r").alias("data"))
    docs.select(F.to_json(F.struct("data")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    fields = ("order_book_id", "start_date", "end_date", "is_suspended")
    csv = lambda df, name: readers.read_text_csv(d.spark, text_files(d, df, name))
    return cache_import.ImportSources(
        csv(days, "trading_calendar"),
        csv(master, "security_status_daily"),
        csv(market, "stock_market_daily"),
        csv(st, "security_risk_status"),
        readers.read_json_records(d.spark, path, fields=fields),
    )


IMPORT_SQL = """im AS (SELECT m.*, s.user_id FROM master m JOIN sec s USING (security_code) WHERE s.user_id % 17 <> 3),
    il AS (SELECT DISTINCT security_code, listed_date, delisted_date FROM im),
    halts AS (SELECT security_code, market_code, has_error, unnest([d, CASE WHEN has_error THEN d + 1 ELSE NULL END])::DATE AS d FROM daily),
    raw AS (SELECT 'daily_price_unadjusted' AS dataset_id, security_code, market_code, d, true AS fine, NULL::BOOLEAN AS flag, close_price AS v FROM daily
      UNION ALL SELECT 'daily_price_limits', security_code, market_code, d, true, NULL, high_amt FROM daily
      UNION ALL SELECT 'daily_st_status', security_code, market_code, d, day(d) <> 13, is_st, NULL FROM st_changes
      UNION ALL SELECT 'daily_suspension_status', security_code, market_code, d, true, has_error, NULL FROM halts WHERE d IS NOT NULL),
    met AS (SELECT r.dataset_id, r.security_code, r.market_code, r.d, r.flag, r.v, CASE WHEN NOT fine OR r.market_code = 'XBSE' THEN 'I' WHEN l.security_code IS NULL THEN 'U'
        WHEN r.d >= l.listed_date AND (l.delisted_date IS NULL OR r.d < l.delisted_date) THEN 'K' ELSE 'O' END AS verdict FROM raw r LEFT JOIN il l USING (security_code)
      UNION ALL SELECT 'market_calendar', NULL, m, d, isodow(d) < 6, NULL, CASE WHEN day(d) = 1 THEN 'I' ELSE 'K' END FROM natural_days, (SELECT unnest(['XSHG','XSHE']) AS m)
      UNION ALL SELECT 'instrument_master_history', security_code, market_code, status_date, NULL, NULL, CASE WHEN market_code = 'XBSE' OR (user_id % 13 = 0 AND status_date = listed_date) THEN 'I' ELSE 'K' END
        FROM (SELECT * FROM im UNION ALL SELECT * FROM im WHERE user_id % 13 = 0 AND status_date = listed_date))"""
