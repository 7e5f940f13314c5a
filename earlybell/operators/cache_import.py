"""Offline import of a finished batch: five standard files and raw suspension records become six
typed fact datasets (S14).

Every layout is normalised by one projection to the same record: dataset, key, business
date, typed values, the source row as JSON, and a ``verdict``. Only kept records are
written; how many were not, and why, is counted beside the write, in the same pass
(``DataFrame.observe``). One record per security-day and dataset is shuffled, once, to
meet its lifecycle; the lifecycle itself is folded to a row per security before.

Verdicts: KEPT; OUTSIDE_LIFECYCLE (known security, day not in ``[listed, delisted)``);
UNKNOWN_SECURITY; INVALID (a key, date, flag or state that is not one of the accepted
literals). An import with invalid or unknown records, or with securities whose master rows
disagree on their lifecycle, is not fit for use; ``ImportResult.fit`` says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.sources import sinks

KEPT, OUTSIDE, UNKNOWN, INVALID = "KEPT", "OUTSIDE_LIFECYCLE", "UNKNOWN_SECURITY", "INVALID"
VERDICTS = (KEPT, OUTSIDE, UNKNOWN, INVALID)

CALENDAR, MASTER, PRICES, LIMITS, ST, SUSPENSION = (
    "market_calendar",
    "instrument_master_history",
    "daily_price_unadjusted",
    "daily_price_limits",
    "daily_st_status",
    "daily_suspension_status",
)
DATASETS = (CALENDAR, MASTER, PRICES, LIMITS, ST, SUSPENSION)

#: Typed values of all datasets; a dataset leaves the others null.
NUMBERS = (
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "amount",
    "limit_up_price",
    "limit_down_price",
)
FLAGS = ("is_trading_day", "is_st", "is_suspended")
DATES = ("listing_date", "termination_date", "effective_start", "effective_end")
TEXTS = ("security_type", "board_code")
VALUES = (*NUMBERS, *FLAGS, *DATES, *TEXTS)
_TYPES = (
    {c: "decimal(24,6)" for c in NUMBERS}
    | {c: "boolean" for c in FLAGS}
    | {c: "date" for c in DATES}
    | {c: "string" for c in TEXTS}
)

# fixed values: literals of the standard files
ST_VALUES = {"生效": True, "未生效": False}
TRADING_STATES = ("停牌", "正常成交")
CALENDAR_MARKET = "cn"


@dataclass(frozen=True)
class ImportSources:
    """All-text tables of a batch, in the standard layouts; ``suspension`` in one of three shapes.

    ``suspension`` is wide (``date`` and a column per security), per day (security, date,
    is_suspended) or per interval (security, start_date, end_date, is_suspended).
    """

    calendar: DataFrame
    master: DataFrame
    market: DataFrame
    risk_status: DataFrame
    suspension: DataFrame


@dataclass(frozen=True)
class ImportResult:
    path: str
    #: dataset_id and one count per verdict
    counts: DataFrame
    conflicts: DataFrame

    @property
    def fit(self) -> bool:
        bad = self.counts.where((F.col("unknown_security_rows") > 0) | (F.col("invalid_rows") > 0))
        return bad.isEmpty() and self.conflicts.isEmpty()


def _day(column: str) -> Column:
    """An ISO date as it is written; any other text is null."""
    text = F.col(column)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def _flag(column: str) -> Column:
    lower = F.lower(F.col(column))
    return F.when(lower.isin("true", "1"), True).when(lower.isin("false", "0"), False)


def _number(column: str) -> Column:
    return S.blank_to_null(column).try_cast("decimal(24,6)")


def _numbers_valid(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [S.blank_to_null(c).isNull() | _number(c).isNotNull() for c in columns])


def _typed(values: Mapping[str, Column]) -> list[Column]:
    return [values.get(c, F.lit(None)).cast(_TYPES[c]).alias(c) for c in VALUES]


def _row(columns: Sequence[str]) -> Column:
    """The source row as JSON, its columns in the order of their names."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})


def _record(
    raw: DataFrame,
    dataset: str,
    code: str,
    day: Column,
    valid: Column,
    values: Mapping[str, Column],
    source: Sequence[str] | None = None,
) -> DataFrame:
    """One layout as records; ``valid`` is checked beside the key and the date."""
    market = F.element_at(F.split(F.col(code), r"\."), -1)
    fits = F.col(code).rlike(r"^[^.]+\.(" + "|".join(R.RISK_MARKETS) + ")$") & day.isNotNull()
    if "market_code" in raw.columns:
        fits = fits & (F.col("market_code") == market)
    return raw.select(
        F.lit(dataset).alias("dataset_id"),
        market.alias("market_code"),
        F.col(code).alias("security_code"),
        day.alias("business_date"),
        *_typed(values),
        _row(raw.columns if source is None else source).alias("source_row"),
        F.coalesce(fits & valid, F.lit(False)).alias("valid"),
    )


def calendar_records(raw: DataFrame) -> DataFrame:
    """Calendar days of the shared market, one record for each risk market; they have no security."""
    flag = _flag("is_trading_day")
    valid = (F.col("market_code") == CALENDAR_MARKET) & _day("calendar_date").isNotNull() & flag.isNotNull()
    return raw.select(
        F.lit(CALENDAR).alias("dataset_id"),
        F.explode(F.array(*[F.lit(m) for m in R.RISK_MARKETS])).alias("market_code"),
        F.lit(None).cast("string").alias("security_code"),
        _day("calendar_date").alias("business_date"),
        *_typed({"is_trading_day": flag}),
        _row(raw.columns).alias("source_row"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def master_records(raw: DataFrame) -> DataFrame:
    """Dated master rows; a row is in effect until the day before the security's next one.

    Two rows of one status date are invalid, both of them: their order is not known.
    """
    by = Window.partitionBy("security_code").orderBy("status_date")
    dated = raw.withColumn("_next", F.lead("status_date").over(by)).withColumn("_last", F.lag("status_date").over(by))
    start, following = _day("status_date"), _day("_next")
    unique = ~F.coalesce((F.col("_next") == F.col("status_date")) | (F.col("_last") == F.col("status_date")), F.lit(False))
    valid = unique & _day("listed_date").isNotNull() & (S.blank_to_null("delisted_date").isNull() | _day("delisted_date").isNotNull())
    values = {
        "security_type": F.col("security_type"),
        "board_code": F.col("board_code"),
        "listing_date": _day("listed_date"),
        "termination_date": _day("delisted_date"),
        "effective_start": start,
        "effective_end": F.date_sub(following, 1),
    }
    return _record(dated, MASTER, "security_code", start, valid, values, raw.columns)


def price_records(raw: DataFrame) -> DataFrame:
    fields = {"open_price": "open_price", "high_price": "high_price", "low_price": "low_price", "close_price": "close_price", "volume": "volume", "amount": "turnover"}
    valid = F.col("trading_status").isin(*TRADING_STATES) & _numbers_valid(*fields.values())
    return _record(raw, PRICES, "security_code", _day("trading_date"), valid, {c: _number(f) for c, f in fields.items()})


def limit_records(raw: DataFrame) -> DataFrame:
    fields = ("limit_up_price", "limit_down_price")
    return _record(raw, LIMITS, "security_code", _day("trading_date"), _numbers_valid(*fields), {c: _number(c) for c in fields})


def st_records(raw: DataFrame) -> DataFrame:
    """Explicit daily states only: an interval or another value is not guessed at."""
    state = F.col("risk_status_value")
    value = F.coalesce(*[F.when(state == text, flag) for text, flag in ST_VALUES.items()])
    valid = (F.col("risk_status_type") == "ST") & (F.col("status_end_date") == F.col("status_start_date")) & value.isNotNull()
    return _record(raw, ST, "security_code", _day("status_start_date"), valid, {"is_st": value})


def suspension_days(raw: DataFrame) -> DataFrame:
    """The three shapes of raw suspension records as order_book_id, date, is_suspended (text)."""
    names = set(raw.columns)
    if {"order_book_id", "date", "is_suspended"} <= names:
        return raw.select("order_book_id", F.substring("date", 1, 10).alias("date"), "is_suspended")
    if {"order_book_id", "start_date", "end_date", "is_suspended"} <= names:
        # an interval that does not read as dates stays one record, without a date
        days = F.when(_day("start_date") <= _day("end_date"), F.sequence(_day("start_date"), _day("end_date")))
        dated = raw.select("order_book_id", F.explode_outer(days).alias("date"), "is_suspended")
        return dated.select("order_book_id", F.col("date").cast("string").alias("date"), "is_suspended")
    wide = raw.select(F.substring("date", 1, 10).alias("date"), *[F.col(f"`{c}`") for c in raw.columns if c != "date"])
    codes = [f"`{c}`" for c in wide.columns if c != "date"]
    return wide.unpivot(["date"], codes, "order_book_id", "is_suspended").where("is_suspended IS NOT NULL").select("order_book_id", "date", "is_suspended")


def suspension_records(raw: DataFrame) -> DataFrame:
    rows = suspension_days(raw)
    flag = _flag("is_suspended")
    return _record(rows, SUSPENSION, "order_book_id", _day("date"), flag.isNotNull(), {"is_suspended": flag})


def lifecycles(master: DataFrame) -> DataFrame:
    """security_code, listed_date, delisted_date, and whether its rows disagree on them."""
    life = F.struct(_day("listed_date").alias("listed_date"), _day("delisted_date").alias("delisted_date"))
    folded = master.groupBy("security_code").agg(F.min(life).alias("life"), (~F.min(life).eqNullSafe(F.max(life))).alias("conflict"))
    return folded.select("security_code", "life.*", "conflict")


def records(sources: ImportSources) -> DataFrame:
    """All records of a batch with their verdict."""
    dated = [
        price_records(sources.market),
        limit_records(sources.market),
        st_records(sources.risk_status),
        suspension_records(sources.suspension),
    ]
    life = lifecycles(sources.master).select("security_code", "listed_date", "delisted_date", F.lit(True).alias("known"))
    met = reduce(DataFrame.unionByName, dated).join(life, "security_code", "left")
    inside = S.in_lifecycle("business_date", "listed_date", "delisted_date")
    verdict = (
        F.when(~F.col("valid"), INVALID)
        .when(F.col("known").isNull(), UNKNOWN)
        .when(F.coalesce(inside, F.lit(False)), KEPT)
        .otherwise(OUTSIDE)
    )
    columns = ["dataset_id", "market_code", "security_code", "business_date", *VALUES, "source_row"]
    checked = met.select(*columns, verdict.alias("verdict"))
    plain = F.when(F.col("valid"), KEPT).otherwise(INVALID).alias("verdict")
    free = calendar_records(sources.calendar).unionByName(master_records(sources.master)).select(*columns, plain)
    return free.unionByName(checked)


def payload_hash() -> Column:
    return F.sha2(F.to_json(F.struct(*VALUES)), 256)


def business_keys(rows: DataFrame) -> DataFrame:
    digits = F.regexp_replace("security_code", r"\.[^.]*$", "")
    key = F.concat_ws("|", "market_code", digits, F.col("business_date").cast("string"))
    return rows.withColumn("business_key", key).withColumn("payload_hash", payload_hash())


def import_batch(sources: ImportSources, path: str) -> ImportResult:
    """Write the kept records as facts under ``path`` and count the others beside it.

    One pass: the counts are observed while the facts are written, so they speak of just
    those rows, and no second scan of the sources is needed.
    """
    spark = sources.master.sparkSession
    seen = Observation("cache_import")
    counted = [
        F.count_if((F.col("dataset_id") == d) & (F.col("verdict") == v)).alias(f"{d}:{v}") for d in DATASETS for v in VERDICTS
    ]
    kept = records(sources).observe(seen, *counted).where(F.col("verdict") == KEPT).drop("verdict")
    sinks.write_facts(business_keys(kept), path)
    try:
        got = seen.get
    except Py4JJavaError:  # a plan that is known to be empty is cut down, and its observation with it
        got = {}
    rows = [(d, *[int(got.get(f"{d}:{v}", 0)) for v in VERDICTS]) for d in DATASETS]
    counts = spark.createDataFrame(
        rows, "dataset_id string, kept_rows bigint, outside_lifecycle_rows bigint, unknown_security_rows bigint, invalid_rows bigint"
    )
    conflicts = lifecycles(sources.master).where("conflict").select(F.lit("LIFECYCLE_CONFLICT").alias("code"), "security_code")
    return ImportResult(path, counts, conflicts)


def read_import(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """The facts of an import; a dataset's name prunes the folders that are read."""
    typed = ", ".join(f"{c} {_TYPES[c]}" for c in VALUES)
    own = f"security_code string, business_date date, {typed}, source_row string, business_key string, payload_hash string"
    facts = spark.read.schema(f"{own}, dataset_id string, market_code string, year int, month int").parquet(path)
    return facts if dataset is None else facts.where(F.col("dataset_id") == dataset)
