"""Scans of the accepted file layouts. Nothing is inferred: columns stay text until converted."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.panel import DAY
from earlybell.sources.sinks import EVENT_HEADERS
from earlybell.sources.staging import store

BOM = "\ufeff"


def read_text_csv(spark: SparkSession, *paths: str, with_file: bool = False) -> DataFrame:
    """CSV with a header, every column text, empty cells as '' (S1).

    Paths whose files start with different headers are read apart and united by column
    name; a folder or pattern counts as one path, and a file in it that has another
    header fails the read instead of being taken by position.
    """
    by_header: dict[str, list[str]] = {}
    for path in paths if len(paths) > 1 else ():
        first = spark.read.text(path).first()
        by_header.setdefault(first[0].lstrip(BOM) if first else "", []).append(path)
    parts = [_csv_of_one_header(spark, same, with_file) for same in by_header.values() or [list(paths)]]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.fillna("", [c for c in out.columns if c != "file_name"]) if len(parts) > 1 else out


def _csv_of_one_header(spark: SparkSession, paths: list[str], with_file: bool) -> DataFrame:
    df = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("emptyValue", "")
        .option("nullValue", "\u0000")
        .option("treatEmptyValuesAsNulls", False)
        .csv(paths)
    )
    names = [c.lstrip(BOM) for c in df.columns]
    if with_file:
        df = df.select("*", F.col("_metadata.file_name").alias("file_name"))
        names.append("file_name")
    return df.toDF(*names).fillna("", [n for n in names if n != "file_name"])


def read_json_records(spark: SparkSession, *paths: str, fields: Sequence[str] | None = None) -> DataFrame:
    """JSON records: a list, a single object, or an object with a ``data`` list.

    The three shapes may be mixed, between files and within a list. All values are text.
    ``fields`` names the columns and saves the scan that finds them.
    """
    reader = spark.read.option("multiLine", True).option("primitivesAsString", True)
    if fields is None:
        df = reader.json(list(paths))
        kind = df.schema["data"].dataType.simpleString() if "data" in df.columns else ""
        if not kind.startswith("array<struct"):
            return df
        inner = df.schema["data"].dataType.elementType.names
        fields = list(dict.fromkeys([*inner, *[c for c in df.columns if c != "data"]]))
    record = ", ".join(f"`{c}` string" for c in fields)
    df = reader.schema(f"data array<struct<{record.replace('` string', '`: string')}>>, {record}").json(list(paths))
    bare = F.array(F.struct(*[F.col(f"`{c}`") for c in fields]))
    return df.select(F.explode(F.coalesce("data", bare)).alias("r")).select("r.*")


def _preamble_lines(spark: SparkSession, paths: Sequence[str], column: str) -> DataFrame:
    """Lines with their file, their place in it, whether they can be its header, and quote parity.

    Lines are ordered within their file by (split offset, row id), so a file may be split
    over many tasks. Only the start of a line is looked at to tell a header. Places hold in
    one scan alone, since another may deal the files out differently (executors that came
    meanwhile): the lines are stored with them, and all steps read the stored ones.
    """
    start = f"^[{BOM} \\t]*[\"']?{column}[\"']?[ \\t]*(,|$)"
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("at"),
        F.regexp_replace("value", f"^[{BOM}]+", "").alias("line"),
        F.col("value").rlike(start).alias("starts"),
        (quotes % 2 == 1).alias("open_quote"),
    )
    return store(lines, "preamble_lines")


def _preamble_headers(lines: DataFrame) -> DataFrame:
    """The first header line of each file: a stored side table of one row per file."""
    found = lines.where("starts AND NOT open_quote").groupBy("file_path").agg(F.min(F.struct("at", "line")).alias("h"))
    return store(found.select("file_path", F.col("h.at").alias("header_at"), F.col("h.line").alias("header")), "preamble_headers")


def _cells(line: str, width: int) -> Column:
    """The cells of a CSV line as an array, trimmed and without single quotes around them."""
    layout = ", ".join(f"c{k} string" for k in range(width))
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    parsed = F.from_csv(F.col(line), layout, options)
    bare = lambda c: F.regexp_replace(F.trim(c), "^'|'$", "")
    return F.transform(F.array(*[parsed[f"c{k}"] for k in range(width)]), bare)


def read_preamble_csv(spark: SparkSession, *paths: str, columns: Sequence[str] = ("biz_date", "stk_code")) -> DataFrame:
    """CSV whose header follows free-text lines; the header starts with ``biz_date`` (S3).

    Each line is parsed once, in time that grows with its length, to the width of the widest
    header; the file's header says which cells are asked for, so files of different layouts
    are read together. Lines before the header, files without one, and lines with an open
    quote give no rows: ``preamble_findings`` names the latter two.
    """
    lines = _preamble_lines(spark, paths, columns[0])
    headers = _preamble_headers(lines)
    commas = F.length("header") - F.length(F.replace("header", F.lit(","), F.lit("")))
    width = (headers.agg(F.max(commas)).first()[0] or 0) + 1
    named = headers.select("file_path", "header_at", _cells("header", width).alias("names"))
    body = lines.where("NOT open_quote").join(named, "file_path").where(F.col("at") > F.col("header_at"))
    cut = body.select("file_path", "names", _cells("line", width).alias("cells"))
    place = lambda c: (F.array_position("names", c) - 1).cast("int")
    picked = cut.select("file_path", *[F.get("cells", place(c)).alias(c) for c in columns])
    return picked.withColumn(columns[0], S.convert(columns[0], "date"))


def preamble_findings(spark: SparkSession, *paths: str, column: str = "biz_date") -> DataFrame:
    """Per file: that no line starts its header, or how many lines after it end inside a quoted cell (S3).

    A cell with a line break is cut by the line reader; both of its halves have an open quote.
    """
    lines = _preamble_lines(spark, paths, column)
    headers = _preamble_headers(lines).select("file_path", "header_at")
    after = lines.join(headers, "file_path", "left")
    per_file = after.groupBy("file_path").agg(
        F.count("*").alias("lines"),
        F.max(F.col("header_at").isNotNull()).alias("has_header"),
        F.count_if(F.col("open_quote") & (F.col("at") > F.col("header_at"))).alias("cut"),
    )
    found = F.when(~F.col("has_header"), F.struct(F.lit("HEADER_MISSING").alias("code"), F.col("lines").alias("n"))).when(
        F.col("cut") > 0, F.struct(F.lit("OPEN_QUOTE").alias("code"), F.col("cut").alias("n"))
    )
    out = per_file.select("file_path", found.alias("x")).where("x IS NOT NULL")
    return out.select("x.code", F.lit("ERROR").alias("severity"), "file_path", F.col("x.n").alias("lines"))


def quarter_file_set(files: DataFrame) -> DataFrame:
    """Quarter files in order with the gap to the one before.

    ``files`` needs file_name; there is one row per quarter file, so ordering them
    together is harmless.
    """
    year = F.regexp_extract("file_name", r"(\d{4})Q([1-4])\.csv$", 1)
    quarter = F.regexp_extract("file_name", r"(\d{4})Q([1-4])\.csv$", 2)
    w = Window.partitionBy(F.lit(1)).orderBy("quarter_ordinal")
    return (
        files.select("file_name", (year.try_cast("int") * 4 + quarter.try_cast("int") - 1).alias("quarter_ordinal"))
        .select(
            "file_name",
            "quarter_ordinal",
            F.when(F.col("quarter_ordinal").isNull(), "BAD_NAME")
            .when(F.col("quarter_ordinal") - F.lag("quarter_ordinal").over(w) > 1, "GAP_BEFORE")
            .when(F.col("quarter_ordinal") == F.lag("quarter_ordinal").over(w), "DUPLICATE")
            .otherwise("OK")
            .alias("status"),
        )
    )


def _quarter_name() -> Column:
    """A file's name where it says a quarter, else that of its folder: a quarter may be a folder of parts."""
    path = F.col("_metadata.file_path")
    name, folder = F.regexp_extract(path, r"([^/]+)$", 1), F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.when(name.rlike(r"\d{4}Q[1-4]"), name).otherwise(F.regexp_replace(folder, "^[^=]*=", ""))


def history_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Quarter name, path and first line of each history file below ``root`` (Q14)."""
    lines = spark.read.option("recursiveFileLookup", True).text(root).where(F.col("_metadata.file_block_start") == 0)
    per_file = lines.select(
        _quarter_name().alias("file_name"),
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", f"^{BOM}", "").alias("line")).alias("x"),
    )
    return per_file.groupBy("file_name", "path").agg(F.min("x.row").alias("row"), F.min_by("x.line", "x.row").alias("header")).drop("row")


def read_text_csv_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Text CSV files of one header, with the quarter that each belongs to as ``file_name``."""
    df = spark.read.option("header", True).option("enforceSchema", False).option("emptyValue", "").csv(list(paths))
    named = df.select("*", _quarter_name().alias("file_name"))
    return named.toDF(*[c.lstrip(BOM) for c in named.columns])


def list_files(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """File names of a folder; contents are pruned from the scan."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(directory)
        .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "path", "length")
    )


def history_file_stats(history: DataFrame, brokers: Sequence[str]) -> DataFrame:
    """Per-file rows, date extent, weekend rows and filled weekend cells."""
    weekend = S.is_weekend("biz_date")
    eligible = weekend & F.col("stk_code").rlike(r"\.(SH|SZ)$")
    filled = sum((F.when(F.trim(F.col(b)) != "", 1).otherwise(0) for b in brokers), F.lit(0))
    return history.groupBy("file_name").agg(
        F.count("*").alias("row_count"),
        F.min("biz_date").alias("date_min"),
        F.max("biz_date").alias("date_max"),
        F.count_if(weekend).alias("weekend_row_count"),
        F.count_if(eligible).alias("eligible_market_weekend_row_count"),
        F.sum(F.when(eligible, filled).otherwise(0)).alias("weekend_nonblank_broker_cell_count"),
    )


def history_scope(cells: DataFrame, event_securities: DataFrame, start: date, end: date) -> DataFrame:
    """History rows split into before / in / after the window, flagged for event securities."""
    flag = event_securities.select(*R.KEY).distinct().withColumn("is_event_security", F.lit(True))
    day = F.col("classification_date")
    return cells.join(flag, list(R.KEY), "left").select(
        *cells.columns,
        F.when(day < F.lit(start), "BEFORE").when(day <= F.lit(end), "IN_WINDOW").otherwise("AFTER").alias("scope"),
        F.coalesce("is_event_security", F.lit(False)).alias("is_event_security"),
    )


def merge_runs(runs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chunked runs merged per key, the later run winning.

    Folded by aggregate: a key that occurs in many rows collapses before the shuffle.
    """
    stacked = None
    for ordinal, run in enumerate(runs):
        tagged = run.withColumn("_batch", F.lit(ordinal))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    rest = [c for c in stacked.columns if c not in keys and c != "_batch"]
    best = F.max(F.struct("_batch", *rest)).alias("_best")
    return stacked.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def standard_calendar(raw: DataFrame) -> DataFrame:
    """Trading days of the three accepted calendar layouts."""
    cols = set(raw.columns)
    if {"交易日期", "交易日序号"} <= cols:
        return raw.select(S.convert("交易日期", "date").alias(DAY)).distinct()
    if {"交易市场代码", "日历日期", "是否交易日"} <= cols:
        market, day, flag = "交易市场代码", "日历日期", "是否交易日"
    elif {"market_code", "calendar_date", "is_trading_day"} <= cols:
        market, day, flag = "market_code", "calendar_date", "is_trading_day"
    else:
        raise ValueError("BM201_CALENDAR_COVERAGE_MISSING: schema")
    return (
        raw.where(F.upper(F.col(market)).isin("CN", *R.RISK_MARKETS) & F.lower(F.col(flag).cast("string")).isin("true", "1"))
        .select(S.convert(day, "date").alias(DAY))
        .distinct()
    )


def calendar_covers(days: DataFrame, start: date, end: date) -> DataFrame:
    return days.agg(
        F.min(DAY).alias("first_day"),
        F.max(DAY).alias("last_day"),
        F.count("*").alias("trading_days"),
        F.coalesce((F.min(DAY) <= F.lit(start)) & (F.max(DAY) >= F.lit(end)), F.lit(False)).alias("covers"),
    )


def standard_lifecycle(raw: DataFrame, digits: str = R.CODE_DIGITS) -> DataFrame:
    """Lifecycle of the two accepted layouts, conflicting duplicates flagged."""
    cols = set(raw.columns)
    if {"order_book_id", "listed_date_norm", "de_listed_date_norm"} <= cols:
        code, listed, delisted = "order_book_id", "listed_date_norm", "de_listed_date_norm"
    elif {"market_code", "security_code", "listed_date", "delisted_date"} <= cols:
        code, listed, delisted = "security_code", "listed_date", "delisted_date"
    else:
        raise ValueError("BM204_LIFECYCLE_EVIDENCE_MISSING: schema")
    rows = raw.where(F.col(code).rlike(r"\.(XSHG|XSHE)$")).select(
        S.security_market(code, digits).alias("market_code"),
        F.trim(F.col(code)).alias("security_code"),
        F.struct(S.convert(listed, "date").alias("l"), S.convert(delisted, "date").alias("d")).alias("life"),
    )
    return (
        rows.groupBy(*R.KEY)
        .agg(F.min("life").alias("lo"), F.max("life").alias("hi"))
        .select(
            *R.KEY,
            F.col("lo.l").alias("listed_date"),
            F.col("lo.d").alias("delisted_date"),
            F.when(F.col("lo.l").isNull(), "LISTING_DATE_MISSING")
            .when(~F.col("lo").eqNullSafe(F.col("hi")), "CONFLICT")
            .otherwise("OK")
            .alias("status"),
        )
    )


def standard_events(raw: DataFrame) -> DataFrame:
    """Event batch with Chinese or English headers."""
    named = raw.withColumnsRenamed({text: name for name, text in EVENT_HEADERS.items() if text in raw.columns})
    return named.select(
        *R.KEY,
        "event_type",
        S.convert("first_fact_date", "date").alias("first_fact_date"),
        S.convert("risk_date", "date").alias("risk_date"),
        "rule_version",
        "calculation_batch_id",
    )


def event_batch_findings(events: DataFrame, expected_rows: int | None, batch_id: str, rule_version: str) -> DataFrame:
    """Manifest, key and type checks of an event batch (S10), one row per failed check."""
    per_key = events.groupBy(*R.KEY, "event_type", "first_fact_date").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("calculation_batch_id") != batch_id).alias("other_batch"),
        F.count_if(F.col("rule_version") != rule_version).alias("other_rule"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"),
        F.coalesce(F.sum("other_batch"), F.lit(0)).alias("other_batch"),
        F.coalesce(F.sum("other_rule"), F.lit(0)).alias("other_rule"),
        F.coalesce(F.sum(F.when(~F.col("event_type").isin(*R.EVENT_VIEWS[:2]), F.col("n"))), F.lit(0)).alias("bad_type"),
    )
    count_gap = F.abs(F.col("rows") - F.lit(expected_rows)) if expected_rows is not None else F.lit(0)
    checks = [
        ("BM001_EVENT_COUNT_MISMATCH", count_gap),
        ("BM001_EVENT_BATCH_MISMATCH", F.col("other_batch")),
        ("BM001_EVENT_RULE_MISMATCH", F.col("other_rule")),
        ("BM002_EVENT_KEY_DUPLICATE", F.col("repeated")),
        ("BM003_EVENT_TYPE_INVALID", F.col("bad_type")),
    ]
    items = F.array(*[F.struct(F.lit(c).alias("code"), n.cast("bigint").alias("affected_rows")) for c, n in checks])
    return totals.select(F.explode(items).alias("x")).select("x.*").where("affected_rows > 0")


def business_date_extent(df: DataFrame, day: str = "biz_date") -> DataFrame:
    """Date extent, row count, recommended observation start and quarter label."""
    return df.agg(
        F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count("*").alias("row_count")
    ).select(
        "*",
        F.make_date(F.year("max_date"), F.lit(1), F.lit(1)).alias("recommended_start"),
        F.concat(F.year("max_date").cast("string"), F.lit("Q"), F.quarter("max_date").cast("string")).alias("quarter"),
    )


def long_boolean(wide: DataFrame, value: str, day: str = "date") -> DataFrame:
    """Date-indexed boolean matrix (one column per security) to long rows."""
    securities = [c for c in wide.columns if c != day]
    return wide.unpivot([day], securities, "order_book_id", value).where(F.col(value).isNotNull())


def st_matrix(raw: DataFrame, digits: str = R.CODE_DIGITS) -> tuple[DataFrame, DataFrame]:
    """ST rows of the matrix layout and its rectangularity findings."""
    rows = raw.select(
        S.security_market("security_code", digits).alias("market_code"),
        "security_code",
        S.convert(DAY, "date").alias(DAY),
        S.parse_bool("is_st").alias("is_st"),
    )
    per_day = rows.groupBy(DAY).agg(F.count_distinct("security_code").alias("n"), F.count("*").alias("rows"))
    whole = rows.agg(F.count_distinct("security_code").alias("securities")).withColumn("one", F.lit(1))
    findings = (
        per_day.withColumn("one", F.lit(1))
        .join(F.broadcast(whole), "one")
        .where((F.col("n") != F.col("securities")) | (F.col("rows") != F.col("n")))
        .select(DAY, (F.col("securities") - F.col("n")).alias("missing_securities"), (F.col("rows") - F.col("n")).alias("repeated_rows"))
    )
    return rows, findings
