"""Rule-pack data quality: every check is a DataFrame of findings.

Column checks of one table are conditional counts in a single aggregate, so a
table is scanned once however many fields and rules it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators.panel import DAY, day_arrays, expected_days
from earlybell.sources.readers import history_manifest, quarter_file_set, read_text_csv_parts
from earlybell.sources.staging import store

CODE_PATTERN = rf"^{R.CODE_DIGITS}(\.(XSHG|XSHE|XBSE))?$"
FINDING = "table_name string, code string, severity string, field string, affected_rows bigint"
BLOCKING = "严重"
NOTICE = "一般"


@dataclass(frozen=True)
class FieldRule:
    name: str
    data_type: str = "string"
    required: bool = True
    nullable: bool = False
    allowed: tuple[str, ...] | None = None


@dataclass(frozen=True)
class TableRule:
    name: str
    fields: tuple[FieldRule, ...]
    primary_key: tuple[str, ...]
    business_date: str | None = None
    security_code: str | None = None
    pit_fields: tuple[str, ...] = ()
    effective_rules: tuple[tuple[str, str], ...] = ()
    required: bool = True


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def _invalid(rule: FieldRule) -> Column:
    text = F.trim(F.col(rule.name).cast("string"))
    if rule.data_type in ("date", "datetime", "decimal", "integer"):
        wrong = S.convert(rule.name, rule.data_type).isNull()
        if rule.data_type == "date":
            wrong = wrong | ~text.rlike(r"^\d{4}-\d{2}-\d{2}$")
        return ~_blank(rule.name) & wrong
    if rule.data_type == "boolean":
        return ~_blank(rule.name) & ~F.lower(text).isin("true", "false", "1", "0", "是", "否")
    return F.lit(False)


def schema_findings(df: DataFrame | None, rule: TableRule, spark) -> DataFrame:
    """Missing table, unknown columns and missing fields, with the rows concerned (Q1).

    What is wrong is known from the schema; the table is only counted.
    """
    if df is None:
        missing = [(rule.name, "E002", BLOCKING, "", 0)] if rule.required else []
        return spark.createDataFrame(missing, FINDING)
    present, known = set(df.columns), {f.name for f in rule.fields}
    rows = [("W101", NOTICE, c) for c in sorted(present - known)]
    for f in rule.fields:
        if f.name in present:
            continue
        if f.name in rule.pit_fields:
            rows.append(("W701", NOTICE, f.name))
        else:
            rows.append(("E101", BLOCKING, f.name) if f.required else ("W102", NOTICE, f.name))
    return counted_findings(df, rule.name, [(*row, F.lit(True)) for row in rows], keep_empty=True)


def counted_findings(df: DataFrame, table: str, checks: Sequence[tuple[str, str, str, Column]], *, keep_empty: bool = False) -> DataFrame:
    """One aggregate over all checks, unpivoted to findings with a positive count."""
    if not checks:
        return df.sparkSession.createDataFrame([], FINDING)
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (*_, cond) in enumerate(checks)])
    items = F.array(
        *[
            F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"), F.lit(name).alias("field"), F.col(f"c{i}").alias("n"))
            for i, (code, sev, name, _) in enumerate(checks)
        ]
    )
    out = counts.select(F.explode(items).alias("x"))
    if not keep_empty:
        out = out.where("x.n > 0")
    return out.select(
        F.lit(table).alias("table_name"), "x.code", "x.severity", "x.field", F.col("x.n").alias("affected_rows")
    )


def field_checks(rule: TableRule, columns: Sequence[str]) -> list[tuple[str, str, str, Column]]:
    """Nulls, PIT nulls, types and enumerations (Q2)."""
    checks = []
    for f in rule.fields:
        if f.name not in columns:
            continue
        if f.name in rule.pit_fields:
            checks.append(("W701", NOTICE, f.name, _blank(f.name)))
        elif not f.nullable:
            checks.append(("E501", BLOCKING, f.name, _blank(f.name)))
        if f.data_type != "string":
            checks.append(("E201", BLOCKING, f.name, _invalid(f)))
        if f.allowed is not None:
            checks.append(
                ("E202", BLOCKING, f.name, ~_blank(f.name) & ~F.trim(F.col(f.name).cast("string")).isin(*f.allowed))
            )
    return checks


def row_checks(rule: TableRule, columns: Sequence[str], start: date, end: date) -> list[tuple[str, str, str, Column]]:
    """Code pattern (Q4), observation window (Q5) and effective dates (Q6)."""
    checks = []
    if rule.security_code in columns:
        checks.append(("E401", BLOCKING, rule.security_code, ~F.coalesce(F.trim(F.col(rule.security_code).cast("string")).rlike(CODE_PATTERN), F.lit(False))))
    if rule.business_date in columns:
        day = S.convert(rule.business_date, "date")
        checks.append(("E402", BLOCKING, rule.business_date, ~day.between(F.lit(start), F.lit(end))))
    for effective, usage in rule.effective_rules:
        if effective in columns and usage in columns:
            local = S.china_date(S.convert(effective, "datetime"))
            checks.append(("E702", BLOCKING, effective, local > S.convert(usage, "date")))
    return checks


def pit_findings(df: DataFrame, rule: TableRule, end: date, fetch_times: DataFrame | None = None) -> DataFrame:
    """Information times after the cutoff; a time equal to a fetch time is only a notice (Q6).

    ``fetch_times`` (fetched_at) lists download moments, one per source artefact.
    The join is an ordinary one: Catalyst broadcasts the list while it is small.
    """
    # end of the last day on the Shanghai clock, as an instant
    cutoff = F.lit(f"{end.isoformat()}T23:59:59.999999+08:00").cast("timestamp")
    out = df.sparkSession.createDataFrame([], FINDING)
    for name in rule.pit_fields:
        if name not in df.columns:
            continue
        # rows fold per moment before the join: many rows share one download time
        moments = df.groupBy(S.convert(name, "datetime").alias("fetched_at")).agg(F.count("*").alias("n")).where(
            F.col("fetched_at").isNotNull()
        )
        if fetch_times is None:
            marked = moments.withColumn("mark", F.lit(None).cast("boolean"))
        else:
            marks = fetch_times.select("fetched_at").distinct().withColumn("mark", F.lit(True))
            marked = moments.join(marks, "fetched_at", "left")
        late = F.col("mark").isNull() & (F.col("fetched_at") > cutoff)
        totals = marked.agg(
            F.sum(F.when(F.col("mark"), F.col("n"))).alias("proxy"), F.sum(F.when(late, F.col("n"))).alias("future")
        )
        items = F.array(
            F.struct(F.lit("W701").alias("code"), F.lit(NOTICE).alias("severity"), F.col("proxy").alias("n")),
            F.struct(F.lit("E701").alias("code"), F.lit(BLOCKING).alias("severity"), F.col("future").alias("n")),
        )
        out = out.unionByName(
            totals.select(F.explode(items).alias("x")).where("x.n > 0").select(
                F.lit(rule.name).alias("table_name"), "x.code", "x.severity", F.lit(name).alias("field"), F.col("x.n").alias("affected_rows")
            )
        )
    return out


def primary_key_findings(df: DataFrame, rule: TableRule) -> DataFrame:
    """Rows with a null key part (E301) and rows of repeated keys (E302) (Q3)."""
    name = " + ".join(rule.primary_key)
    blank = F.greatest(*[_blank(k).cast("int") for k in rule.primary_key]) == 1 if len(rule.primary_key) > 1 else _blank(rule.primary_key[0])
    per_key = df.groupBy(*rule.primary_key).agg(F.count("*").alias("n"), F.max(blank).alias("blank"))
    totals = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("n"))), F.lit(0)).alias("e301"),
        F.coalesce(F.sum(F.when(~F.col("blank") & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("e302"),
    )
    items = F.array(
        F.struct(F.lit("E301").alias("code"), F.col("e301").alias("n")),
        F.struct(F.lit("E302").alias("code"), F.col("e302").alias("n")),
    )
    return totals.select(F.explode(items).alias("x")).where("x.n > 0").select(
        F.lit(rule.name).alias("table_name"),
        "x.code",
        F.lit(BLOCKING).alias("severity"),
        F.lit(name).alias("field"),
        F.col("x.n").alias("affected_rows"),
    )


def empty_findings(df: DataFrame, rule: TableRule) -> DataFrame:
    return df.limit(1).agg(F.count("*").alias("n")).where("n = 0").select(
        F.lit(rule.name).alias("table_name"), F.lit("E005").alias("code"), F.lit(BLOCKING).alias("severity"),
        F.lit("").alias("field"), F.lit(0).cast("bigint").alias("affected_rows"),
    )


def validate_table(
    df: DataFrame, rule: TableRule, start: date, end: date, fetch_times: DataFrame | None = None
) -> DataFrame:
    """Every rule of one table: Q1-Q6."""
    cols = df.columns
    out = schema_findings(df, rule, df.sparkSession).unionByName(empty_findings(df, rule))
    out = out.unionByName(counted_findings(df, rule.name, field_checks(rule, cols) + row_checks(rule, cols, start, end)))
    if set(rule.primary_key) <= set(cols):
        out = out.unionByName(primary_key_findings(df, rule))
    return out.unionByName(pit_findings(df, rule, end, fetch_times))


def verdict(findings: DataFrame) -> DataFrame:
    """PASS / WARNING / FAIL and the allow flag of a finding set."""
    severe = F.count_if(F.col("severity") == BLOCKING)
    return findings.agg(
        F.when(severe > 0, "FAIL").when(F.count("*") > 0, "WARNING").otherwise("PASS").alias("status"),
        (severe == 0).alias("allow_run"),
        severe.alias("severe_count"),
        F.count("*").alias("finding_count"),
    )


def table_statistics(df: DataFrame, table: str, day: str) -> DataFrame:
    """Row count, date extent, markets and securities (Q7)."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count_distinct("market_code").alias("market_count"),
        F.count_distinct("security_code").alias("security_count"),
    ).select(F.lit(table).alias("table_name"), "*")


# --- semantic checks --------------------------------------------------------
def market_calendar_coverage(days: DataFrame, market: DataFrame, life: DataFrame) -> DataFrame:
    """Coverage of expected security-days by market rows (Q8).

    Findings are per day: E601 rows on closed days, E602 a whole day without rows,
    E603 a market without rows, E604 single securities without rows, W605
    explicit suspensions. Expected and actual keys meet in one folded shuffle.
    """
    grid = expected_days(life, days).select(*R.KEY, DAY, F.lit(1).alias("e"), F.lit(0).alias("a"), F.lit(0).alias("s"))
    suspended = F.trim("trading_status").isin(*R.SUSPENDED_STATUS).cast("int")
    actual = market.select(*R.KEY, DAY, F.lit(0).alias("e"), F.lit(1).alias("a"), suspended.alias("s"))
    per_key = (
        grid.unionByName(actual)
        .groupBy(*R.KEY, DAY)
        .agg(F.max("e").alias("e"), F.sum("a").alias("a"), F.sum("s").alias("s"))
    )
    per_market = per_key.groupBy(DAY, "market_code").agg(
        F.sum("e").alias("expected"),
        F.sum("a").alias("rows"),
        F.count_if(F.col("a") > 0).alias("securities"),
        F.count_if((F.col("e") == 1) & (F.col("a") == 0)).alias("missing"),
        F.sum("s").alias("suspended"),
    )
    per_day = per_market.groupBy(DAY).agg(
        F.sum("rows").alias("rows"),
        F.sum("expected").alias("expected"),
        F.sum("missing").alias("missing"),
        F.sum("suspended").alias("suspended"),
        F.count_if((F.col("expected") > 0) & (F.col("securities") == 0)).alias("missing_markets"),
    )
    open_days = days.select(DAY).distinct().withColumn("is_open", F.lit(True))
    flagged = per_day.join(open_days, DAY, "left").withColumn("is_open", F.coalesce("is_open", F.lit(False)))
    some = F.col("rows") > 0
    items = F.array(
        _item("E601", BLOCKING, F.when(~F.col("is_open"), F.col("rows"))),
        _item("E602", BLOCKING, F.when(F.col("is_open") & ~some & (F.col("expected") > 0), F.col("expected"))),
        _item("E603", BLOCKING, F.when(some, F.col("missing_markets"))),
        _item("E604", BLOCKING, F.when(some, F.col("missing"))),
        _item("W605", NOTICE, F.col("suspended")),
    )
    return flagged.select(DAY, F.explode(items).alias("x")).where("x.n > 0").select(
        "x.code", "x.severity", DAY, F.col("x.n").alias("affected_rows")
    )


def _item(code: str, severity: str, n: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), n.cast("bigint").alias("n"))


def lifecycle_truncation(life: DataFrame, days: DataFrame) -> DataFrame:
    """Sessions excluded before listing (W805) or from delisting on (W806) per security (Q8)."""
    joined = life.join(day_arrays(days), "market_code")
    early = F.filter("days", lambda x: x < F.col("listed_date"))
    late = F.filter("days", lambda x: x >= F.col("delisted_date"))
    both = joined.select(
        *R.KEY,
        F.explode(
            F.array(
                F.struct(F.lit("W805").alias("code"), early.alias("d")),
                F.struct(F.lit("W806").alias("code"), late.alias("d")),
            )
        ).alias("x"),
    ).where(F.size("x.d") > 0)
    return both.select(
        "x.code",
        F.lit(NOTICE).alias("severity"),
        *R.KEY,
        F.size("x.d").cast("bigint").alias("affected_rows"),
        F.array_min("x.d").alias("first_day"),
        F.array_max("x.d").alias("last_day"),
    )


def lifecycle_consistency(records: DataFrame, life: DataFrame, *, day: str, exclusive: bool = True) -> DataFrame:
    """Business rows of unknown, misplaced, unlisted or delisted securities (Q9)."""
    markets = life.groupBy("security_code").agg(F.min("market_code").alias("any_market"))
    exact = life.select(*R.KEY, "listed_date", "delisted_date", F.lit(True).alias("known"))
    late = F.col(day) >= F.col("delisted_date") if exclusive else F.col(day) > F.col("delisted_date")
    code = (
        F.when(F.col("known").isNull() & F.col("any_market").isNull(), "E801")
        .when(F.col("known").isNull(), "E802")
        .when(F.col(day) < F.col("listed_date"), "E803")
        .when(late, "E804")
    )
    return (
        # rows of one security-day share a verdict, so they fold before the joins
        records.where(F.col(day).isNotNull())
        .groupBy(*R.KEY, day)
        .agg(F.count("*").alias("rows"))
        .join(exact, list(R.KEY), "left")
        .join(markets, "security_code", "left")
        .withColumn("code", code)
        .where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.sum("rows").alias("affected_rows"))
        .withColumn("severity", F.lit(BLOCKING))
    )


def mapping_consistency(records: DataFrame, mapping: R.BrokerMapping) -> DataFrame:
    """Stored standardised buckets against the exact mapping (Q10)."""
    table = mapping.frame(records.sparkSession).withColumnRenamed("mapping_record_id", "expected_record_id")
    joined = records.join(F.broadcast(table), ["broker_id", "raw_classification"], "left")
    known = F.col("mapped_bucket").isNotNull()
    checks = [
        ("E902", BLOCKING, "raw_classification", ~known),
        ("E903", BLOCKING, "classification_mapping_version", known & (F.col("classification_mapping_version") != mapping.version)),
        ("E904", BLOCKING, "standardized_risk_bucket", known & (F.col("standardized_risk_bucket") != F.col("mapped_bucket"))),
        ("E905", BLOCKING, "mapping_record_id", known & (F.col("mapping_record_id") != F.col("expected_record_id"))),
    ]
    if mapping.status != "approved":
        checks.append(("W901", NOTICE, "classification_mapping_version", F.lit(True)))
    return counted_findings(joined, "broker_risk_classification", checks)


def wide_quality(
    wide: DataFrame,
    brokers: Sequence[str],
    *,
    day: str = "biz_date",
    code: str = "stk_code",
    suffixes: Sequence[str] = ("SZ", "SH"),
    minimum_filled: int = 3,
    digits: str = R.CODE_DIGITS,
) -> DataFrame:
    """Weekend rows, code format, market scope and fill density of a wide history (Q11)."""
    text = F.upper(F.trim(F.col(code)))
    good = F.coalesce(text.rlike(rf"^{digits}\.(SZ|SH|BJ)$"), F.lit(False))
    inside = F.regexp_extract(text, r"\.([A-Z]+)$", 1).isin(*suffixes)
    weekend = S.is_weekend(day)
    filled = sum((F.when(~_blank(b), 1).otherwise(0) for b in brokers), F.lit(0))
    return counted_findings(
        wide,
        "wide_history",
        [
            ("E921", BLOCKING, day, weekend),
            ("E924", BLOCKING, code, ~good),
            ("E922", BLOCKING, code, good & ~inside),
            ("E923", BLOCKING, "brokers", F.col(day).isNotNull() & ~weekend & good & inside & (filled < minimum_filled)),
        ],
    )


def quarter_coverage(
    wide: DataFrame,
    days: DataFrame,
    quarter: tuple[date, date],
    *,
    day: str = "biz_date",
    code: str = "stk_code",
    minimum_ratio: float = 0.8,
) -> DataFrame:
    """Missing, off-calendar, weekend and thin days of one quarter's history (Q12)."""
    start, end = quarter
    cal = (
        days.select(F.col(DAY).alias("d")).distinct().where(F.col("d").between(F.lit(start), F.lit(end)))
        .withColumn("is_open", F.lit(True))
    )
    per_day = (
        wide.where(F.col(day).between(F.lit(start), F.lit(end)))
        .groupBy(F.col(day).alias("d"))
        .agg(F.count("*").alias("rows"), F.count_distinct(code).alias("securities"))
    )
    merged = cal.join(per_day, "d", "full_outer").withColumn("is_open", F.coalesce("is_open", F.lit(False)))
    typical = merged.where("is_open").agg(F.median("securities").alias("typical")).withColumn("one", F.lit(1))
    calendar_size = cal.agg(F.count("*").alias("open_days")).withColumn("one", F.lit(1))
    judged = merged.withColumn("one", F.lit(1)).join(F.broadcast(typical), "one").join(F.broadcast(calendar_size), "one")
    thin = F.col("is_open") & F.col("securities").isNotNull() & (F.col("securities") < F.col("typical") * minimum_ratio)
    found = judged.where("open_days > 0").select(
        "d",
        F.when(F.col("is_open") & F.col("rows").isNull(), F.struct(F.lit("E925").alias("code"), F.lit(NOTICE).alias("severity"), F.lit(1).cast("bigint").alias("n")))
        .when(~F.col("is_open") & S.is_weekend("d"), F.struct(F.lit("E921").alias("code"), F.lit(BLOCKING).alias("severity"), F.col("rows").alias("n")))
        .when(~F.col("is_open"), F.struct(F.lit("E926").alias("code"), F.lit(BLOCKING).alias("severity"), F.col("rows").alias("n")))
        .when(thin, F.struct(F.lit("E927").alias("code"), F.lit(BLOCKING).alias("severity"), F.lit(1).cast("bigint").alias("n")))
        .alias("x"),
    ).where(F.col("x").isNotNull())
    none = calendar_size.where("open_days = 0").select(
        F.lit("E928").alias("code"), F.lit(BLOCKING).alias("severity"), F.lit(None).cast("date").alias("finding_date"),
        F.lit(0).cast("bigint").alias("affected_rows"),
    )
    return found.select(
        "x.code", "x.severity", F.col("d").alias("finding_date"), F.col("x.n").alias("affected_rows")
    ).unionByName(none)


def history_integrity(history: DataFrame, days: DataFrame, end: date) -> DataFrame:
    """Checks of a quarter file set (Q14).

    ``history`` needs file_name, biz_date and stk_code. BM103 repeated key, BM104
    date outside the file's quarter or off calendar, BM105 end not covered, BM106
    weekend rows. Rows fold per file, key and day before anything is counted.
    """
    parts = F.regexp_extract("file_name", r"(\d{4})Q[1-4]", 1), F.regexp_extract("file_name", r"\d{4}Q([1-4])", 1)
    cal = days.select(F.col(DAY).alias("biz_date"), F.lit(True).alias("is_open")).distinct()
    per_key = history.groupBy("file_name", "biz_date", F.trim("stk_code").alias("stk_code")).agg(F.count("*").alias("n"))
    per_day = (
        per_key.groupBy("file_name", "biz_date")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.col("n") - 1).alias("repeated"),
            F.sum(F.when(F.col("stk_code").rlike(r"\.(SH|SZ)$"), F.col("n")).otherwise(0)).alias("risk_rows"),
        )
        .join(cal, "biz_date", "left")
    )
    weekend = S.is_weekend("biz_date")
    in_quarter = (F.year("biz_date").cast("string") == parts[0]) & (F.quarter("biz_date").cast("string") == parts[1])
    per_file = per_day.groupBy("file_name").agg(
        F.sum("repeated").alias("BM103_HISTORY_KEY_DUPLICATE"),
        F.sum(F.when(~in_quarter, F.col("rows")).otherwise(0)).alias("BM104_HISTORY_QUARTER_DATE_INVALID"),
        F.sum(F.when(~weekend & F.col("is_open").isNull(), F.col("risk_rows")).otherwise(0)).alias(
            "BM104_HISTORY_NON_TRADING_DATE_INVALID"
        ),
        F.sum(F.when(weekend, F.col("rows")).otherwise(0)).alias("BM106_WEEKEND_HISTORY_ROW_IGNORED"),
    )
    codes = [c for c in per_file.columns if c.startswith("BM")]
    found = per_file.unpivot("file_name", codes, "code", "affected_rows").where("affected_rows > 0")
    latest = per_day.where(~weekend & (F.col("risk_rows") > 0)).agg(F.max("biz_date").alias("last")).withColumn("one", F.lit(1))
    expected = days.where(F.col(DAY) <= F.lit(end)).agg(F.max(DAY).alias("want")).withColumn("one", F.lit(1))
    gap = (
        latest.join(expected, "one")
        .where(~F.col("last").eqNullSafe(F.col("want")))
        .select(
            F.lit("").alias("file_name"),
            F.lit("BM105_HISTORY_COVERAGE_MISSING").alias("code"),
            F.lit(1).cast("bigint").alias("affected_rows"),
        )
    )
    return found.unionByName(gap).withColumn(
        "severity", F.when(F.col("code").startswith("BM106"), "INFO").otherwise("ERROR")
    )


def history_set_findings(manifest: DataFrame, expected: Sequence[str] | None, columns: Sequence[str]) -> DataFrame:
    """Findings that a manifest of headers alone decides (Q14): BM101 names that are missing,
    unexpected, unreadable or leave a quarter out, BM102 headers other than ``columns``.

    ``manifest`` needs file_name and header. Without ``expected``, names must be quarters
    that follow each other.
    """
    names = manifest.select("file_name").distinct()
    if expected is None:
        odd = quarter_file_set(names).where("status <> 'OK'").select("file_name")
    else:
        wanted = manifest.sparkSession.createDataFrame([(n,) for n in expected], "file_name string")
        odd = names.join(wanted, "file_name", "left_anti").union(wanted.join(names, "file_name", "left_anti"))
    bare = F.transform(F.split("header", ","), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    wrong = ~F.coalesce(bare == F.array(*[F.lit(c) for c in columns]), F.lit(False))
    layouts = manifest.where(wrong).groupBy("file_name").agg(F.count_distinct(F.coalesce("header", F.lit(""))).alias("affected_rows"))
    return (
        odd.select("file_name", F.lit("BM101_HISTORY_FILE_SET_MISMATCH").alias("code"), F.lit(1).cast("bigint").alias("affected_rows"))
        .unionByName(layouts.select("file_name", F.lit("BM102_HISTORY_SCHEMA_MISMATCH").alias("code"), "affected_rows"))
        .withColumn("severity", F.lit("ERROR"))
    )


def history_files_integrity(
    spark: SparkSession, root: str, brokers: Sequence[str], days: DataFrame, end: date, expected: Sequence[str] | None = None
) -> DataFrame:
    """All checks of a stored quarter file set (Q14, BM101 to BM106).

    File set and schema are decided by the headers; rows are read only from the files whose
    header is right, so that no row is taken by the position of another layout.
    """
    columns = ("biz_date", "stk_code", *brokers)
    manifest = store(history_manifest(spark, root), "history_manifest")
    found = store(history_set_findings(manifest, expected, columns), "history_findings")
    wrong = found.where(F.col("code").startswith("BM102")).select("file_name")
    fit = [r.path for r in manifest.join(wrong, "file_name", "left_anti").select("path").collect()]  # a row per file
    if not fit:
        return found
    rows = read_text_csv_parts(spark, fit).withColumn("biz_date", S.convert("biz_date", "date"))
    return found.unionByName(history_integrity(rows.select("file_name", "biz_date", "stk_code"), days, end))


def history_st_reconciliation(history: DataFrame, st: DataFrame, life: DataFrame, start: date, end: date) -> DataFrame:
    """Securities on only one side of history and ST, judged by lifecycle overlap."""
    both = (
        history.select(*R.KEY, F.lit(1).alias("h"), F.lit(0).alias("s"))
        .unionByName(st.select(*R.KEY, F.lit(0).alias("h"), F.lit(1).alias("s")))
        .groupBy(*R.KEY)
        .agg(F.max("h").alias("h"), F.max("s").alias("s"))
        .where("h <> s")
        .join(life.select(*R.KEY, "listed_date", "delisted_date", F.lit(True).alias("known")), list(R.KEY), "left")
    )
    overlap = (F.col("listed_date") <= F.lit(end)) & (
        F.col("delisted_date").isNull() | (F.col("delisted_date") >= F.lit(start))
    )
    out = (
        F.when(F.col("known").isNull(), F.struct(F.lit("BM204_LIFECYCLE_EVIDENCE_MISSING").alias("code"), F.lit("ERROR").alias("severity")))
        .when((F.col("h") == 1) & overlap, F.struct(F.lit("BM203_ST_STATUS_MISSING").alias("code"), F.lit("ERROR").alias("severity")))
        .when(F.col("h") == 1, F.struct(F.lit("BM108_HISTORY_ONLY_SECURITY_OUTSIDE_OBSERVATION").alias("code"), F.lit("INFO").alias("severity")))
        .when(overlap, F.struct(F.lit("BM109_SECURITY_HISTORY_MISSING").alias("code"), F.lit("WARNING").alias("severity")))
        .otherwise(F.struct(F.lit("BM107_ST_ONLY_SECURITY_OUTSIDE_OBSERVATION").alias("code"), F.lit("INFO").alias("severity")))
    )
    return both.select(*R.KEY, out.alias("o")).select("o.code", "o.severity", *R.KEY)
