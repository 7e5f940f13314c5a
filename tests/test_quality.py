import datetime as dt

from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import foundation, quality
from tests.builders import D, KEY_SCHEMA, rows, sessions

RULE = quality.TableRule(
    "t",
    (
        quality.FieldRule("market_code"),
        quality.FieldRule("security_code"),
        quality.FieldRule("day", "date"),
        quality.FieldRule("flag", "boolean"),
        quality.FieldRule("seen_at", "datetime", nullable=True),
        quality.FieldRule("note", required=False, nullable=True),
    ),
    primary_key=("security_code", "day"),
    business_date="day",
    security_code="security_code",
    pit_fields=("seen_at",),
)
SCHEMA = KEY_SCHEMA + ", day string, flag string, seen_at string, note string"
GOOD = [
    ("XSHG", "600001.XSHG", "2024-01-02", "true", "2024-01-02T10:00:00+08:00", ""),
    ("XSHG", "600002.XSHG", "2024-01-03", "0", "2024-01-03T10:00:00Z", "x"),
]


def codes(spark, data, rule=RULE, drop=(), fetch=None):
    df = spark.createDataFrame(data, SCHEMA).drop(*drop)
    found = quality.validate_table(df, rule, D(2024, 1, 1), D(2024, 1, 31), fetch)
    return rows(found, "code", "field", "affected_rows")


def changed(**values):
    names = ["market_code", "security_code", "day", "flag", "seen_at", "note"]
    return [tuple(values.get(n, v) for n, v in zip(names, GOOD[0])), GOOD[1]]


def test_clean_table_has_no_findings(spark):
    assert codes(spark, GOOD) == []


def test_deleted_field(spark):
    assert codes(spark, GOOD, drop=["flag"]) == [("E101", "flag", 2)]
    assert codes(spark, GOOD, drop=["note"]) == [("W102", "note", 2)]


def test_duplicated_row(spark):
    assert codes(spark, GOOD + GOOD[:1]) == [("E302", "security_code + day", 2)]


def test_wrong_code_and_date(spark):
    assert codes(spark, changed(security_code="12345")) == [("E401", "security_code", 1)]
    assert codes(spark, changed(day="2024-02-01")) == [("E402", "day", 1)]
    assert codes(spark, changed(day="2024/01/02")) == [("E201", "day", 1)]
    assert codes(spark, changed(flag="perhaps")) == [("E201", "flag", 1)]


def test_information_after_the_cutoff(spark):
    late = "2024-01-31T16:00:00Z"  # midnight in Shanghai: just past the last day
    assert codes(spark, changed(seen_at=late)) == [("E701", "seen_at", 1)]
    assert codes(spark, changed(seen_at="2024-01-31T15:59:59Z")) == []
    # a time without offset cannot be judged
    assert codes(spark, changed(seen_at="2024-01-02T10:00:00")) == [("E201", "seen_at", 1)]
    fetch = spark.sql(f"SELECT timestamp'{late}' AS fetched_at")
    assert codes(spark, changed(seen_at=late), fetch=fetch) == [("W701", "seen_at", 1)]
    assert codes(spark, changed(seen_at="")) == [("W701", "seen_at", 1)]


def test_null_key_part(spark):
    assert ("E301", "security_code + day", 1) in codes(spark, changed(security_code=""))


def test_verdict(spark):
    df = spark.createDataFrame([("t", "W1", "一般", "", 1)], quality.FINDING)
    assert quality.verdict(df).first().status == "WARNING"
    assert quality.verdict(df.where("false")).first().status == "PASS"
    assert quality.verdict(df.withColumn("severity", F.lit("严重"))).first().allow_run is False


DAYS = sessions(D(2024, 1, 1), 5)


def facts(spark, data, cols):
    return spark.createDataFrame(data, KEY_SCHEMA + ", trading_date date, " + cols)


def day_frame(spark):
    return spark.createDataFrame([("XSHG", d) for d in DAYS], "market_code string, trading_date date")


def test_terminal_bar_is_tolerated_and_audited(spark):
    key = ("XSHG", "600001.XSHG")
    life = spark.createDataFrame([(*key, DAYS[0], DAYS[3])], KEY_SCHEMA + ", listed_date date, delisted_date date")
    cols = "open_price double, high_price double, low_price double, close_price double, volume double, amount double"
    flat, live = (1.0, 1.0, 1.0, 1.0, 0.0, 0.0), (1.0, 2.0, 1.0, 1.5, 9.0, 9.0)
    bar = lambda d, v: facts(spark, [(*key, d, *v)], cols)
    check = lambda df: foundation.facts_outside_lifecycle(df, life, day_frame(spark), "daily_price_unadjusted", df).count()
    assert check(bar(DAYS[3], flat)) == 0
    assert check(bar(DAYS[3], live)) == 1
    assert check(bar(DAYS[4], flat)) == 1
    assert foundation.terminal_markers(bar(DAYS[3], flat), life, "x", bar(DAYS[3], flat)).count() == 1


def test_calendar_coverage_levels(spark):
    life = spark.createDataFrame(
        [("XSHG", "600001.XSHG", D(2020, 1, 1), None), ("XSHG", "600002.XSHG", D(2020, 1, 1), None)], KEY_SCHEMA + ", listed_date date, delisted_date date"
    )
    sat = DAYS[4] + dt.timedelta(days=1)
    data = [("XSHG", "600001.XSHG", d, "TRADED") for d in DAYS[:4]] + [("XSHG", "600002.XSHG", d, "停牌") for d in DAYS[:3]]
    found = quality.market_calendar_coverage(day_frame(spark), facts(spark, data + [("XSHG", "600001.XSHG", sat, "TRADED")], "trading_status string"), life)
    assert rows(found, "code", "trading_date", "affected_rows") == [
        ("E601", sat, 1), ("E602", DAYS[4], 2), ("E604", DAYS[3], 1),
        ("W605", DAYS[0], 1), ("W605", DAYS[1], 1), ("W605", DAYS[2], 1),
    ]


def test_thin_and_missing_quarter_days(spark):
    data = [(d, f"{i:06d}.SH") for d in DAYS[:4] for i in range(10 if d != DAYS[1] else 7)]
    data += [(DAYS[4] + dt.timedelta(days=1), "000001.SH")]
    wide = spark.createDataFrame(data, "biz_date date, stk_code string")
    found = quality.quarter_coverage(wide, day_frame(spark), (D(2024, 1, 1), D(2024, 3, 31)))
    assert rows(found, "code", "finding_date") == [("E921", DAYS[4] + dt.timedelta(days=1)), ("E925", DAYS[4]), ("E927", DAYS[1])]
    none = quality.quarter_coverage(wide, day_frame(spark), (D(2025, 1, 1), D(2025, 3, 31)))
    assert [r.code for r in none.collect()] == ["E928"]


def test_mapping_consistency(spark):
    m = R.BrokerMapping.from_dangerous("v1", {"B1": "G"})
    df = spark.createDataFrame(
        [("B1", "A", "v1", "NON_DANGEROUS", "v1:B1:A"), ("B1", "G", "v0", "NON_DANGEROUS", "?"), ("B1", "Z", "v1", "", "")],
        "broker_id string, raw_classification string, classification_mapping_version string, standardized_risk_bucket string, mapping_record_id string",
    )
    assert rows(quality.mapping_consistency(df, m), "code", "affected_rows") == [("E902", 1), ("E903", 1), ("E904", 1), ("E905", 1)]
