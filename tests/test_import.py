"""Offline import and its validation on hand-made batches."""

import random
from collections import Counter
from datetime import date

import pytest

from earlybell.operators import cache_import as ci
from earlybell.operators import candidate

MASTER = "market_code string, security_code string, security_type string, board_code string, status_date string, listed_date string, delisted_date string"
MARKET = "market_code string, security_code string, trading_date string, trading_status string, open_price string, high_price string, low_price string, close_price string, volume string, turnover string, limit_up_price string, limit_down_price string"
STATUS = "market_code string, security_code string, risk_status_type string, risk_status_value string, status_start_date string, status_end_date string"
A, B, LATE = "600001.XSHG", "000002.XSHE", "600009.XSHG"


def master(code, status, board="Main", listed="2024-01-01", ended=""):
    return (code[-4:], code, "CS", board, status, listed, ended)


def bar(code, day, state="正常成交", close="10", volume="5"):
    return (code[-4:], code, day, state, "9", "11", "8", close, volume, "50", "12", "7.5")


def status(code, day, value="生效", kind="ST", end=None):
    return (code[-4:], code, kind, value, day, end or day)


def sources(spark, **change):
    parts = {
        "calendar": ([("cn", "2024-01-02", "true"), ("cn", "2024-01-03", "0"), ("cn", "2024-01-04", "TRUE"), ("cn", "2024-1-5", "true"), ("us", "2024-01-08", "true")], "market_code string, calendar_date string, is_trading_day string"),
        "master": ([master(A, "2024-01-01"), master(A, "2024-01-03", "STAR"), master(B, "2024-01-02", ended="2024-01-04", listed="2024-01-02"), master(LATE, "2024-01-01"), master(LATE, "2024-01-01", "Other")], MASTER),
        "market": ([bar(A, "2024-01-02"), bar(A, "2024-01-03", "停牌", "", ""), bar(A, "2024-01-04", "halt"), bar(B, "2024-01-04"), bar(B, "2024-01-03", close="x"), bar("999999.XSHG", "2024-01-02")], MARKET),
        "risk_status": ([status(A, "2024-01-02"), status(A, "2024-01-03", "未生效"), status(A, "2024-01-04", "?"), status(B, "2024-01-02", end="2024-01-03"), status(B, "2023-12-29")], STATUS),
        "suspension": ([(A, "2024-01-02", "false"), (B, "2024-01-03T00:00", "1"), (A, "2024-01-04", "maybe")], "order_book_id string, date string, is_suspended string"),
    }
    made = {k: spark.createDataFrame(*v) for k, v in parts.items()}
    return ci.ImportSources(**(made | change))


def verdicts(spark, **change):
    rows = ci.records(sources(spark, **change)).collect()
    return Counter((r.dataset_id, r.verdict) for r in rows)


def test_verdicts(spark):
    got = verdicts(spark)
    assert got == Counter(
        {
            (ci.CALENDAR, ci.KEPT): 6,
            (ci.CALENDAR, ci.INVALID): 4,
            (ci.MASTER, ci.KEPT): 3,
            (ci.MASTER, ci.INVALID): 2,
            (ci.PRICES, ci.KEPT): 2,
            (ci.PRICES, ci.INVALID): 2,
            (ci.PRICES, ci.OUTSIDE): 1,
            (ci.PRICES, ci.UNKNOWN): 1,
            (ci.LIMITS, ci.KEPT): 4,
            (ci.LIMITS, ci.OUTSIDE): 1,
            (ci.LIMITS, ci.UNKNOWN): 1,
            (ci.ST, ci.KEPT): 2,
            (ci.ST, ci.INVALID): 2,
            (ci.ST, ci.OUTSIDE): 1,
            (ci.SUSPENSION, ci.KEPT): 2,
            (ci.SUSPENSION, ci.INVALID): 1,
        }
    )


def test_suspension_shapes_agree(spark):
    days = [(A, "2024-01-02", "true"), (A, "2024-01-03", "true"), (B, "2024-01-02", "false")]
    daily = spark.createDataFrame(days, "order_book_id string, date string, is_suspended string")
    spans = spark.createDataFrame([(A, "2024-01-02", "2024-01-03", "true"), (B, "2024-01-02", "2024-01-02", "false")], "order_book_id string, start_date string, end_date string, is_suspended string")
    wide = spark.createDataFrame([("2024-01-02", "true", "false"), ("2024-01-03", "true", None)], f"date string, `{A}` string, `{B}` string")
    for shape in (daily, spans, wide):
        assert sorted(tuple(r) for r in ci.suspension_days(shape).collect()) == sorted(days)
    turned = spark.createDataFrame([(A, "2024-01-03", "2024-01-02", "true")], spans.schema)
    assert [tuple(r) for r in ci.suspension_days(turned).collect()] == [(A, None, "true")]


def test_import_writes_what_it_counts(spark, tmp_path):
    path = str(tmp_path / "facts")
    result = ci.import_batch(sources(spark), path)
    counts = {r.dataset_id: r.kept_rows for r in result.counts.collect()}
    held = Counter(r.dataset_id for r in ci.read_import(spark, path).collect())
    assert counts == dict(held) and not result.fit
    row = ci.read_import(spark, path, ci.MASTER).where("board_code = 'Main' AND market_code = 'XSHG'").first()
    assert (row.effective_start, row.effective_end) == (date(2024, 1, 1), date(2024, 1, 2))
    assert row.business_key == "XSHG|600001|2024-01-01"


def test_conflicting_lifecycles_are_named(spark, tmp_path):
    rows = spark.createDataFrame([master(A, "2024-01-01"), master(A, "2024-01-02", listed="2023-01-01")], MASTER)
    result = ci.import_batch(sources(spark, master=rows), str(tmp_path / "facts"))
    assert [tuple(r) for r in result.conflicts.collect()] == [("LIFECYCLE_CONFLICT", A)]


@pytest.mark.parametrize("seed", range(3))
def test_digest_difference_equals_multisets(spark, seed):
    rng = random.Random(seed)
    make = lambda n: [(rng.choice("ab"), rng.randrange(4), rng.choice(["x", "y", None]), rng.randrange(3)) for _ in range(n)]
    left = make(120)
    right = [r for r in left if rng.random() < 0.95] + make(4)
    schema = "part string, month int, text string, n int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    got = candidate.digest_difference(frame(left), frame(right), ("text", "n"), ("part", "month"), buckets=3).collect()
    missing, extra = Counter(left) - Counter(right), Counter(right) - Counter(left)
    want = {}
    for side, counter in enumerate((missing, extra)):
        for row, n in counter.items():
            want.setdefault(row[:2], [0, 0])[side] += n
    assert {(r.part, r.month): [r.missing, r.extra] for r in got} == want
    assert candidate.digest_difference(frame(left), frame(left[::-1]), ("text", "n"), ("part", "month")).count() == 0


def test_a_clean_import_has_only_coverage_findings(spark, tmp_path):
    path = str(tmp_path / "facts")
    own = sources(spark)
    ci.import_batch(own, path)
    facts, kept = ci.read_import(spark, path), ci.records(own).where("verdict = 'KEPT'")
    window = candidate.Window(date(2024, 1, 2), date(2024, 1, 2), date(2024, 1, 4))
    found = {r.finding: r.issue_count for r in candidate.validate_candidate(facts, facts, kept, window).collect()}
    # A trades on the 2nd and 4th, B on the 2nd; prices and suspensions lack two of these days each
    assert {k: v for k, v in found.items() if v} == {
        "daily_price_unadjusted_missing_keys": 2,
        "daily_price_unadjusted_unexpected_keys": 1,
        "daily_price_limits_missing_keys": 1,
        "daily_price_limits_unexpected_keys": 2,
        "daily_st_status_missing_keys": 2,
        "daily_st_status_unexpected_keys": 1,
        "daily_suspension_status_missing_keys": 2,
        "daily_suspension_status_unexpected_keys": 1,
    }


def test_an_import_without_kept_rows(spark, tmp_path):
    none = {k: getattr(sources(spark), k).where("false") for k in ("calendar", "master", "market", "risk_status", "suspension")}
    result = ci.import_batch(ci.ImportSources(**none), str(tmp_path / "facts"))
    assert result.fit and ci.read_import(spark, result.path).count() == 0


def test_suspension_files_hold_a_month_of_many_securities(spark):
    """Files grow with slices of securities and months, not with each day of them."""
    from workload.domain import Domain
    from workload.imports import _import_sources

    given = Domain(spark, "/root/testdata/sf0.001")
    assert given.securities.where("user_id >= 500").isEmpty() and given.calendar.select("calendar_date").distinct().count() > 20
    assert len(_import_sources(given).suspension.inputFiles()) == 1
