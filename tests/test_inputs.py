"""Inputs that must become findings instead of dropped or guessed rows."""

import datetime as dt
import json

from earlybell.functions import scalars as S
from earlybell.operators import assess, foundation, quality
from earlybell.sources import readers
from tests.builders import D, Market, rows, sessions
from workload.catalog import QUERIES
from workload.domain import CODE_DIGITS, Domain

DAYS = sessions(D(2024, 1, 1), 6)


def test_unknown_st_literal_stops_the_run(spark):
    market = Market(DAYS).add("600000", "LLLLLL", before="未生效")
    assert rows(market.run(spark).findings(), "code") == []
    market.st = [(*r[:3], "maybe", *r[4:]) if r[4] == DAYS[1] else r for r in market.st]
    found = market.run(spark).findings()
    assert {c for (c,) in rows(found, "code")} == {"RISK_GATE_ST_LITERAL_UNKNOWN"}
    assert (DAYS[1],) in {(r.fact_date,) for r in found.collect()}


def test_seven_digit_code_is_invalid_unless_the_rules_say_so(spark):
    market = Market(DAYS).add("6000000", "nnnnnn", before="未生效")
    assert "RISK_GATE_SECURITY_CODE_INVALID" in {c for (c,) in rows(market.run(spark).findings(), "code")}
    assert rows(market.run(spark, code_digits=r"\d{7}").findings(), "code") == []
    df = spark.createDataFrame([("600000.SH",), ("6000000.SH",)], "c string")
    assert [r[0] for r in df.select(S.canonical_security("c")).collect()] == ["600000.XSHG", None]


def test_json_shapes_may_be_mixed(spark, tmp_path):
    docs = [{"data": [{"x": 1, "y": "a"}, {"x": 2, "y": None}]}, [{"x": 3, "y": "c"}], {"x": 4}]
    paths = []
    for k, doc in enumerate(docs):
        paths.append(str(tmp_path / f"{k}.json"))
        (tmp_path / f"{k}.json").write_text(json.dumps(doc))
    for fields in (None, ("x", "y")):
        got = readers.read_json_records(spark, *paths, fields=fields)
        assert {(r.x, r.y) for r in got.collect()} == {("1", "a"), ("2", None), ("3", "c"), ("4", None)}


def test_csv_files_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n4,3\n")
    got = readers.read_text_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    assert rows(got, "x", "y") == [("1", "2"), ("3", "4")]


def test_file_without_header_is_a_finding(spark, tmp_path):
    (tmp_path / "a.csv").write_text("note\nbiz_date,stk_code\n2024-01-02,600000.SH\n")
    (tmp_path / "b.csv").write_text("note\n2024-01-02,600000.SH\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert readers.read_preamble_csv(spark, *paths).count() == 1
    found = readers.preamble_findings(spark, *paths).collect()
    assert [(r.code, r.file_path.rsplit("/", 1)[-1], r.lines) for r in found] == [("HEADER_MISSING", "b.csv", 2)]


def test_quotes_and_long_lines_of_preamble_files(spark, tmp_path):
    long = "x" * 1_000_000
    (tmp_path / "a.csv").write_text(
        'note "open\nbiz_date, note ,stk_code\n'
        '2024-01-02,"a, ""b"", c",600000.SH\n'
        '2024-01-03,"cut\nhere",600001.SH\n'
        f"2024-01-04,{long},600002.SH\n"
        f'2024-01-05,"{"q," * 300_000}",600003.SH\n'
        "2024-01-06,'s','600004.SH'\n2024-01-07\n",
        encoding="utf-8",
    )
    got = readers.read_preamble_csv(spark, str(tmp_path / "a.csv"), columns=("biz_date", "stk_code", "note")).collect()
    assert [(str(r.biz_date), r.stk_code) for r in sorted(got, key=lambda r: r.biz_date)] == [
        ("2024-01-02", "600000.SH"), ("2024-01-04", "600002.SH"), ("2024-01-05", "600003.SH"), ("2024-01-06", "600004.SH"), ("2024-01-07", None),
    ]
    notes = {str(r.biz_date): r.note for r in got}
    assert notes["2024-01-02"] == 'a, "b", c' and notes["2024-01-04"] == long and notes["2024-01-06"] == "s"
    found = readers.preamble_findings(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.code, r.lines) for r in found] == [("OPEN_QUOTE", 2)]


def test_two_grades_of_one_day_conflict(spark):
    day = D(2024, 1, 2)
    data = [(day, "600000.SH", "A"), (day, "600000.SH", "F"), (day, "600001.SH", "A"), (day, "600001.SH", "A"), (day, "60000X.SH", "A")]
    wide = spark.createDataFrame(data, "biz_date date, stk_code string, B1 string")
    cells = assess.wide_to_cells(wide, ["B1"])
    assert rows(assess.version_conflicts(cells), "security_code", "affected_rows") == [("600000.XSHG", 2)]
    assert rows(assess.uncanonical_codes(wide), "stk_code", "affected_rows") == [("60000X.SH", 1)]


def test_missing_key_part_makes_no_shorter_key(spark):
    data = [("XSHG", None, dt.date(2025, 1, 2)), ("XSHG", " ", dt.date(2025, 1, 2)), ("XSHG", "600000.XSHG", dt.date(2025, 1, 2))]
    facts = spark.createDataFrame(data, "market_code string, security_code string, business_date date")
    keys = [r[0] for r in facts.select(S.business_key("daily_st_status")).collect()]
    assert keys == [None, None, "XSHG|600000.XSHG|2025-01-02"]
    found = foundation.missing_key_parts(facts, "daily_st_status")
    assert rows(found, "field", "affected_rows") == [("security_code", 2)]


def test_users_from_a_million_on_keep_their_history(spark, tmp_path):
    schema = "event_id bigint, user_id bigint, event_type string, ts timestamp, value double"
    moment = dt.datetime(2024, 1, 10, 12)
    data = [(k, user, "click", moment, 1.0 + k) for k, user in enumerate((999_999, 999_999, 1_000_000, 1_000_000, 12_345_678))]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "events.parquet"))
    domain = Domain(spark, str(tmp_path))
    codes = {"999999.XSHG", "1000000.XSHE", "12345678.XSHG"}
    assert {r.security_code for r in domain.cells.collect()} == codes
    assert {r.code for r in quality.wide_quality(domain.wide, ("B01",), minimum_filled=1, digits=CODE_DIGITS).collect()} <= {"E922"}
    wide = domain.wide.select("stk_code", S.security_market("stk_code", CODE_DIGITS).alias("m"))
    assert wide.where("m IS NULL").count() == 0 and wide.count() == 3
    conflicts = QUERIES["w12_version_conflicts"].build(domain)
    assert {r.security_code for r in conflicts.collect()} == {"999999.XSHG", "1000000.XSHE"}


def test_history_manifest_decides_before_rows_are_read(spark, tmp_path):
    good = "﻿biz_date,stk_code,B1\n2024-01-02,600000.SH,A\n2024-01-02,600000.SH,B\n"
    (tmp_path / "h2024Q1.csv").write_text(good, encoding="utf-8")
    (tmp_path / "h2023Q3.csv").write_text("biz_date,B1,stk_code\nnot,read,2024\n")
    (tmp_path / "h2023Q4.csv").mkdir()
    (tmp_path / "h2023Q4.csv" / "part-0.csv").write_text("biz_date,stk_code,B1\n2023-12-30,600000.SH,A\n")
    (tmp_path / "h2023Q4.csv" / "part-1.csv").write_text("biz_date,stk_code,B1\n2023-12-29,600000.SH,\n")
    days = spark.createDataFrame([("XSHG", D(2023, 12, 29)), ("XSHG", D(2024, 1, 2))], "market_code string, trading_date date")

    def found(expected):
        df = quality.history_files_integrity(spark, str(tmp_path), ("B1",), days, D(2024, 1, 2), expected)
        return {(r.file_name, r.code[:5], r.affected_rows) for r in df.collect()}

    rows_found = {("h2024Q1.csv", "BM103", 1), ("h2023Q4.csv", "BM106", 1), ("h2023Q3.csv", "BM102", 1)}
    assert found(None) == rows_found
    assert found(["h2024Q1.csv", "h2023Q4.csv", "h2024Q2.csv"]) == rows_found | {("h2024Q2.csv", "BM101", 1), ("h2023Q3.csv", "BM101", 1)}
    (tmp_path / "h2022Q1.csv").write_text("biz_date,stk_code,B1\n")
    assert ("h2023Q3.csv", "BM101", 1) in found(None)


def test_places_of_preamble_lines_hold_however_files_are_dealt_out(spark, tmp_path):
    """The second scan of a file may be dealt out otherwise than the first, as when executors come in between."""
    for k in range(12):
        lines = [f"2024-01-{1 + i % 28:02d},{i:06d}.SH" for i in range(20 + 30 * (k % 4))]
        (tmp_path / f"{k:02d}.csv").write_text("\n".join(["note", "2023-01-01,trap", "biz_date,stk_code", *lines]) + "\n")
    total = sum(20 + 30 * (k % 4) for k in range(12))
    setting = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(setting)
    try:
        for first, second in (("1", "4m"), ("4m", "1")):
            spark.conf.set(setting, first)
            df = readers.read_preamble_csv(spark, str(tmp_path))
            spark.conf.set(setting, second)
            assert df.count() == total and df.where("stk_code = 'trap'").count() == 0
    finally:
        spark.conf.set(setting, old)


def test_ranked_lines_are_written_in_their_order(spark, tmp_path):
    from workload.q_sources import _write_ranked

    data = [(f"2024-01-0{d}", p, f"line {r}", r) for d in (1, 2, 3) for p in (0, 1) for r in (9, 5, 7, 2, 1)]
    lines = spark.createDataFrame(data, "biz_date string, part int, line string, rank int")
    _write_ranked(lines.withColumn("biz_date", lines.biz_date.cast("date")).coalesce(1), str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("day=*/part=*/*.txt"))
    assert len(files) == 6 and {f.read_text() for f in files} == {"".join(f"line {r}\n" for r in (1, 2, 5, 7, 9))}
