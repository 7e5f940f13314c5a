
import random

import pytest

from earlybell import rules as R
from earlybell.functions import scalars as S
from earlybell.operators import events as E
from tests.builders import D, Market, rows, sessions

DAYS = sessions(D(2024, 1, 1), 10)


def test_threshold_depends_on_board(spark):
    m = Market(DAYS).add("600001", "LLLnnnnnnn", before="否").add("300001", "LLLnnnnnnn", market="XSHE", board="GEM", before="否")
    got = rows(m.run(spark).events(), "security_code", "first_fact_date", "risk_date", "consecutive_length")
    assert got == [
        ("300001.XSHE", DAYS[0], DAYS[1], 3),
        ("600001.XSHG", DAYS[0], DAYS[2], 3),
    ]


def test_short_runs_are_segments_or_nothing(spark):
    m = Market(DAYS).add("600001", "LnLLnnLLLn", before="否")
    run = m.run(spark)
    segs = rows(run.segments(), "segment_number", "consecutive_length", "threshold_reached", "first_fact_date")
    # the single day takes no number; the pair is a segment without event
    assert segs == [(1, 2, False, DAYS[2]), (2, 3, True, DAYS[6])]
    assert rows(run.events(), "segment_number", "first_fact_date") == [(2, DAYS[6])]


def test_suspension_and_st_break_runs(spark):
    m = Market(DAYS).add("600001", "LLsLLnnnnn", before="否").add("600002", "LLTLLLnnnn", before="否")
    run = m.run(spark)
    assert rows(run.segments(), "security_code", "consecutive_length") == [
        ("600001.XSHG", 2), ("600001.XSHG", 2), ("600002.XSHG", 2), ("600002.XSHG", 3),
    ]
    assert rows(run.events(), "security_code", "event_type", "first_fact_date") == [
        ("600002.XSHG", "NEW_ST", DAYS[2]), ("600002.XSHG", "NON_ST_CONTINUOUS_LIMIT_DOWN", DAYS[3]),
    ]


def test_limit_down_on_an_st_day_does_not_count(spark):
    m = Market(DAYS).add("600001", "LLUUUnnnnn", before="否")
    assert rows(m.run(spark).segments(), "consecutive_length", "last_fact_date") == [(2, DAYS[1])]


def test_open_flag_only_at_the_last_scanned_day(spark):
    m = Market(DAYS).add("600001", "nnnnnnnnLL", before="否").add("600002", "nnnnnnnLLn", before="否")
    got = rows(m.run(spark).segments(), "security_code", "open_at_observation_end")
    assert got == [("600001.XSHG", True), ("600002.XSHG", False)]


def test_st_baseline_before_the_window(spark):
    m = Market(DAYS).add("600001", "TTnnTnnnnn", before="是").add("600002", "Tnnnnnnnnn", before="否")
    got = rows(m.run(spark).events(), "security_code", "first_fact_date")
    assert got == [("600001.XSHG", DAYS[4]), ("600002.XSHG", DAYS[0])]


def test_listing_inside_the_window_uses_its_own_first_day(spark):
    m = Market(DAYS).add("600001", "TTnTnnnn", listed=DAYS[2], days=DAYS[2:])
    run = m.run(spark)
    assert rows(run.events(), "first_fact_date") == [(DAYS[5],)]
    base = rows(E.st_baselines(run.panel, run.rules), "baseline_date", "is_st", "reason")
    assert base == [(DAYS[2], True, "FIRST_IN_LIFECYCLE_TRADING_DAY")]


def test_delisting_day_is_not_scanned(spark):
    m = Market(DAYS).add("600001", "nnnnnnnLLL", delisted=DAYS[9], before="否")
    got = rows(m.run(spark).segments(), "consecutive_length", "open_at_observation_end")
    assert got == [(2, True)]


def test_board_is_fixed_at_the_first_day(spark):
    m = Market(DAYS).add("600001", "nLLnnnnnnn", board="MAIN", boards=[(DAYS[2], "创业板")], before="否")
    m.add("600002", "nnnLLnnnnn", board="MAIN", boards=[(DAYS[2], "创业板")], before="否")
    got = rows(m.run(spark).segments(), "security_code", "board_code", "threshold_reached")
    assert got == [("600001.XSHG", "MAIN", False), ("600002.XSHG", "CHINEXT", True)]


def test_excluded_market_and_board(spark):
    m = Market(DAYS).add("600001", "nnnnnnnnnn", before="否")
    m.add("830001", "LLLLnnnnnn", market="XBSE", before="否").add("600003", "LLLLnnnnnn", board="北交所", before="否")
    run = m.run(spark)
    assert rows(run.split, "security_code", "eligibility") == [
        ("600001.XSHG", "ELIGIBLE"), ("600003.XSHG", "EXCLUDED"), ("830001.XBSE", "EXCLUDED"),
    ]
    assert run.events().count() == 0


def test_prices_are_equal_half_even(spark):
    df = spark.sql("SELECT CAST('10.0000005' AS decimal(20,7)) a, CAST('10.000000' AS decimal(20,6)) b, CAST('10.0000015' AS decimal(20,7)) c, CAST('10.000002' AS decimal(20,6)) d, CAST(NULL AS decimal(20,6)) e")
    r = df.select(S.prices_equal("a", "b").alias("x"), S.prices_equal("c", "d").alias("y"), S.prices_equal("a", "e").alias("z")).first()
    assert (r.x, r.y, r.z) == (True, True, False)


def test_pressure_upgrades_in_the_same_run(spark):
    m = Market(DAYS).add("600001", "LLnLLLnnnn", before="否").add("688001", "Lnnnnnnnnn", board="KSH", before="否")
    got = rows(
        m.run(spark).pressure_observations(),
        "security_code", "first_fact_date", "observation_date", "upgraded_to_formal_risk", "consecutive_length",
    )
    assert got == [
        ("600001.XSHG", DAYS[0], DAYS[1], False, 2),
        ("600001.XSHG", DAYS[3], DAYS[4], True, 3),
        ("688001.XSHG", DAYS[0], DAYS[0], False, 1),
    ]


def test_pressure_thresholds_must_not_exceed_formal_ones():
    with pytest.raises(ValueError):
        R.PressureRules(thresholds={"MAIN": 4, "CHINEXT": 1, "STAR": 1}).check_against(R.RiskRules(D(2024, 1, 1), D(2024, 1, 2)))


def test_latest_version_is_numeric_and_survives_many_versions(spark):
    from earlybell.operators.panel import latest_version

    df = spark.sql("SELECT 'a' k, id v, id * 2 x FROM range(5000) UNION ALL SELECT 'b', 9, 1 UNION ALL SELECT 'b', 10, 2")
    assert rows(latest_version(df, ["k"], "v"), "k", "v", "x") == [("a", 4999, 9998), ("b", 10, 2)]


def test_gate_reports_every_kind_of_gap(spark):
    m = Market(DAYS).add("600001", "nnnnnnnnn", before="否")  # last session missing
    m.add("600002", "nnnnnnnnnn")  # no baseline
    m.add("600003", "LLnnnnnnnn", before="否")
    m.master = [r for r in m.master if not r[1].startswith("600003")] + [("XSHG", "600003.XSHG", DAYS[4], "MAIN", D(2020, 1, 1), None)]
    m.universe.append(("XSHG", "600009.XSHG", DAYS[0]))
    run = m.run(spark)
    got = rows(run.findings(), "code", "security_code", "fact_date")
    assert sorted(got, key=repr) == sorted(
        [
            ("RISK_GATE_UNIVERSE_MARKET_COVERAGE_MISSING", "600001.XSHG", DAYS[9]),
            ("RISK_GATE_UNIVERSE_ST_COVERAGE_MISSING", "600001.XSHG", DAYS[9]),
            ("RISK_GATE_ST_BASELINE_MISSING", "600002.XSHG", None),
            ("RISK_GATE_BOARD_MISSING", "600003.XSHG", DAYS[0]),
            ("RISK_GATE_BOARD_MISSING", "600003.XSHG", DAYS[1]),
            ("RISK_GATE_UNIVERSE_MASTER_MISSING", "600009.XSHG", None),
        ],
        key=repr,
    )
    with pytest.raises(ValueError, match="gate"):
        run.write("/nonexistent")


def test_gate_stops_at_missing_fields(spark):
    run = Market(DAYS).add("600001", "nnnnnnnnnn", before="否").run(spark)
    tables = run.inputs.by_name()
    tables["market"] = tables["market"].drop("close_price")
    from earlybell.operators import gate

    found = rows(gate.gate_findings(tables, run.days, run.rules), "code", "market_code", "security_code")
    assert found == [("RISK_GATE_REQUIRED_FIELD_MISSING", "market", "close_price")]


def expected_runs(marks: str, threshold: int) -> tuple[list, list]:
    """Run-length view of a mark string: segments and ST entries by position."""
    segs, pos = [], 0
    while pos < len(marks):
        end = pos
        while end < len(marks) and marks[end] == "L":
            end += 1
        if end - pos >= 2:
            segs.append((pos, end - pos, end - pos >= threshold, end == len(marks)))
        pos = max(end, pos + 1)
    st = "n" + marks
    entries = [i for i in range(len(marks)) if st[i + 1] in "TU" and st[i] not in "TU"]
    return segs, entries


def test_random_panels_match_run_lengths(spark):
    rng = random.Random(7)
    days = sessions(D(2024, 1, 1), 25)
    m, want_segs, want_entries = Market(days), [], []
    for i in range(60):
        marks = "".join(rng.choice("LLLLnsTU") for _ in days)
        board, threshold = rng.choice([("MAIN", 3), ("GEM", 2)])
        m.add(f"{600000 + i}", marks, board=board, before="否")
        segs, entries = expected_runs(marks, threshold)
        code = f"{600000 + i}.XSHG"
        want_segs += [(code, days[p], n, hit, last) for p, n, hit, last in segs]
        want_entries += [(code, days[p]) for p in entries]
    run = m.run(spark)
    got = rows(run.segments(), "security_code", "first_fact_date", "consecutive_length", "threshold_reached", "open_at_observation_end")
    assert got == sorted(want_segs)
    st = run.events().where("event_type = 'NEW_ST'")
    assert rows(st, "security_code", "first_fact_date") == sorted(want_entries)


def test_written_batch_is_immutable(spark, tmp_path):
    run = Market(DAYS).add("600001", "LLLnnTnnnn", before="否").run(spark)
    manifest = rows(run.write(str(tmp_path)), "table_name", "row_count")
    assert manifest == [("continuous_limit_down_segments", 1), ("limit_down_pressure_observations", 1), ("risk_events", 2)]
    with pytest.raises(Exception, match="(?i)exist"):
        run.write(str(tmp_path))


def test_one_exchange_carries_the_panel(spark):
    """From the stacked sources to the events no further shuffle happens."""
    run = Market(DAYS).add("600001", "LLLnnTnnnn", before="否").run(spark)
    plan = run.events()._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Union")[0]
    assert above.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_candidate_on_the_termination_day(spark):
    """ST rows reach the termination day itself; the right-open lifecycle of the candidates doesn't."""
    from earlybell.operators import gate

    days = sessions(D(2024, 1, 2), 3)
    run = Market(days).add("600001", "nnL", delisted=days[2]).add("600002", "nLL", delisted=days[2]).run(spark)
    given = run.inputs
    life = given.security_status_daily.select("market_code", "security_code", "listed_date", "delisted_date")
    found = gate.candidate_days(given.stock_market_daily, given.security_risk_status, securities=life)
    assert rows(found, "security_code", "trading_date") == [("600002.XSHG", days[1])]
    assert gate.candidate_days(given.stock_market_daily, given.security_risk_status).count() == 3
