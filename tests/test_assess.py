import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import assess, calendar, compare, grades, metrics, panel, ranking
from tests.builders import D, KEY_SCHEMA, rows, sessions

DAYS = sessions(D(2024, 1, 1), 10)
KEY = ("XSHG", "600001.XSHG")
MAPPING = R.BrokerMapping.from_dangerous("m", {"B1": "FG"})


def cells(spark, records):
    """records: {session index: raw value}"""
    data = [(*KEY, DAYS[i], [raw]) for i, raw in records.items()]
    return spark.createDataFrame(data, KEY_SCHEMA + ", classification_date date, grades array<string>")


def st_frame(spark, marks, key=KEY):
    """marks per session: '1' ST, '0' not, '?' no row"""
    data = [(*key, d, m == "1") for d, m in zip(DAYS, marks) if m != "?"]
    return spark.createDataFrame(data, KEY_SCHEMA + ", trading_date date, is_st boolean")


def day_frame(spark):
    return spark.createDataFrame([("XSHG", d) for d in DAYS], "market_code string, trading_date date")


def event_frame(spark, *facts):
    data = [(*KEY, t, DAYS[i], DAYS[i]) for t, i in facts]
    return spark.createDataFrame(data, KEY_SCHEMA + ", event_type string, first_fact_date date, risk_date date")


def verdict(spark, records, marks, fact, **kw):
    days = day_frame(spark)
    out = assess.assess_events(
        event_frame(spark, (R.LIMIT_DOWN_EVENT, fact)), cells(spark, records), st_frame(spark, marks), days,
        calendar.calendar_index(days), ["B1"], MAPPING, **kw,
    )
    r = out.first()
    return r.identification_status, r.warning_days_status, r.warning_trading_days, r.reason_code, r.selected_classification_date


def test_record_of_the_event_day_is_not_used(spark):
    assert verdict(spark, {2: "A", 5: "F"}, "0" * 10, 5)[0] == "NOT_IDENTIFIED"
    assert verdict(spark, {2: "A", 4: "F"}, "0" * 10, 5)[:4] == ("IDENTIFIED", "DEFINED", 1, "BM300_IDENTIFIED")


def test_blank_and_unmapped_restart_the_run(spark):
    assert verdict(spark, {1: "F", 3: "", 4: "G"}, "0" * 10, 6)[2] == 2
    assert verdict(spark, {1: "F", 3: "X", 4: "G"}, "0" * 10, 6)[2] == 2
    # repeated danger does not restart it
    assert verdict(spark, {1: "F", 3: "G", 4: "F"}, "0" * 10, 6)[2] == 5


def test_st_alone_is_a_hit_without_warning_days(spark):
    assert verdict(spark, {1: "A"}, "0001110000", 5) == (
        "IDENTIFIED", "UNKNOWN", None, "BM305_NO_BROKER_START_FOR_ST_OVERRIDE", DAYS[1],
    )
    # an own dangerous record during the ST run anchors it
    assert verdict(spark, {1: "A", 4: "F"}, "0001110000", 6)[1:3] == ("DEFINED", 2)


def test_left_censored_run(spark):
    assert verdict(spark, {0: "F"}, "0" * 10, 5)[1:4] == ("UNKNOWN", None, "BM303_DANGEROUS_RUN_LEFT_CENSORED")
    # unknown ST on the first day means the run cannot have started there
    assert verdict(spark, {0: "F"}, "?000000000", 5)[3] == "BM305_NO_BROKER_START_FOR_ST_OVERRIDE"


def test_unknown_reasons(spark):
    assert verdict(spark, {1: "F"}, "0000?00000", 5)[3] == "BM203_ST_STATUS_MISSING"
    assert verdict(spark, {1: "X"}, "0" * 10, 5)[3] == "BM301_MAPPING_UNKNOWN"
    assert verdict(spark, {7: "F"}, "0" * 10, 5)[3] == "BM302_NO_USABLE_CLASSIFICATION"
    assert verdict(spark, {1: "F"}, "0" * 10, 0)[3] == "BM201_CALENDAR_COVERAGE_MISSING"
    gone = spark.createDataFrame([KEY], KEY_SCHEMA)
    assert verdict(spark, {1: "F"}, "0" * 10, 5, missing_history=gone)[3] == "BM109_SECURITY_HISTORY_MISSING"


def test_prefilter_changes_nothing(spark):
    assert verdict(spark, {1: "F"}, "0" * 10, 5, prefilter=True) == verdict(spark, {1: "F"}, "0" * 10, 5)


def state_walk(records, marks):
    """Independent day walk: (bucket, start index or None) per session."""
    out, raw, start, run = [], None, None, False
    for i in range(len(DAYS)):
        fresh = i in records
        raw = records.get(i, raw)
        st = {"1": True, "0": False, "?": None}[marks[i]]
        danger = raw in ("F", "G")
        if st is None:
            bucket = "UNKNOWN"
        elif st:
            bucket = "DANGEROUS"
        elif raw is None:
            bucket = None
        elif raw == "":
            bucket = "NON_DANGEROUS"
        elif raw == "X":
            bucket = "UNKNOWN"
        else:
            bucket = "DANGEROUS" if danger else "NON_DANGEROUS"
        if bucket != "DANGEROUS":
            run, start = False, None
        else:
            if not run:
                run, start = True, None
            if start is None and danger and fresh:
                start = i
        out.append((bucket, start))
    return out


def test_random_histories_match_a_day_walk(spark):
    rng = random.Random(11)
    hist, st, want = [], [], []
    for n in range(150):
        key = ("XSHG", f"{600100 + n}.XSHG")
        records = {i: rng.choice(["A", "F", "G", "", "X"]) for i in range(10) if rng.random() < 0.45}
        marks = "".join(rng.choice("00001?") for _ in DAYS)
        hist += [(*key, DAYS[i], [raw]) for i, raw in records.items()]
        st += [(*key, d, m == "1") for d, m in zip(DAYS, marks) if m != "?"]
        want += [(key[1], DAYS[i], b or "", DAYS[s] if s is not None else D(1900, 1, 1)) for i, (b, s) in enumerate(state_walk(records, marks))]
    days = day_frame(spark)
    life = spark.createDataFrame(
        [("XSHG", f"{600100 + n}.XSHG", None, None) for n in range(150)], KEY_SCHEMA + ", listed_date date, delisted_date date"
    )
    states = assess.broker_states(
        assess.state_grid(life, days),
        spark.createDataFrame(hist, KEY_SCHEMA + ", classification_date date, grades array<string>"),
        spark.createDataFrame(st, KEY_SCHEMA + ", trading_date date, is_st boolean"),
        ["B1"],
        MAPPING,
    )
    got = assess.dangerous_runs(states).select(
        "security_code", "trading_date", F.coalesce("final_bucket", F.lit("")).alias("b"),
        F.coalesce("dangerous_run_start_date", F.lit(D(1900, 1, 1))).alias("s"),
    )
    assert rows(got, "security_code", "trading_date", "b", "s") == sorted(want)


def hand_assessments(spark, data):
    schema = (
        "event_key string, broker_id string, " + KEY_SCHEMA + ", event_type string, first_fact_date date, risk_date date, is_hit boolean, "
        "identification_status string, warning_days_status string, warning_trading_days int, raw_classification string, selected_classification_date date, final_bucket string"
    )
    return spark.createDataFrame(data, schema)


def item(key, code, kind, hit, days=None, broker="B1", raw="F"):
    status = {True: "IDENTIFIED", False: "NOT_IDENTIFIED", None: "UNKNOWN"}[hit]
    wstatus = "DEFINED" if days is not None else "UNKNOWN" if hit is not False else "NOT_APPLICABLE"
    return (key, broker, "XSHG", code, kind, DAYS[5], DAYS[5], hit, status, wstatus, days, raw, DAYS[1], "UNKNOWN" if hit is None else "X")


def test_hit_rates_count_events_and_securities(spark):
    a = hand_assessments(spark, [
        item("1", "600001", R.NEW_ST_EVENT, True, 3), item("2", "600001", R.NEW_ST_EVENT, False),
        item("3", "600002", R.LIMIT_DOWN_EVENT, None),
    ])
    got = {(r.broker_id, r.event_type_view): r for r in metrics.hit_rates(a, ["B1", "B2"]).collect()}
    assert len(got) == 6
    st = got["B1", R.NEW_ST_EVENT]
    assert (st.risk_event_count, float(st.event_hit_rate), st.risk_security_count, float(st.security_hit_rate)) == (2, 0.5, 1, 1.0)
    both = got["B1", R.ALL_EVENTS]
    # an unknown verdict stays in the denominator
    assert (both.risk_event_count, both.unknown_security_count, float(both.event_hit_rate)) == (3, 1, 0.333333)
    empty = got["B2", R.ALL_EVENTS]
    assert (empty.risk_event_count, empty.event_hit_rate, empty.result_status) == (0, None, "NOT_APPLICABLE")


def test_warning_days_median_and_half_up_mean(spark):
    a = hand_assessments(spark, [item(str(i), f"60000{i}", R.NEW_ST_EVENT, True, d) for i, d in enumerate((1, 2, 2, 8))])
    r = {r.event_type_view: r for r in metrics.warning_days_distribution(a, ["B1"]).collect()}[R.NEW_ST_EVENT]
    assert (r.warning_days_min, r.warning_days_max, float(r.warning_days_median), float(r.warning_days_mean)) == (1, 8, 2.0, 3.25)


def test_warning_rate_needs_a_strictly_later_event(spark):
    states = spark.createDataFrame(
        [(*KEY, "B1", DAYS[4], "DANGEROUS"), (*KEY, "B1", DAYS[5], "DANGEROUS"), ("XSHG", "600002.XSHG", "B1", DAYS[5], "UNKNOWN")],
        KEY_SCHEMA + ", broker_id string, snapshot_date date, final_bucket string",
    )
    days = day_frame(spark).where(F.col("trading_date").isin(DAYS[4], DAYS[5], DAYS[6]))
    snap = metrics.warning_rates_snapshot(states, event_frame(spark, (R.NEW_ST_EVENT, 5)), ["B1"], days)
    got = rows(snap.where(F.col("event_type_view") == R.ALL_EVENTS), "snapshot_trading_date", "dangerous_risk_security_count", "dangerous_security_count", "unknown_classification_security_count")
    assert got == [(DAYS[4], 1, 1, 0), (DAYS[5], 0, 1, 1), (DAYS[6], 0, 0, 0)]
    period = metrics.warning_rates_period(states, event_frame(spark, (R.NEW_ST_EVENT, 5)), ["B1"])
    assert rows(period, "event_type_view", "dangerous_risk_security_count", "dangerous_security_count") == [
        (R.ALL_EVENTS, 1, 1), (R.NEW_ST_EVENT, 1, 1), (R.LIMIT_DOWN_EVENT, 0, 1),
    ]


def test_competition_rank_ties_and_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 0.5), ('b', 0.5), ('c', 0.2), ('d', NULL) AS t(broker_id, m)").withColumn("event_type_view", F.lit("v"))
    assert sorted((r.broker_id, r.k) for r in ranking.competition_rank(df, "m", "k").collect()) == [("a", 1), ("b", 1), ("c", 3), ("d", None)]


def test_composite_needs_the_full_sample(spark):
    def sample(n):
        return spark.range(n).select(
            F.col("id").cast("string").alias("broker_id"), F.lit("v").alias("event_type_view"),
            *[(F.col("id") / 100).alias(m) for m in R.RANKING_METRICS],
        )

    full = {r.broker_id: r for r in ranking.broker_rankings(sample(21)).collect()}
    assert (full["20"].composite_score, full["20"].composite_rank, full["0"].composite_score) == (100.0, 1, 0.0)
    part = ranking.broker_rankings(sample(20)).collect()
    assert {(r.composite_score, r.sample_status) for r in part} == {(None, "INCOMPLETE_SAMPLE")}


@pytest.mark.parametrize("span", [1, 2, 5, 64])
def test_drawdown_and_compounding(spark, span):
    rng = random.Random(span)
    returns = {"flat": [], "one": [-0.5], "up": [0.1, 0.2], "lost": [0.5, -1.0, 0.3], "mixed": [0.1, -0.5, 0.2]}
    returns |= {f"k{n}": [rng.choice([None, 0.0, rng.uniform(-0.6, 0.8)]) for _ in range(n)] for n in (3, 17, 40)}
    rows = [(k, date(2023, 12, 20) + timedelta(days=3 * i), r) for k, rs in returns.items() for i, r in enumerate(rs)]
    got = grades.ordered_growth(spark.createDataFrame(rows, "k string, day date, r double"), ["k"], "day", "r", span).collect()
    want = {}
    for k, rs in returns.items():
        nav = peak = 1.0
        worst = 0.0
        for r in (r for r in rs if r is not None):
            nav *= 1 + r
            peak = max(peak, nav)
            worst = min(worst, nav / peak - 1)
        if any(r is not None for r in rs):
            want[k] = (pytest.approx(nav, abs=1e-12), pytest.approx(worst, abs=1e-12))
    assert {r.k: (r.growth, r.worst_fall) for r in got} == want


def test_model_pairs_and_tags(spark):
    new = hand_assessments(spark, [item("1", "1", "t", True, 4, raw="G"), item("2", "2", "t", False, raw="A"), item("3", "3", "t", True, 2)])
    old = hand_assessments(spark, [item("1", "1", "t", False, raw="A"), item("2", "2", "t", True, 1), item("3", "3", "t", True, 2)])
    pairs = compare.paired_assessments(new, old)
    t = compare.model_comparison_totals(pairs).first()
    assert (t.gained_hit_count, t.lost_hit_count, t.warning_changed_count) == (1, 1, 2)
    tagged = compare.tagged_differences(compare.event_differences(pairs))
    assert rows(tagged, "event_key", "classification_transition") == [("1", "A>G"), ("2", "F>A")]
    assert compare.filter_differences(tagged, change_type="lost_hit").count() == 1
    assert compare.unpaired_keys(new, old).count() == 0
    assert compare.unpaired_keys(new, old.where("event_key <> '2'")).first().side == "ONLY_LEFT"


def test_returns_use_the_grade_of_the_session_before(spark):
    days = day_frame(spark)
    life = spark.createDataFrame([(*KEY, D(2020, 1, 1), None)], KEY_SCHEMA + ", listed_date date, delisted_date date")
    ret = spark.createDataFrame([(*KEY, d, 0.01) for d in DAYS], KEY_SCHEMA + ", trading_date date, r double").select(
        "market_code", "security_code", "trading_date", F.col("r").cast("decimal(28,18)").alias("simple_return")
    )
    daily = grades.grade_returns_daily(life, days, (DAYS[1], DAYS[6]), cells(spark, {0: "A", 3: "F", 5: ""}), ret, ["B1"])
    # F of session 3 first applies to session 4; the blank of session 5 leaves session 6 unclassified
    assert rows(daily, "return_date", "raw_classification") == [
        (DAYS[1], "A"), (DAYS[2], "A"), (DAYS[3], "A"), (DAYS[4], "F"), (DAYS[5], "F"),
    ]


def test_panel_sorts_by_code_first(spark):
    # a sort compares a prefix of its first column, and a market's rows all share theirs
    stacked = panel.stack_by_day({"st": st_frame(spark, "0" * 10)})
    filled = stacked.withColumn("is_st", panel.carry(F.col("st.is_st")))
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "Sort [security_code" in plan
    assert "Sort [market_code" not in plan


def test_grid_ends_at_the_last_cutoff(spark, monkeypatch):
    seen = []
    whole = assess.broker_states
    monkeypatch.setattr(assess, "broker_states", lambda *a, **kw: seen.append(a[0]) or whole(*a, **kw))
    assert verdict(spark, {1: "F", 8: "A"}, "0" * 10, 5)[2] == 4
    assert [r[0] for r in rows(seen[0], "trading_date")] == DAYS[:5]


def test_events_of_a_security_meet_their_own_cutoffs(spark):
    # one without a previous session, two on one day, one later
    days = day_frame(spark)
    facts = [(R.LIMIT_DOWN_EVENT, 0), (R.LIMIT_DOWN_EVENT, 4), (R.NEW_ST_EVENT, 4), (R.LIMIT_DOWN_EVENT, 7)]
    out = assess.assess_events(
        event_frame(spark, *facts), cells(spark, {1: "F", 5: "A"}), st_frame(spark, "0" * 10), days,
        calendar.calendar_index(days), ["B1"], MAPPING,
    )
    got = {(r.event_type, r.first_fact_date): (r.identification_status, r.warning_trading_days) for r in out.collect()}
    assert got == {
        (R.LIMIT_DOWN_EVENT, DAYS[0]): ("UNKNOWN", None),
        (R.LIMIT_DOWN_EVENT, DAYS[4]): ("IDENTIFIED", 3),
        (R.NEW_ST_EVENT, DAYS[4]): ("IDENTIFIED", 3),
        (R.LIMIT_DOWN_EVENT, DAYS[7]): ("NOT_IDENTIFIED", None),
    }
