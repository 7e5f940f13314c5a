import pytest
from pyspark.sql import functions as F

from earlybell.operators import calendar, compare, foundation, panel, store
from earlybell.plans import foundation_run
from earlybell.sources import mapping, readers, sinks, staging
from tests.builders import D, KEY_SCHEMA, rows, sessions

FACT = "dataset_id string, business_key string, source_record_version int, supersedes_version int, payload_hash string, partition_id string"
DAYS = sessions(D(2024, 1, 1), 10)


def facts(spark, *data):
    return spark.createDataFrame([("d", k, v, s, h, "p") for k, v, s, h in data], FACT)


def test_append_is_idempotent(spark):
    stored = facts(spark, ("a", 1, None, "x"), ("a", 2, 1, "y"), ("b", 1, None, "z"))
    incoming = facts(spark, ("a", 0, None, "y"), ("b", 0, None, "q"), ("c", 0, None, "n"), ("c", 0, None, "n")).drop(
        "source_record_version", "supersedes_version"
    )
    written = store.append_versions(stored, incoming)
    assert rows(written.fillna(0, ["supersedes_version"]), "business_key", "source_record_version", "supersedes_version") == [("b", 2, 1), ("c", 1, 0)]
    s = store.append_summary(incoming, written).first()
    assert (s.input_rows, s.written_rows, s.idempotent_rows) == (4, 2, 2)
    # a revert to an older payload is a change against the latest version
    back = facts(spark, ("a", 0, None, "x")).drop("source_record_version", "supersedes_version")
    assert store.append_versions(stored, back).first().source_record_version == 3


def test_conflicting_batch_is_refused(spark, tmp_path):
    incoming = facts(spark, ("a", 0, None, "x"), ("a", 0, None, "y")).drop("source_record_version", "supersedes_version")
    assert rows(store.batch_conflicts(incoming), "business_key") == [("a",)]
    with pytest.raises(ValueError, match="two payloads"):
        foundation_run.append(str(tmp_path), facts(spark, ("a", 1, None, "x")), incoming)


def test_append_run_writes_partitions(spark, tmp_path):
    incoming = facts(spark, ("a", 0, None, "x"), ("b", 0, None, "y")).drop("source_record_version", "supersedes_version").withColumn(
        "market_code", F.lit("XSHG")
    ).withColumn("business_date", F.lit(D(2024, 2, 1)))
    foundation_run.append(f"{tmp_path}/f", facts(spark, ("a", 1, None, "x")), incoming)
    got = spark.read.parquet(f"{tmp_path}/f")
    assert rows(got, "business_key", "source_record_version", "year", "month") == [("b", 1, 2024, 2)]


def test_digest_ignores_order_and_sees_every_change(spark):
    a = facts(spark, ("a", 1, None, "x"), ("b", 1, None, "y"), ("c", 1, None, "z"))
    b = facts(spark, ("c", 1, None, "z"), ("a", 1, None, "x"), ("b", 1, None, "y")).repartition(3)
    c = facts(spark, ("a", 1, None, "x"), ("b", 2, None, "y"), ("c", 1, None, "z"))
    one = lambda df: store.member_digest(df).first().member_hash
    assert one(a) == one(b) != one(c)
    assert one(a) != one(a.unionByName(a))


def test_version_chain_across_ranges(spark):
    good = spark.range(1, 301).select(
        F.lit("d").alias("dataset_id"), F.lit("hot").alias("business_key"), F.col("id").cast("int").alias("source_record_version"),
        F.when(F.col("id") > 1, F.col("id") - 1).cast("int").alias("supersedes_version"),
    )
    assert store.version_chain_issues(good, bucket=16).count() == 0
    gap = good.where("source_record_version <> 150")
    got = rows(store.version_chain_issues(gap, bucket=16), "source_record_version", "expected_version")
    assert got == [(v, v - 1) for v in range(151, 301)]
    broken = good.withColumn("supersedes_version", F.when(F.col("source_record_version") == 7, 3).otherwise(F.col("supersedes_version")))
    assert rows(store.version_chain_issues(broken, bucket=16), "source_record_version") == [(7,)]


def test_shards_follow_code_order(spark):
    df = spark.range(1000).select(F.lit("XSHG").alias("market_code"), F.format_string("%06d.XSHG", F.col("id") * 7).alias("security_code"))
    got = rows(foundation.shard_summary(foundation.shard_universe(df, 300)), "shard_ordinal", "security_count", "first_code")
    assert got == [(1, 300, "000000.XSHG"), (2, 300, "002100.XSHG"), (3, 300, "004200.XSHG"), (4, 100, "006300.XSHG")]


def test_close_and_open(spark):
    schema = KEY_SCHEMA + ", board_code string, listing_date date, termination_date date"
    old = spark.createDataFrame(
        [("XSHG", c, "MAIN", D(2020, 1, 1), None, D(2023, 1, 1), None) for c in "abc"], schema + ", effective_start date, effective_end date"
    )
    new = spark.createDataFrame(
        [("XSHG", "a", "MAIN", D(2020, 1, 1), None), ("XSHG", "b", "GEM", D(2020, 1, 1), None), ("XSHG", "c", "MAIN", D(2020, 1, 1), D(2023, 12, 1))], schema
    )
    got = store.close_and_open(old, new, D(2024, 1, 1)).withColumn("e", F.coalesce("effective_end", F.lit(D(9999, 1, 1))))
    assert rows(got, "security_code", "action", "effective_start", "e") == [
        ("a", "CLOSED", D(2023, 1, 1), D(2023, 12, 31)), ("a", "OPENED", D(2024, 1, 1), D(9999, 1, 1)),
        ("b", "BOARD_CHANGED", D(2023, 1, 1), D(9999, 1, 1)), ("c", "TERMINATED", D(2023, 1, 1), D(2023, 11, 30)),
    ]


def test_price_merge_rebuilds_only_changed_securities(spark):
    cols = KEY_SCHEMA + ", trading_date date, close_price double"
    row = lambda c, i, p: ("XSHG", c, DAYS[i], p)
    prior = spark.createDataFrame([row(c, i, 1.0) for c in "abc" for i in (0, 1)], cols)
    fresh = spark.createDataFrame([row("a", 1, 1.0 + 1e-10), row("a", 2, 2.0), row("b", 1, 1.1), row("b", 2, 2.2)], cols)
    rebuilt = spark.createDataFrame([row(c, i, 9.0) for c in "abc" for i in range(3)], cols)
    got = store.merge_adjusted_prices(prior, fresh, rebuilt, DAYS[1])
    assert {(r.security_code, r.source): r["count"] for r in got.groupBy("security_code", "source").count().collect()} == {
        ("a", "APPENDED"): 3, ("b", "REBUILT"): 3, ("c", "REBUILT"): 3,
    }


def test_previous_close_variants(spark):
    cols = KEY_SCHEMA + ", trading_date date, close_price double"
    df = spark.createDataFrame([("XSHG", "a", DAYS[i], float(i)) for i in (1, 2, 4)], cols)
    index = calendar.calendar_index(spark.createDataFrame([("XSHG", d) for d in DAYS], "market_code string, trading_date date"))
    known = panel.previous_known_close(df).fillna(-1.0)
    strict = panel.previous_session_close(df, index).fillna(-1.0)
    assert [p for _, p in rows(known, "trading_date", "previous_close")] == [-1.0, 1.0, 2.0]
    assert [p for _, p in rows(strict, "trading_date", "previous_close")] == [-1.0, 1.0, -1.0]


def test_two_sided_diff_kinds(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "w"), (5, "q"), (5, "q")], "k int, v string")
    e = spark.createDataFrame([(1, "x"), (2, "n"), (3, "z"), (4, "m"), (6, None)], "k int, v string")
    got = rows(compare.two_sided_diff(a, e, ["k"], ["v"]), "k", "difference")
    assert got == [(2, "DIFFERENT"), (3, "LOCAL_CONFLICT"), (4, "MISSING"), (5, "EXTRA"), (6, "MISSING")]


def test_monthly_snapshots_switch_after_the_boundary(spark):
    cal = spark.sql("SELECT 'cn' market_code, d calendar_date, weekday(d) < 5 is_trading_day FROM (SELECT explode(sequence(date'2025-01-13', date'2025-02-14')) d)")
    snaps = spark.createDataFrame(
        [(D(2025, 1, 15), "s", "A"), (D(2025, 2, 1), "s", ""), (D(2025, 2, 10), "s", "C")], "snapshot_date date, stk_code string, grade string"
    )
    got = {d: g for d, g in rows(calendar.monthly_to_daily(snaps, cal, D(2025, 1, 13), D(2025, 2, 14)), "trading_date", "grade")}
    assert D(2025, 1, 14) not in got and got[D(2025, 1, 15)] == "A"
    # Saturday 1 February moves back to Friday, which still uses the first snapshot
    assert (got[D(2025, 1, 31)], got[D(2025, 2, 3)]) == ("A", "G")
    assert (got[D(2025, 2, 10)], got[D(2025, 2, 11)]) == ("G", "C")


def test_field_mapping_precedence(spark):
    df = spark.createDataFrame([("1", "2", "yes")], "a string, b string, c string")
    rule = lambda **k: mapping.FieldMap("t", **k)
    how = lambda r, ctx=None: mapping.resolve(r, df.columns, ctx or {}).method
    assert how(rule(exact="a", aliases=("b",))) == "exact"
    assert how(rule(exact="z", aliases=("b", "y"))) == "alias"
    assert how(rule(aliases=("a", "b"), constant=1)) == "pending"
    assert how(rule(candidates=("c",))) == "configured_candidate"
    assert how(rule(context_key="k", constant=1), {"k": 1}) == "context"
    assert how(rule(constant=None)) == "constant"
    assert how(rule()) == "missing"


def test_text_csv_keeps_text_and_strips_bom(spark, tmp_path):
    (tmp_path / "f.csv").write_text("﻿biz_date,stk_code\n2024-01-02,000001.SZ\n,NA\n", encoding="utf-8")
    df = readers.read_text_csv(spark, str(tmp_path / "f.csv"))
    assert df.columns == ["biz_date", "stk_code"]
    assert rows(df, "biz_date", "stk_code") == [("", "NA"), ("2024-01-02", "000001.SZ")]


def test_json_layouts(spark, tmp_path):
    (tmp_path / "l.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "o.json").write_text('{"a": 3}')
    (tmp_path / "d.json").write_text('{"data": [{"a": 4}, {"a": 5}]}')
    read = lambda n: rows(readers.read_json_records(spark, str(tmp_path / n)), "a")
    assert read("l.json") == [("1",), ("2",)] and read("o.json") == [("3",)] and read("d.json") == [("4",), ("5",)]


def test_preamble_csv_over_several_files_and_splits(spark, tmp_path):
    body = "\n".join(f"2024-01-{1 + i % 28:02d},{i:06d}.SH,\"a,b\"" for i in range(400))
    (tmp_path / "1.csv").write_text("note\n2023-01-01,999999.SH,trap\n﻿ \"biz_date\",stk_code,x\n" + body + "\n", encoding="utf-8")
    (tmp_path / "2.csv").write_text("x,stk_code\nbiz_date,x,stk_code\n2024-02-01,\"q,r\",600000.SH\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = readers.read_preamble_csv(spark, str(tmp_path))
        assert df.count() == 401 and df.rdd.getNumPartitions() >= 1
        assert df.where("stk_code = '999999.SH'").count() == 0
        assert rows(df.where("biz_date = '2024-02-01'"), "stk_code") == [("600000.SH",)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quarter_gaps(spark):
    df = spark.createDataFrame([("h2023Q4.csv",), ("h2024Q1.csv",), ("h2024Q3.csv",), ("bad.csv",)], "file_name string")
    assert rows(readers.quarter_file_set(df), "file_name", "status") == [
        ("bad.csv", "BAD_NAME"), ("h2023Q4.csv", "OK"), ("h2024Q1.csv", "OK"), ("h2024Q3.csv", "GAP_BEFORE"),
    ]


def test_merge_runs_later_wins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "a"), (3, None)], "k int, v string")
    assert {(r.k, r.v) for r in readers.merge_runs([a, b], ["k"]).collect()} == {(1, "x"), (2, "a"), (3, None)}


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get(staging.SETTING)
    assert staging.shared_folder(spark) == named
    kept = staging.store(spark.range(5), "t")
    assert kept.count() == 5
    assert all(named in f for f in kept.inputFiles())


def test_st_matrix_must_be_rectangular(spark):
    raw = spark.createDataFrame([("2024-01-02", "600001.XSHG", "True"), ("2024-01-02", "600002.XSHG", "False"), ("2024-01-03", "600001.XSHG", "False")], "trading_date string, security_code string, is_st string")
    states, found = readers.st_matrix(raw)
    assert states.count() == 3 and rows(found, "missing_securities", "repeated_rows") == [(1, 0)]


def test_localised_headers(spark):
    df = spark.createDataFrame([("XSHG", 3)], "market_code string, consecutive_length int")
    assert sinks.localise(df, sinks.EVENT_HEADERS).columns == ["交易市场代码", "连续跌停交易日数"]


def test_foundation_report(spark):
    key = ("XSHG", "600001.XSHG")
    make = lambda data, cols: spark.createDataFrame(data, KEY_SCHEMA + ", trading_date date, " + cols)
    f = foundation_run.DailyFacts(
        spark.createDataFrame([(*key, D(2020, 1, 1), None)], KEY_SCHEMA + ", listed_date date, delisted_date date"),
        spark.createDataFrame([("XSHG", d) for d in DAYS[:3]], "market_code string, trading_date date"),
        make([(*key, DAYS[0], 1.0, 2.0, 1.0, 1.5, 9.0, 9.0), (*key, DAYS[1], 1.0, 0.5, 1.0, 1.5, 9.0, 9.0)],
             "open_price double, high_price double, low_price double, close_price double, volume double, amount double"),
        make([(*key, DAYS[0], 2.0, 1.0)], "limit_up_price double, limit_down_price double"),
        make([(*key, d, False) for d in DAYS[:3]], "is_st boolean"),
        make([(*key, DAYS[0], False), (*key, DAYS[1], False), (*key, DAYS[2], True)], "is_suspended boolean"),
    )
    bad = {(r.rule_id, r.dataset_id): r.affected_rows for r in foundation_run.report(f).collect() if r.outcome == "FAIL"}
    assert bad == {("MDFRQ006", "daily_price_limits"): 1, ("MDFRQ007", ""): 1, ("MDFRQ009", "daily_price_unadjusted"): 1}


def test_receipts_replace_members_in_one_pass(spark, tmp_path):
    member = "dataset_id string, business_key string, source_record_version int, payload_hash string, partition_id string"
    base = [("d", "a", 1, "x", "p"), ("d", "b", 2, "x", "p"), ("e", "a", 1, "x", "p")]
    new = [("d", "a", 2, "y", "n"), ("d", "a", 3, "z", "n"), ("d", "c", 1, "y", "n")]
    for name, data in (("base", base), ("new", new)):
        spark.createDataFrame(data, member).write.parquet(str(tmp_path / name))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    got = store.override_selection(read("base"), read("new"))
    assert sorted(tuple(r) for r in got.collect()) == sorted([*base[1:], *new])
    assert got._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
