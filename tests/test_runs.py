from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators import metrics
from earlybell.plans.evaluation_run import EvaluationInputs, EvaluationRun
from earlybell.sources import readers, sinks
from earlybell.sources.staging import store
from tests.builders import D, Market, rows, sessions

DAYS = sessions(D(2024, 1, 1), 10)


def test_detection_feeds_evaluation(spark, tmp_path):
    run = Market(DAYS).add("600001", "nnnnLLLnnn", before="否").add("600002", "nnnnnTnnnn", before="否").run(spark)
    events = store(run.events(), "events")
    wide = spark.createDataFrame(
        [(DAYS[1], "600001.SH", "G", "A"), (DAYS[2], "600002.SH", "A", "F"), (D(2024, 1, 6), "600001.SH", "A", "A")],
        "biz_date date, stk_code string, B1 string, B2 string",
    )
    st = run.panel.select("market_code", "security_code", "trading_date", "is_st")
    prices = run.inputs.stock_market_daily.withColumn("previous_close", F.lit("9.500000").cast("decimal(20,6)"))
    evaluation = EvaluationRun(
        EvaluationInputs(events, wide, store(st, "st"), run.eligible, run.days, prices),
        ["B1", "B2"],
        R.BrokerMapping.from_dangerous("m", {"B1": "FG", "B2": "FG"}),
        DAYS[0],
        DAYS[-1],
        batch_id="e1",
    )
    verdicts = rows(evaluation.assessments().fillna(-1, ["warning_trading_days"]), "security_code", "broker_id", "is_hit", "warning_trading_days")
    assert verdicts == [
        ("600001.XSHG", "B1", True, 3), ("600001.XSHG", "B2", False, -1),
        ("600002.XSHG", "B1", False, -1), ("600002.XSHG", "B2", True, 3),
    ]
    manifest = {r.table_name: r.row_count for r in evaluation.write(str(tmp_path)).collect()}
    assert manifest["event_broker_assessments"] == 4
    assert manifest["broker_final_summary"] == manifest["broker_hit_rate_summary"] == 6
    # brokers x views x (sessions + period)
    assert manifest["broker_warning_rate_summary"] == 2 * 3 * (len(DAYS) + 1)
    tables = evaluation.tables()
    checks = metrics.count_reconciliation(
        events, tables["event_broker_assessments"], tables["broker_warning_days_summary"], tables["broker_hit_rate_summary"],
        tables["broker_warning_rate_summary"], ["B1", "B2"], run.days.select("trading_date"),
    )
    assert {r.passed for r in checks.collect()} == {True}
    mismatches = metrics.summary_key_mismatches(
        tables["broker_warning_days_summary"], tables["broker_hit_rate_summary"], tables["broker_warning_rate_summary"]
    )
    assert mismatches.count() == 0


def test_csv_export_and_file_list(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"])], "k string, ids array<string>")
    sinks.csv_export(df, f"{tmp_path}/out")
    assert rows(readers.read_text_csv(spark, f"{tmp_path}/out"), "k", "ids") == [("a", "x;y")]
    names = rows(readers.list_files(spark, f"{tmp_path}/out"), "file_name")
    assert names and all(n.endswith(".csv") for (n,) in names)
