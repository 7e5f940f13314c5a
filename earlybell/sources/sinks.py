"""Sinks: partitioned fact files, immutable result bundles, localised headers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITIONS = ("dataset_id", "market_code", "year", "month")

# fixed values: localised column headers of each result table
SEGMENT_HEADERS = {
    "market_code": "交易市场代码",
    "security_code": "证券代码",
    "segment_number": "连续段序号",
    "event_type": "事件类型",
    "event_source": "事件来源",
    "board_code": "板块代码",
    "applicable_threshold": "适用连续跌停门槛",
    "consecutive_length": "连续跌停交易日数",
    "first_fact_date": "首次事实日期",
    "threshold_reached_date": "达到门槛日期",
    "last_fact_date": "最后事实日期",
    "threshold_reached": "是否达到门槛",
    "open_at_observation_end": "观察期结束时是否未闭合",
    "rule_version": "风险规则版本号",
    "calculation_batch_id": "计算批次标识",
    "upstream_snapshot_id": "上游数据快照标识",
    "source_record_ids": "来源记录标识列表",
}
EVENT_HEADERS = {
    "market_code": "交易市场代码",
    "security_code": "证券代码",
    "event_type": "事件类型",
    "event_source": "事件来源",
    "first_fact_date": "首次事实日期",
    "risk_date": "风险认定日期",
    "last_fact_date": "最后事实日期",
    "threshold_reached_date": "达到门槛日期",
    "segment_number": "连续段序号",
    "consecutive_length": "连续跌停交易日数",
    "previous_st_state": "前一ST状态",
    "current_st_state": "当前ST状态",
    "rule_version": "风险规则版本号",
    "calculation_batch_id": "计算批次标识",
    "upstream_snapshot_id": "上游数据快照标识",
    "source_record_ids": "来源记录标识列表",
}
PRESSURE_HEADERS = {
    "market_code": "交易市场代码",
    "security_code": "证券代码",
    "event_type": "观察事件类型",
    "board_code": "板块代码",
    "observation_threshold": "低门槛观察阈值",
    "formal_threshold": "正式风险阈值",
    "first_fact_date": "首次跌停日期",
    "observation_date": "达到观察门槛日期",
    "last_fact_date": "最后跌停日期",
    "consecutive_length": "连续跌停交易日数",
    "upgraded_to_formal_risk": "是否同段升级为正式风险",
    "formal_risk_date": "正式风险认定日期",
    "open_at_observation_end": "观察期结束时是否未闭合",
    "pressure_rule_version": "压力观察规则版本",
    "formal_rule_version": "正式风险规则版本",
    "calculation_batch_id": "观察计算批次标识",
    "upstream_snapshot_id": "上游数据快照标识",
    "source_record_ids": "来源记录标识列表",
}


def localise(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """English to localised headers."""
    return df.withColumnsRenamed({k: v for k, v in headers.items() if k in df.columns})


def write_facts(facts: DataFrame, path: str, *, rows_per_file: int = 5_000_000) -> None:
    """Append facts under dataset / market / year / month.

    Rows are rebalanced on the partition columns: AQE splits a partition that is far
    larger than the others, so a hot market-month is written by several tasks, and
    small ones are not scattered over many files.
    """
    stamped = facts.withColumn("year", F.year("business_date")).withColumn("month", F.month("business_date"))
    (
        stamped.hint("rebalance", *[F.col(c) for c in PARTITIONS])
        .write.mode("append")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def write_bundle(tables: Mapping[str, DataFrame], root: str, batch_id: str) -> DataFrame:
    """Write one immutable result batch and return its manifest of counts.

    An existing batch is refused. Counts come from the files that were written, so
    the manifest states what a reader will find.
    """
    spark = next(iter(tables.values())).sparkSession
    manifest = None
    for name, df in tables.items():
        target = f"{root}/batch_id={batch_id}/{name}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(target)
        row = spark.read.parquet(target).agg(F.count("*").alias("row_count")).select(
            F.lit(batch_id).alias("batch_id"), F.lit(name).alias("table_name"), "row_count"
        )
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{root}/batch_id={batch_id}/manifest")
    return spark.read.schema("batch_id string, table_name string, row_count bigint").json(
        f"{root}/batch_id={batch_id}/manifest"
    )


def csv_export(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV files with a header; array columns become ';'-joined text."""
    out = df if columns is None else df.select(*columns)
    flat = [
        F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in out.dtypes
    ]
    out.select(*flat).write.mode("errorifexists").option("header", True).csv(path)
