"""Stored intermediate tables in the cluster's shared folder.

A result that several later steps read (events, assessments) is written once and
read back, which also cuts its lineage: a lost executor re-reads files instead of
recomputing the panel.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder(spark)
    raise RuntimeError(f"{SETTING} must name a folder that all executors share")


_LOCAL: dict[str, str] = {}


def _local_folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="spark-earlybell-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/earlybell-{uuid.uuid4().hex}/{name}"


def release(spark: SparkSession) -> None:
    """Delete what this session has stored; call it when no stored table is read any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in _STORED.pop(spark.sparkContext.applicationId, []):
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_STORED: dict[str, list[str]] = {}


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a fresh path in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path.rsplit("/", 1)[0])
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
