"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the columns
of ``docs``. Rows with null ids or texts go through as each operator's docstring says;
empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earlybell.llm import decontaminate, jaccard, quality, queries, secrets
from earlybell.llm.common import store, table

#: Packing's token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality.passing(docs)


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of least id."""
    return jaccard.without_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark and n_chars counted anew."""
    redacted = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    counted = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return redacted.withColumn("n_chars", counted)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return queries.packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_copies", copies_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
