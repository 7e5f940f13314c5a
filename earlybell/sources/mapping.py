"""Source-to-standard field mapping, resolved on the plan's schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earlybell.functions import scalars as S

UNSET = object()


@dataclass(frozen=True)
class FieldMap:
    """How one standard field may be filled, in order of precedence."""

    target: str
    data_type: str = "string"
    exact: str | None = None
    aliases: tuple[str, ...] = ()
    candidates: tuple[str, ...] = ()
    context_key: str | None = None
    constant: Any = UNSET
    required: bool = False
    nullable: bool = True
    value_map: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Resolution:
    target: str
    method: str
    raw_field: str | None


def resolve(rule: FieldMap, columns: Sequence[str], context: Mapping[str, Any]) -> Resolution:
    """Exact name, one alias, one candidate, context, constant; two matches stay pending."""
    if rule.exact in columns:
        return Resolution(rule.target, "exact", rule.exact)
    for method, names in (("alias", rule.aliases), ("configured_candidate", rule.candidates)):
        hits = [n for n in names if n in columns]
        if len(hits) == 1:
            return Resolution(rule.target, method, hits[0])
        if hits:
            return Resolution(rule.target, "pending", " | ".join(hits))
    if rule.context_key is not None and rule.context_key in context:
        return Resolution(rule.target, "context", None)
    if rule.constant is not UNSET:
        return Resolution(rule.target, "constant", None)
    return Resolution(rule.target, "missing", None)


def map_fields(
    df: DataFrame, rules: Sequence[FieldMap], context: Mapping[str, Any] | None = None
) -> tuple[DataFrame, list[Resolution]]:
    """All standard columns in order, typed, plus how each was resolved.

    A single projection: unresolved fields become typed nulls.
    """
    context = context or {}
    columns, lineage = [], []
    for rule in rules:
        found = resolve(rule, df.columns, context)
        lineage.append(found)
        if found.method in ("exact", "alias", "configured_candidate"):
            value = F.col(f"`{found.raw_field}`")
        elif found.method == "context":
            value = F.lit(context[rule.context_key])
        elif found.method == "constant":
            value = F.lit(rule.constant)
        else:
            value = F.lit(None).cast("string")
        if rule.value_map:
            value = S.translate_value(value, rule.value_map)
        columns.append(S.convert(value, rule.data_type).alias(rule.target))
    return df.select(*columns), lineage


def mapping_findings(df: DataFrame, rules: Sequence[FieldMap], context: Mapping[str, Any] | None = None) -> DataFrame:
    """Missing and pending fields, and conversion losses: blanks in non-null fields and bad values."""
    context = context or {}
    rows, checks = [], []
    for rule in rules:
        found = resolve(rule, df.columns, context)
        if found.method == "missing" and rule.required:
            rows.append((rule.target, "MISSING_REQUIRED", None))
        elif found.method == "pending":
            rows.append((rule.target, "PENDING", None))
        elif found.raw_field is not None:
            raw = S.blank_to_null(F.col(f"`{found.raw_field}`"))
            value = S.translate_value(raw, rule.value_map) if rule.value_map else raw
            checks.append((rule.target, "INVALID_VALUE", raw.isNotNull() & S.convert(value, rule.data_type).isNull()))
            if not rule.nullable:
                checks.append((rule.target, "NULL_IN_NON_NULLABLE", raw.isNull()))
    schema = "target string, finding string, affected_rows bigint"
    head = df.sparkSession.createDataFrame(rows, schema)
    if not checks:
        return head
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, (*_, c) in enumerate(checks)])
    items = F.array(
        *[
            F.struct(F.lit(t).alias("target"), F.lit(k).alias("finding"), F.col(f"c{i}").alias("affected_rows"))
            for i, (t, k, _) in enumerate(checks)
        ]
    )
    return head.unionByName(counts.select(F.explode(items).alias("x")).select("x.*").where("affected_rows > 0"))


def unknown_fields(df: DataFrame, rules: Sequence[FieldMap], context: Mapping[str, Any] | None = None) -> list[str]:
    used = {resolve(r, df.columns, context or {}).raw_field for r in rules}
    return [c for c in df.columns if c not in used]


def pit_status_rows(instruments: DataFrame, status_date) -> DataFrame:
    """Instrument records of one snapshot date as dated status rows (P20)."""
    exchange = F.coalesce(S.blank_to_null("exchange"), F.regexp_extract("order_book_id", r"\.([A-Z]+)$", 1))
    clean = lambda c: S.convert(F.nullif(F.col(c).cast("string"), F.lit("0000-00-00")), "date")
    return instruments.select(
        exchange.alias("market_code"),
        F.col("order_book_id").alias("security_code"),
        F.lit(status_date).alias("status_date"),
        F.coalesce("board_type", F.lit("")).alias("board_code"),
        F.coalesce(S.blank_to_null("type"), F.lit("CS")).alias("security_type"),
        F.coalesce("status", F.lit("")).alias("lifecycle_status"),
        clean("listed_date").alias("listed_date"),
        clean("de_listed_date").alias("delisted_date"),
        F.when(F.lower("status") == "delisted", "终止").otherwise("正常").alias("trading_eligibility_status"),
    )


def daily_flags(grid: DataFrame, daily: DataFrame) -> DataFrame:
    """Market and ST rows of a vendor day file.

    The ST flag is either of two source booleans; a missing close means suspended;
    a limit-down day gets its close as limit price.
    """
    keys = [c for c in grid.columns if c in ("market_code", "security_code", "trading_date")]
    joined = grid.select(*keys).join(daily, keys, "left")
    has_close = F.col("close").isNotNull()
    st = F.coalesce(F.col("is_st"), F.lit(False)) | F.coalesce(F.col("is_star_st"), F.lit(False))
    return joined.select(
        *keys,
        F.when(st, "生效").otherwise("未生效").alias("risk_status_value"),
        F.when(has_close, "正常成交").otherwise("停牌").alias("trading_status"),
        F.col("close").alias("close_price"),
        F.when(has_close & F.coalesce(F.col("low_limit"), F.lit(False)), F.col("close")).alias("limit_down_price"),
    )
