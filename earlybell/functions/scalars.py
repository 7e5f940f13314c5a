"""Column expressions: cleaning, predicates, keys and rates. All are JVM built-ins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from earlybell import rules as R


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- conversion -------------------------------------------------------------
def blank_to_null(c) -> Column:
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def convert(c, data_type: str) -> Column:
    """Typed value of a text column; blanks and unparsable texts become null."""
    text = blank_to_null(c)
    if data_type == "string":
        return text
    if data_type == "integer":
        number = text.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    if data_type == "boolean":
        return parse_bool(text)
    if data_type == "date":
        return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    if data_type == "datetime":
        # the offset is mandatory: a local time without one cannot be placed on the UTC axis
        return F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text.try_cast("timestamp"))
    if data_type == "decimal":
        return text.try_cast("decimal(24,6)")
    raise ValueError(f"unsupported data type: {data_type}")


def parse_st(c) -> Column:
    """Tolerant ST literal; null means the literal is unknown (P5)."""
    text = F.lower(F.trim(col(c).cast("string")))
    return F.when(text.isin(*R.ST_TRUE), True).when(text.isin(*R.ST_FALSE), False)


def parse_bool(c) -> Column:
    text = F.lower(F.trim(col(c).cast("string")))
    return F.when(text.isin(*R.BOOL_TRUE), True).when(text.isin(*R.BOOL_FALSE), False)


def translate_value(c, mapping: Mapping[str, str]) -> Column:
    """Value map on the lower-cased text; unmapped values pass through."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    text = col(c).cast("string")
    return F.coalesce(F.try_element_at(table, F.lower(text)), text)


def numeric_text(c) -> Column:
    """Plain decimal text without trailing zeros (``0.00`` -> ``0``), else the text."""
    text = F.trim(col(c).cast("string"))
    number = text.try_cast("decimal(38,12)")
    plain = F.regexp_replace(F.regexp_replace(number.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(number == 0, F.lit("0")).when(number.isNotNull(), plain).otherwise(text)


def china_date(moment) -> Column:
    """Calendar date of an instant at UTC+8, whatever the session's time zone is."""
    shifted = F.unix_micros(col(moment)) + F.lit(8 * 3600 * 1_000_000)
    return F.date_from_unix_date(F.floor(shifted / F.lit(86_400_000_000)).cast("int"))


# --- security codes and boards ---------------------------------------------
def security_market(code, digits: str = R.CODE_DIGITS) -> Column:
    """Market of a suffixed code (``600000.SH`` or ``600000.XSHG``), else null."""
    text = F.upper(F.trim(col(code).cast("string")))
    suffix = F.regexp_extract(text, rf"^{digits}\.(SH|SZ|BJ|XSHG|XSHE|XBSE)$", 1)
    named = {**{m: m for m in R.MARKETS}, **R.SUFFIX_MARKETS}
    # a lookup names the suffix once; filters evaluate each mention of it anew
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in named.items() for x in pair]), suffix)


def canonical_security(code, digits: str = R.CODE_DIGITS) -> Column:
    """``600000.SH`` -> ``600000.XSHG``; only an explicit suffix decides the market."""
    text = F.upper(F.trim(col(code).cast("string")))
    return F.concat(F.regexp_extract(text, rf"^({digits})\.", 1), F.lit("."), security_market(code, digits))


def business_code(security) -> Column:
    """``600000.XSHG`` -> ``600000.SH``."""
    out = col(security)
    for short, market in R.SUFFIX_MARKETS.items():
        out = F.regexp_replace(out, rf"\.{market}$", f".{short}")
    return out


def canonical_board(c, aliases: Mapping[str, str]) -> Column:
    text = F.trim(col(c).cast("string"))
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, text), text)


def board_from_code(code) -> Column:
    """Board by code prefix, for masters without a board column."""
    text = F.upper(F.trim(col(code)))
    return (
        F.when(text.endswith(".BJ"), "BSE")
        .when(text.endswith(".SH") & text.startswith("688"), "STAR")
        .when(text.endswith(".SZ") & text.rlike("^30[01]"), "CHINEXT")
        .otherwise("MAIN")
    )


def lookup(c, table: Mapping[str, int]) -> Column:
    """Small literal lookup, e.g. board -> threshold; null when absent."""
    items = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(items, col(c))


# --- predicates -------------------------------------------------------------
def prices_equal(left, right, scale: int = 6) -> Column:
    """Equality after half-even rounding, the decimal default of the rule book."""
    a = F.bround(col(left).cast("decimal(38,12)"), scale)
    b = F.bround(col(right).cast("decimal(38,12)"), scale)
    return F.coalesce(a == b, F.lit(False))


def is_limit_down(is_st, status, close, limit_down, scale: int = 6) -> Column:
    return F.coalesce(
        ~col(is_st)
        & F.trim(col(status)).isin(*R.NORMAL_TRADED)
        & prices_equal(close, limit_down, scale),
        F.lit(False),
    )


def is_weekend(day) -> Column:
    return F.weekday(col(day)) >= 5


def in_lifecycle(day, listed, delisted) -> Column:
    """Right-open lifecycle: listed <= day < delisted; a missing bound is open."""
    d = col(day)
    return (col(listed).isNull() | (d >= col(listed))) & (
        col(delisted).isNull() | (d < col(delisted))
    )


# --- classification ---------------------------------------------------------
def final_classification(has_record, raw, is_st, mapped_bucket) -> Column:
    """``struct(bucket, resolution)`` by precedence ST > none > blank > mapping."""

    def out(bucket, resolution):
        return F.struct(
            F.lit(bucket).cast("string").alias("bucket") if not isinstance(bucket, Column) else bucket.alias("bucket"),
            F.lit(resolution).alias("resolution"),
        )

    st = col(is_st)
    return (
        F.when(st.isNull(), out("UNKNOWN", "ST_STATUS_MISSING"))
        .when(st, out("DANGEROUS", "ST_OVERRIDE"))
        .when(~col(has_record), out(None, "NO_USABLE_CLASSIFICATION"))
        .when(col(raw) == "", out("NON_DANGEROUS", "BLANK_GENERAL"))
        .when(col(mapped_bucket).isNull(), out("UNKNOWN", "MAPPING_UNKNOWN"))
        .otherwise(out(col(mapped_bucket), "EXACT_MAPPING"))
    )


def grade_bucket(raw, selected_date) -> Column:
    """A-G, BLANK (a record without grade) or UNKNOWN."""
    text = F.upper(F.trim(F.coalesce(col(raw), F.lit(""))))
    return (
        F.when(text.rlike("^[A-G]$"), text)
        .when((text == "") & col(selected_date).isNotNull(), "BLANK")
        .otherwise("UNKNOWN")
    )


def hit_status(is_hit, identification_status=None, final_bucket=None) -> Column:
    """HIT / UNKNOWN / MISSED of the three-valued hit flag."""
    unknown = col(is_hit).isNull()
    for c in (identification_status, final_bucket):
        if c is not None:
            unknown = unknown | (F.upper(F.trim(col(c))) == "UNKNOWN")
    return F.when(col(is_hit), "HIT").when(F.coalesce(unknown, F.lit(False)), "UNKNOWN").otherwise("MISSED")


# --- keys and hashes --------------------------------------------------------
def event_key(*parts) -> Column:
    """Key text of an event; null where a part is null or blank."""
    return joined_key(*(parts or (*R.KEY, "event_type", "first_fact_date")))


def joined_key(*parts) -> Column:
    """Parts joined by ``|``. A missing part makes no shorter key that could meet another one."""
    texts = [blank_to_null(p) for p in parts]
    return F.concat(*[x for t in texts for x in (F.lit("|"), t)][1:])


def business_key(dataset_id: str) -> Column:
    """Key text of one fact: market|security|date, without security for calendars.

    Null where a part is null or blank; ``foundation.missing_key_parts`` reports these rows.
    """
    return joined_key(*key_parts(dataset_id))


def key_parts(dataset_id: str) -> tuple[str, ...]:
    if dataset_id == "market_calendar":
        return ("market_code", "business_date")
    day = "effective_start" if dataset_id == "instrument_master_history" else "business_date"
    return ("market_code", "security_code", day)


def canonical_payload(columns: Sequence[str]) -> Column:
    """Key-sorted compact JSON of text values; explicit nulls keep the field set stable."""
    return F.to_json(
        F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(columns)]),
        {"ignoreNullFields": "false"},
    )


def payload_hash(columns: Sequence[str]) -> Column:
    return F.sha2(canonical_payload(columns), 256)


# --- rates ------------------------------------------------------------------
def ratio(numerator, denominator) -> Column:
    """Exact decimal quotient; null for a zero denominator."""
    n = col(numerator).cast("decimal(20,0)")
    d = F.nullif(col(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return n / d


def rate(numerator, denominator, scale: int = 6) -> Column:
    """Half-up rounded quotient."""
    return F.round(ratio(numerator, denominator), scale)


def percent_text(numerator, denominator) -> Column:
    """``12.34%`` with half-up rounding, null for a zero denominator."""
    value = F.round(ratio(numerator, denominator) * F.lit(100), 2).cast("decimal(20,2)")
    return F.concat(value.cast("string"), F.lit("%"))
