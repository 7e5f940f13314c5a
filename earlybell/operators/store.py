"""Versioned facts: idempotent append, current views, snapshots and their exports.

Facts are append-only rows keyed by (dataset_id, business_key,
source_record_version) with a payload hash. Latest-version selection is a
map-side combined aggregate, so keys with very many versions do not gather in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earlybell import rules as R
from earlybell.operators.panel import DAY, latest_version, stack_by_day

FACT_KEY = ("dataset_id", "business_key")
MEMBER = ("dataset_id", "business_key", "source_record_version", "payload_hash", "partition_id")


# --- append -----------------------------------------------------------------
def batch_conflicts(incoming: DataFrame) -> DataFrame:
    """Keys that one batch gives two different payloads; they block the append (V1)."""
    return (
        incoming.groupBy(*FACT_KEY)
        .agg(F.min("payload_hash").alias("lo"), F.max("payload_hash").alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select(*FACT_KEY)
    )


def append_versions(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows an append would write: new keys as version 1, changed ones one higher (V1).

    Incoming rows are folded per key and joined with the latest stored version; an
    unchanged payload writes nothing. Only stored rows of the batch's keys are folded:
    a small batch is broadcast to the store's scan, which its datasets prune as well.
    """
    fresh = latest_version(incoming, FACT_KEY, "payload_hash")
    known = store.join(incoming.select(*FACT_KEY).distinct(), list(FACT_KEY), "left_semi")
    current = known.groupBy(*FACT_KEY).agg(
        F.max_by(F.struct("source_record_version", "payload_hash"), "source_record_version").alias("cur")
    )
    version = F.col("cur.source_record_version")
    return (
        fresh.join(current, list(FACT_KEY), "left")
        .where(F.col("cur").isNull() | (F.col("cur.payload_hash") != F.col("payload_hash")))
        .select(
            *fresh.columns,
            (F.coalesce(version, F.lit(0)) + 1).cast("int").alias("source_record_version"),
            version.cast("int").alias("supersedes_version"),
        )
    )


def append_summary(incoming: DataFrame, written: DataFrame) -> DataFrame:
    """Input, written and idempotent row counts of one append (V1)."""
    one = F.lit(1).alias("one")
    a = incoming.agg(F.count("*").alias("input_rows")).select("*", one)
    b = written.agg(F.count("*").alias("written_rows")).select("*", one)
    return a.join(b, "one").select(
        "input_rows", "written_rows", (F.col("input_rows") - F.col("written_rows")).alias("idempotent_rows")
    )


def current_view(store: DataFrame) -> DataFrame:
    """Latest version of every fact (V2)."""
    return latest_version(store, FACT_KEY, "source_record_version")


# --- snapshots --------------------------------------------------------------
def snapshot_manifest(store: DataFrame) -> DataFrame:
    """Members of a snapshot: the identity of every latest fact (V3)."""
    return latest_version(store.select(*MEMBER), FACT_KEY, "source_record_version")


def member_digest(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Order-free digest of a set of members, with its size (V3).

    Each member's SHA-256 is cut into 60-bit words that are added up. Addition
    commutes, so partial sums combine map-side and no task ever sorts or collects
    the members; the sums are hashed once more at the end.
    """
    digest = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in MEMBER]), 256)
    words = [
        F.sum(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"w{i}")
        for i in range(4)
    ]
    return (
        manifest.groupBy(*by)
        .agg(F.count("*").alias("member_count"), *words)
        .select(
            *by,
            "member_count",
            F.sha2(
                F.concat_ws("|", F.col("member_count").cast("string"), *[F.col(f"w{i}").cast("string") for i in range(4)]),
                256,
            ).alias("member_hash"),
        )
    )


def read_snapshot(manifest: DataFrame, store: DataFrame, dataset_id: str | None = None) -> DataFrame:
    """Facts named by a manifest, matched on all five identity columns."""
    if dataset_id is not None:
        manifest = manifest.where(F.col("dataset_id") == dataset_id)
        store = store.where(F.col("dataset_id") == dataset_id)
    return store.join(manifest.select(*MEMBER), list(MEMBER), "left_semi")


def override_selection(base: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipts replace the base members of the same fact.

    Both sides meet in one shuffle by the fact, so neither is computed twice.
    """
    new = F.max("_new").over(Window.partitionBy(*FACT_KEY))
    both = base.select(*MEMBER, F.lit(0).alias("_new")).unionByName(receipts.select(*MEMBER, F.lit(1).alias("_new")))
    return both.withColumn("_any", new).where(F.col("_new") == F.col("_any")).select(*MEMBER)


def append_receipts(wanted: DataFrame, store: DataFrame) -> DataFrame:
    """Wanted (key, hash) pairs with the latest version that stores them, null if none (V8)."""
    keys = [*FACT_KEY, "payload_hash"]
    asked = wanted.select(*keys).distinct()
    stored = store.join(asked, keys, "left_semi").groupBy(*keys).agg(
        F.max("source_record_version").alias("source_record_version")
    )
    return asked.join(stored, keys, "left")


# --- version history --------------------------------------------------------
def version_chain_issues(store: DataFrame, bucket: int = 4096) -> DataFrame:
    """Rows whose version or supersedes link breaks the chain 1..n.

    The expected version is the row's position within its key. Positions are built
    in two steps (position inside a version range, plus the size of all earlier
    ranges), so a key with millions of versions is split over many tasks.
    """
    rows = store.select(*FACT_KEY, "source_record_version", "supersedes_version").withColumn(
        "_b", F.floor(F.col("source_record_version") / bucket)
    )
    sizes = rows.groupBy(*FACT_KEY, "_b").agg(F.count("*").alias("_n"))
    earlier = (
        Window.partitionBy(*FACT_KEY).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*FACT_KEY, "_b").orderBy("source_record_version", "supersedes_version")
    version, link = F.col("source_record_version"), F.col("supersedes_version")
    return (
        rows.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, [*FACT_KEY, "_b"])
        .withColumn("expected_version", F.col("_pos") + F.col("_offset"))
        .where(
            (version != F.col("expected_version"))
            | ((version == 1) & link.isNotNull())
            | ((version > 1) & (link != version - 1))
        )
        .select(*FACT_KEY, "source_record_version", "expected_version")
    )


def effective_ranges(records: DataFrame) -> DataFrame:
    """Dated records as closed ranges that end the day before the next one."""
    w = Window.partitionBy(*R.KEY).orderBy("effective_start")
    return records.withColumn("effective_end", F.date_sub(F.lead("effective_start").over(w), 1))


def close_and_open(stored: DataFrame, incoming: DataFrame, start: date) -> DataFrame:
    """Incremental master update: close the running range, open a new one.

    ``stored`` holds ranges (effective_start / effective_end), ``incoming`` one row
    per security. A changed listing date or board is reported, not applied.
    """
    day, eve = F.lit(start), F.lit(start - timedelta(days=1))
    fields = ["board_code", "listing_date", "termination_date", "effective_start", "effective_end"]
    last = stored.groupBy(*R.KEY).agg(F.max_by(F.struct(*fields), "effective_start").alias("old"))
    both = incoming.select(*R.KEY, F.struct("board_code", "listing_date", "termination_date").alias("new")).join(
        last, list(R.KEY), "left"
    )
    conflict = (
        F.when(F.col("old").isNull(), "UNKNOWN_SECURITY")
        .when(~F.col("old.listing_date").eqNullSafe(F.col("new.listing_date")), "LISTING_DATE_CHANGED")
        .when(~F.col("old.board_code").eqNullSafe(F.col("new.board_code")), "BOARD_CHANGED")
    )
    ended = F.coalesce(F.col("new.termination_date") <= day, F.lit(False))
    running = F.col("old.effective_end").isNull() | (F.col("old.effective_end") >= day)
    new_end = F.date_sub("new.termination_date", 1)

    def row(action: str, board, termination, begin, end) -> Column:
        return F.struct(
            F.lit(action).alias("action"),
            F.col(board).alias("board_code"),
            F.col(termination).alias("termination_date"),
            (F.col(begin) if isinstance(begin, str) else begin).alias("effective_start"),
            end.cast("date").alias("effective_end"),
        )

    closed = row("CLOSED", "old.board_code", "old.termination_date", "old.effective_start", eve)
    opened = row("OPENED", "new.board_code", "new.termination_date", day, new_end)
    ended_row = row("TERMINATED", "old.board_code", "new.termination_date", "old.effective_start", new_end)
    conflict_row = F.struct(
        F.col("conflict").alias("action"),
        F.col("new.board_code").alias("board_code"),
        F.col("new.termination_date").alias("termination_date"),
        F.col("old.effective_start").alias("effective_start"),
        F.col("old.effective_end").alias("effective_end"),
    )
    emitted = (
        F.when(F.col("conflict").isNotNull(), F.array(conflict_row))
        .when(
            ended,
            F.when(~F.col("old.termination_date").eqNullSafe(F.col("new.termination_date")), F.array(ended_row)),
        )
        .when(running, F.array(closed, opened))
        .otherwise(F.array(opened))
    )
    return both.withColumn("conflict", conflict).select(*R.KEY, F.explode(emitted).alias("r")).select(*R.KEY, "r.*")


def lifecycle_reference(old: DataFrame, master: DataFrame) -> DataFrame:
    """Old reference overwritten by the latest effective master row per security."""
    cols = ["listed_date", "delisted_date"]
    tagged = old.select(*R.KEY, *cols, F.lit(None).cast("date").alias("effective_start")).unionByName(
        master.select(*R.KEY, *cols, "effective_start")
    )
    # a null start sorts below every date, so any master row wins over the reference
    best = F.max(F.struct("effective_start", *cols)).alias("b")
    return tagged.groupBy(*R.KEY).agg(best).select(*R.KEY, "b.listed_date", "b.delisted_date")


def supplement_lifecycle(snapshot: DataFrame, reference: DataFrame) -> DataFrame:
    """Snapshot lifecycles plus the reference's extra securities; disagreement is a conflict."""
    s = snapshot.select(*R.KEY, F.struct("listed_date", "delisted_date").alias("s"))
    r = reference.where(F.col("market_code").isin(*R.RISK_MARKETS)).select(
        *R.KEY, F.struct("listed_date", "delisted_date").alias("r")
    )
    both = s.join(r, list(R.KEY), "full_outer")
    chosen = F.coalesce("s", "r")
    return both.select(
        *R.KEY,
        chosen["listed_date"].alias("listed_date"),
        chosen["delisted_date"].alias("delisted_date"),
        F.when(F.col("s").isNull(), "SUPPLEMENTED")
        .when(F.col("r").isNotNull() & ~F.col("s").eqNullSafe(F.col("r")), "CONFLICT")
        .otherwise("SNAPSHOT")
        .alias("origin"),
    )


def supplement_master(master: DataFrame, requested: DataFrame, snapshot_master: DataFrame, end: date) -> DataFrame:
    """Master rows for requested securities it lacks, taken from the snapshot."""
    missing = requested.select(*R.KEY).distinct().join(master.select(*R.KEY).distinct(), list(R.KEY), "left_anti")
    gone = F.coalesce(F.col("termination_date") <= F.lit(end), F.lit(False))
    extra = snapshot_master.join(missing, list(R.KEY), "left_semi").select(
        *R.KEY,
        F.lit(end).alias("status_date"),
        "board_code",
        F.col("listing_date").alias("listed_date"),
        F.col("termination_date").alias("delisted_date"),
        F.when(gone, "终止").otherwise("正常").alias("trading_eligibility_status"),
    )
    return master.unionByName(extra, allowMissingColumns=True)


# --- exports ----------------------------------------------------------------
def export_security_status(master_ranges: DataFrame, calendar: DataFrame, suspension: DataFrame) -> DataFrame:
    """Daily status rows from effective ranges (V4): one per natural day in range.

    ``master_ranges`` needs board_code, listing_date, termination_date,
    effective_start and effective_end.
    """
    days = calendar.groupBy("market_code").agg(F.array_sort(F.collect_set("calendar_date")).alias("days"))
    begin = F.greatest("effective_start", "listing_date")
    daily = (
        master_ranges.join(days, "market_code")
        .withColumn(DAY, F.explode("days"))
        .where((F.col(DAY) >= begin) & (F.col("effective_end").isNull() | (F.col(DAY) <= F.col("effective_end"))))
        .select(*R.KEY, DAY, "board_code", "listing_date", "termination_date")
    )
    merged = stack_by_day({"m": daily, "s": suspension.select(*R.KEY, DAY, "is_suspended")}).where(F.col("m").isNotNull())
    gone = F.coalesce(F.col(DAY) >= F.col("m.termination_date"), F.lit(False))
    return merged.select(
        *R.KEY,
        F.col(DAY).alias("status_date"),
        "m.board_code",
        F.when(gone, "Delisted").otherwise("Active").alias("lifecycle_status"),
        F.col("m.listing_date").alias("listed_date"),
        F.col("m.termination_date").alias("delisted_date"),
        F.when(gone, "终止")
        .when(F.coalesce(F.col("s.is_suspended"), F.lit(False)), "停牌")
        .otherwise("正常")
        .alias("trading_eligibility_status"),
    )


def dated_snapshot(facts: DataFrame, manifest: DataFrame, dataset_id: str, start: date | None, end: date) -> DataFrame:
    """A dataset's snapshot rows of a date range.

    The range is also stated on the stored year and month, so only the partitions that it
    touches are opened, and the members outside it leave the manifest before the join.
    """
    months = F.col("year") * 12 + F.col("month")
    inside = (F.col("business_date") <= F.lit(end)) & (months <= end.year * 12 + end.month)
    if start is not None:
        inside = inside & (F.col("business_date") >= F.lit(start)) & (months >= start.year * 12 + start.month)
    return read_snapshot(manifest, facts.where(inside), dataset_id)


def export_calendar(facts: DataFrame, manifest: DataFrame, start: date | None, end: date) -> DataFrame:
    """The standard calendar of a snapshot (V4)."""
    session = F.when(F.col("is_trading_day"), "正常开市").otherwise("休市")
    return dated_snapshot(facts, manifest, "market_calendar", start, end).select(
        "market_code",
        F.col("business_date").alias("calendar_date"),
        F.col("source_record_version").alias("record_version"),
        "is_trading_day",
        session.alias("trading_session_status"),
    )


def export_risk_status(facts: DataFrame, manifest: DataFrame, start: date | None, end: date) -> DataFrame:
    """The standard daily ST rows of a snapshot, each one day long (V4)."""
    return dated_snapshot(facts, manifest, "daily_st_status", start, end).select(
        *R.KEY,
        F.lit("ST").alias("risk_status_type"),
        F.when(F.col("is_st"), "生效").otherwise("未生效").alias("risk_status_value"),
        F.col("business_date").alias("status_start_date"),
        F.col("business_date").alias("status_end_date"),
        F.col("source_record_version").alias("record_version"),
    )


def evaluation_tables(facts: DataFrame, manifest: DataFrame, end: date, reference: DataFrame) -> dict[str, DataFrame]:
    """What the evaluation reads of a snapshot, as typed tables (V6): ``calendar`` (trading days of
    the first risk market), ``lifecycle`` (supplemented from the reference, J18, with the row's
    ``origin``; a CONFLICT must stop the evaluation) and ``st_status``.
    """
    days = export_calendar(facts, manifest, None, end).where(F.col("is_trading_day") & (F.col("market_code") == R.RISK_MARKETS[0]))
    master = read_snapshot(manifest, facts, "instrument_master_history").where(F.col("market_code").isin(*R.RISK_MARKETS))
    latest = F.max_by(F.struct("listing_date", "termination_date"), "effective_start").alias("x")
    lives = master.groupBy(*R.KEY).agg(latest).select(
        *R.KEY, F.col("x.listing_date").alias("listed_date"), F.col("x.termination_date").alias("delisted_date")
    )
    return {
        "calendar": days.select("market_code", "calendar_date", "is_trading_day"),
        "lifecycle": supplement_lifecycle(lives, reference),
        "st_status": export_risk_status(facts, manifest, None, end).where(F.col("market_code").isin(*R.RISK_MARKETS)),
    }


def export_adjusted_prices(suspension: DataFrame, closes: DataFrame, index: DataFrame, start: date, end: date) -> DataFrame:
    """Status rows with the adjusted close of the day and of exactly T-1 (V5).

    The previous session's close rides on the same panel: closes are stacked on
    their own day and on the next session, so no second lookup join is needed.
    """
    nxt = index.where(F.col("next_day").isNotNull()).select("market_code", DAY, "next_day")
    shifted = (
        closes.select(*R.KEY, DAY, "close_price")
        .join(nxt, ["market_code", DAY])
        .select(*R.KEY, F.col("next_day").alias(DAY), F.col("close_price").alias("previous_close"))
    )
    return (
        stack_by_day(
            {
                "s": suspension.where(F.col(DAY).between(F.lit(start), F.lit(end))).select(*R.KEY, DAY, "is_suspended"),
                "c": closes.select(*R.KEY, DAY, "close_price"),
                "p": shifted,
            }
        )
        .where(F.col("s").isNotNull())
        .select(
            *R.KEY,
            DAY,
            F.when(F.col("s.is_suspended"), "停牌").otherwise("正常成交").alias("trading_status"),
            "p.previous_close",
            "c.close_price",
        )
    )


def attach_adjusted_prices(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Many-to-one left join of adjusted prices on security and day."""
    return rows.join(
        prices.select(*R.KEY, DAY, F.col("close_price").alias("adjusted_close")), [*R.KEY, DAY], "left"
    )


def merge_adjusted_prices(prior: DataFrame, fresh: DataFrame, rebuilt: DataFrame, overlap: date) -> DataFrame:
    """Incremental price merge with overlap validation (V7).

    A security whose price on the overlap day differs beyond tolerance, or is gone,
    takes its whole history from ``rebuilt``; every other one keeps its prior rows
    before the overlap and appends the fresh ones.
    """
    tolerance = F.greatest(F.lit(1e-9) * F.greatest(F.abs("old"), F.abs("new")), F.lit(1e-8))
    on_day = F.col(DAY) == F.lit(overlap)
    verdict = (
        prior.where(on_day)
        .select(*R.KEY, F.col("close_price").cast("double").alias("old"))
        .join(fresh.where(on_day).select(*R.KEY, F.col("close_price").cast("double").alias("new")), list(R.KEY), "left")
        .where(F.col("new").isNull() | (F.abs(F.col("old") - F.col("new")) > tolerance))
        .select(*R.KEY)
    )
    cols = [*R.KEY, DAY, "close_price"]
    kept = prior.where(F.col(DAY) < F.lit(overlap)).select(*cols).unionByName(fresh.select(*cols))
    return (
        kept.join(verdict, list(R.KEY), "left_anti")
        .withColumn("source", F.lit("APPENDED"))
        .unionByName(
            rebuilt.select(*cols).join(verdict, list(R.KEY), "left_semi").withColumn("source", F.lit("REBUILT"))
        )
    )


def evaluation_inputs(store: DataFrame, manifest: DataFrame) -> DataFrame:
    """Snapshot rows the evaluation reads: calendar, lifecycle and ST datasets (V6)."""
    wanted = ("market_calendar", "instrument_master_history", "daily_st_status")
    return read_snapshot(
        manifest.where(F.col("dataset_id").isin(*wanted)), store.where(F.col("dataset_id").isin(*wanted))
    )


def snapshot_trading_dates(store: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct trading dates of a snapshot's calendar in the risk markets."""
    return (
        read_snapshot(manifest, store, "market_calendar")
        .where(F.col("market_code").isin(*R.RISK_MARKETS) & F.col("is_trading_day"))
        .select("business_date")
        .distinct()
    )


def previous_close_seed(prices: DataFrame, start: date) -> DataFrame:
    """Last close before a date per security, by a combined arg-max."""
    return (
        prices.where((F.col(DAY) < F.lit(start)) & F.col("close_price").isNotNull())
        .groupBy(*R.KEY)
        .agg(F.max_by("close_price", DAY).alias("previous_close"), F.max(DAY).alias("price_date"))
    )

