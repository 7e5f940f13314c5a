"""Quality rules with adaptive thresholds, native expressions only.

Each document's shares (symbols, repeated lines, repeated windows, capitals, word
length) go into quantile sketches per language and source: a count for each bucket of
seven significant bits, so sketches merge by adding counts, and a quantile is exact
to a 64th of its value. A group's fence lies above its median by a multiple of its
lower spread (median less tenth percentile), which junk in the upper half does not
move; small groups use their language's sketch, then that of all documents.
The fences are a stored table of one row per group, joined back to the documents.

* null, empty or wordless text: no words, hence failed
* null language or source is a group of its own
* repeated documents count and are judged row by row; ties share their bucket
* extra columns are carried by ``judge``; one named like a result gives way to it
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earlybell.llm.common import behind, store

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


@dataclass(frozen=True)
class Rules:
    """Fixed floors, and what makes a fence of the sketches' quantiles."""

    min_words: int = 20
    max_repeat_percent: int = 30
    #: least rows for a group's own fences
    min_rows: int = 50
    #: spreads above the median
    factor: int = 6
    #: least spread of each share
    slack: tuple[tuple[str, int], ...] = (
        ("symbol_share", 10),
        ("line_share", 60),
        ("repeat_share", 45),
        ("capital_share", 20),
        ("word_length", 25),
    )

    @property
    def shares(self) -> list[str]:
        return [name for name, _ in self.slack]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column, n: int) -> Column:
    """Positions that windows with an equal elsewhere cover.

    Sorted by hash, such a window has an equal neighbour; by position, each adds what
    it covers before the next one starts.
    """

    def twins(s: Column) -> Column:
        def has_twin(x: Column, i: Column) -> Column:
            near = [F.get(s, i - 1)["h"] == x["h"], F.get(s, i + 1)["h"] == x["h"]]
            return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

        return F.array_sort(F.transform(F.filter(s, has_twin), lambda x: x["p"]))

    def length(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return _let(_let(placed, twins), length)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with the counts of COUNTS (long)."""
    kept = [c for c in docs.columns if c.lower() not in COUNTS]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    split = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        body.alias("_body"),
        F.filter(F.split(body, SPACE), lambda w: w != "").alias("_words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    hashed = split.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.size("_hashes") - (WINDOW - 1)
    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)))
    windowed = hashed.withColumn("_windows", F.when(last >= 1, windows).otherwise(F.array().cast("array<bigint>")))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    length = F.char_length(F.col("_body")).cast("long")
    made = {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": length - F.char_length(F.regexp_replace("_body", r"[#*$%&|<>]", "")),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(twice, _covered(F.col("_windows"), WINDOW)).otherwise(F.lit(0)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_capitals": length - F.char_length(F.regexp_replace("_body", "[A-Z]", "")),
    }
    return windowed.select(*kept, *[made[c].alias(c) for c in COUNTS])


def _per_mille(part: str, whole: str, scale: int = 1000) -> Column:
    return F.expr(f"({scale} * {part}) div greatest({whole}, 1L)")


def shares() -> dict[str, Column]:
    """What the sketches hold of a document, as whole numbers."""
    return {
        "symbol_share": _per_mille("n_symbols", "word_chars"),
        "line_share": _per_mille("n_dup_lines", "n_lines"),
        "repeat_share": _per_mille("n_repeat_words", "n_words"),
        "capital_share": _per_mille("n_capitals", "word_chars"),
        "word_length": _per_mille("word_chars", "n_words", 100),
    }


def base_failed(rules: Rules) -> Column:
    few = F.col("n_words") < rules.min_words
    return few | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def bucket(value: str) -> Column:
    """A value's bucket: its seven leading bits."""
    return F.expr(f"shiftleft(shiftright({value}, greatest(length(bin({value})) - 7, 0)), greatest(length(bin({value})) - 7, 0))")


def sketches(counted: DataFrame, rules: Rules, lang: str, source: str) -> DataFrame:
    """Mergeable sketches: rows with lang, source, share, bucket and n.

    Documents that fail anyway tell nothing about a group's usual text.
    """
    values = F.array(*[F.struct(F.lit(k).alias("share"), v.alias("value")) for k, v in shares().items()])
    one = counted.where(~base_failed(rules)).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.explode(values).alias("v")
    )
    return one.groupBy("lang", "source", F.col("v.share").alias("share"), bucket("v.value").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def fences(sketch: DataFrame, rules: Rules) -> DataFrame:
    """One row per language and source: the fence of each share."""
    levels = F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang").alias("lang"), F.col("source").alias("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("lang"), F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
    )
    merged = sketch.withColumn("g", F.explode(levels)).groupBy("g", "share", "bucket").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("g", "share").orderBy("bucket")
    whole = Window.partitionBy("g", "share")
    ranked = merged.select(
        "g", "share", "bucket", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total")
    )

    def quantile(percent: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("bucket")))

    least = F.create_map(*[F.lit(x) for pair in rules.slack for x in pair])
    spread = F.greatest(F.col("q50") - F.col("q10"), least[F.col("share")])
    of_share = ranked.groupBy("g", "share").agg(
        quantile(50).alias("q50"), quantile(10).alias("q10"), F.max("total").alias("total")
    )
    fence = of_share.withColumn("fence", F.col("q50") + rules.factor * spread)
    wide = fence.groupBy("g").agg(
        F.max("total").alias("total"),
        F.struct(*[F.max(F.when(F.col("share") == s, F.col("fence"))).alias(s) for s in rules.shares]).alias("f"),
    )
    own = wide.where("g.level = 2").select("g.lang", "g.source", F.col("total").alias("n2"), F.col("f").alias("f2"))
    of_lang = wide.where("g.level = 1").select(F.col("g.lang").alias("lang1"), F.col("total").alias("n1"), F.col("f").alias("f1"))
    of_all = wide.where("g.level = 0").select("f.*").first()  # one row of a few numbers
    overall = F.struct(*[F.lit(of_all[s] if of_all else None).cast("bigint").alias(s) for s in rules.shares])
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("lang1")), "left")
    enough = rules.min_rows
    chosen = F.when(F.col("n2") >= enough, F.col("f2")).when(F.col("n1") >= enough, F.col("f1")).otherwise(overall)
    return joined.select(
        F.col("lang").alias("fence_lang"), F.col("source").alias("fence_source"), chosen.alias("fence")
    )


def judge(
    docs: DataFrame,
    rules: Rules = Rules(),
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """Documents with their counts, base_failed and kept.

    ``keep`` names the columns to carry (default all). Texts are read once: counts and
    carried columns are stored, the sketches and the filter read them back.
    """
    results = (*COUNTS, "base_failed", "kept")
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]

    def step(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        return _judged(rows, rules, name[text], name[lang], name[source], [name[c] for c in carried])

    return behind(docs, step, carried, results)


def _judged(docs: DataFrame, rules: Rules, text: str, lang: str, source: str, carried: list[str]) -> DataFrame:
    """``judge`` under names that clash with none in here."""
    needed = list(dict.fromkeys([*carried, lang, source]))
    own = docs.select(*[F.col(f"`{c}`") for c in needed], F.col(f"`{text}`").alias("_text"))
    counted = store(counts(own, "_text").drop("_text"), "quality_counts")
    sketch = store(sketches(counted, rules, lang, source), "quality_sketches")
    fence = store(fences(sketch, rules), "quality_fences")
    match = F.col(f"`{lang}`").eqNullSafe(F.col("fence_lang")) & F.col(f"`{source}`").eqNullSafe(F.col("fence_source"))
    joined = counted.join(fence, match, "left")
    inside = F.lit(True)
    for name, share in shares().items():
        inside = inside & F.coalesce(share <= F.col("fence")[name], F.lit(True))
    failed = base_failed(rules)
    return joined.select(
        *[F.col(f"`{c}`") for c in carried], *COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept")
    )


def passing(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with their own columns."""

    def step(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        return judge(rows, rules, name[text], name[lang], name[source]).where("kept")

    return behind(docs, step)
