"""Personal data by candidate gradient boosting, native expressions only.

Base detectors (mail address, IP address, payment card, phone number) check what they
match and report it. Beside them, high-recall generators propose overlapping spans:
any long digit group, addresses written around, handles, account numbers. Each proposal
is described by small whole-number features of its format. Boosted trees learn, from
all proposals of the corpus counted by feature pattern, which look like personal data:
the label is whether a base span covers the proposal, or evidence of its own kind does
(an account number's check digits, contact words right before the others). No feature
shows that evidence. Half of the documents fit the trees, the other half gives each kind
its threshold: the least score at which (not from which on) the wanted share is labelled,
by isotonic regression. Proposals at or above it that touch no base span are reported,
too, leftmost first, and so are account numbers whose check digits are right.

The pattern table is bounded by the product of the features' ranges, whatever the
corpus; fitting to it equals fitting to all proposals. The trees are turned back into
CASE expressions.

Places, overlaps and the leftmost choice are ordered folds within a row (``common.scan``);
work and memory of a text grow as its length and its number of matches (times a logarithm
for sorting).

* null or empty text: no spans
* repeated documents are scanned row by row, and count as often
* no proposals at all: an empty model that reports base spans only
* an input column named like a result column gives way to it
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earlybell.llm.common import behind, let, scan

BASE_KINDS = ("email", "ip", "card", "phone")
# Possessive loops match what greedy ones do here (nothing follows them) without recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators, in the order in which their kinds are listed after the base ones.
WIDE = {
    "number": r"(?<![0-9])[+(]?[0-9][0-9()\x20./-]{5,}[0-9]",
    "address": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{2,63}(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{2,63})++",
    "handle": r"(?<![A-Za-z0-9._%+-])@[A-Za-z0-9_]{3,30}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20[0-9]{1,3}(?![A-Za-z0-9])|[A-Z0-9]{0,4})",
}
WIDE_KINDS = tuple(WIDE)
KINDS = (*BASE_KINDS, *WIDE_KINDS)
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Contact words right before a proposal of a kind: evidence for labels, never a feature.
CUES = {
    "number": r"(?i)\b(?:tele)?(?:phone|tel|call|fax|mobile|cell|contact)\b[^0-9\n]{0,12}$",
    "address": r"(?i)\b(?:e-?mail|mail|write|contact|reach)\b[^0-9@\n]{0,12}$",
    "handle": r"(?i)\b(?:write|mail|contact|message|follow|reach|twitter|instagram|telegram)\b[^0-9@\n]{0,12}$",
}
CONTEXT = 24
#: Characters of the pieces in which redaction reaches into a text.
PIECE = 1024
#: Evidence for a proposal.
NOTHING, CUED, CHECKED = 0, 1, 2
#: Features with the number of values each can take.
FEATURES = {"kind": 4, "digits": 21, "length": 8, "separators": 5, "lead": 4, "at": 2, "letters": 2, "attached": 2}

SPAN = "array<struct<start:int,end:int>>"
PROPOSAL = "struct<start:int,end:int,touched:boolean," + ",".join(f"{f}:int" for f in ("proof", *FEATURES)) + ">"


def _matches(body: Column, pattern: str) -> Column:
    return F.regexp_extract_all(body, F.lit(pattern), F.lit(0))


def _places(found: Column, gaps: Column) -> Column:
    """Each match with start and end, in code points, from the texts between the matches, and
    the ``CONTEXT`` characters before it: a running sum, linear in the number of matches."""

    def ending(text: Column) -> Column:
        return F.substring(text, -CONTEXT, CONTEXT)

    def sized(gap: Column, m: Column) -> Column:
        return F.struct(m.alias("m"), F.char_length(m).alias("n"), F.char_length(gap).alias("skip"), ending(gap).alias("lead"))

    def step(carry: Column, x: Column) -> tuple[Column, Column]:
        start = carry["at"] + x["skip"]
        before = ending(F.concat(carry["tail"], x["lead"]))
        spot = F.struct(x["m"].alias("m"), start.alias("start"), (start + x["n"]).alias("end"), before.alias("before"))
        tail = ending(F.concat(carry["tail"], x["lead"], x["m"]))
        return F.struct((start + x["n"]).alias("at"), tail.alias("tail")), F.array(spot)

    pairs = F.slice(F.zip_with(gaps, found, sized), F.lit(1), F.size(found))
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
    return scan(pairs, nothing, step, "struct<m:string,start:int,end:int,before:string>")


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _possible(kind: str, body: Column) -> Column:
    """A cheap look for what every match of a kind has."""
    if kind in ("email", "handle"):
        return F.contains(body, F.lit("@"))
    if kind == "phone":
        return F.contains(body, F.lit("+"))
    if kind == "address":
        return body.rlike(r"@|[(\[]at[)\]]|\x20at\x20[A-Za-z0-9-]+\x20?(?:\.|\(dot|\[dot|\x20dot\x20)")
    return body.rlike("[0-9]")


def _mod97(m: Column) -> Column:
    """The remainder of an account number's check: 1 where its check digits are right."""
    plain = F.regexp_replace(m, "[^A-Z0-9]", "")
    turned = F.concat(plain.substr(5, 64), plain.substr(1, 4))

    def step(acc: Column, c: Column) -> Column:
        digit = F.when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (acc * F.when(digit < 10, 10).otherwise(100) + digit) % 97

    return F.aggregate(F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0)), F.lit(0), step)


def _proof(kind: str, m: Column, digits: Column, before: Column) -> Column:
    """What speaks for a proposal without a base span's help."""
    if kind == "account":
        return F.when(_mod97(m) == 1, CHECKED).otherwise(NOTHING)
    cued = before.rlike(CUES[kind])
    if kind == "number":
        cued = cued & digits.between(7, 15)
    return F.when(cued, CUED).otherwise(NOTHING)


def _features(kind: str, x: Column) -> Column:
    m, before = x["m"], x["before"]
    n = F.char_length(m)
    digits = n - F.char_length(F.regexp_replace(m, "[0-9]", ""))
    plain = F.char_length(F.regexp_replace(m, "[^A-Za-z0-9]", ""))
    first = F.when(m.startswith("+"), 1).when(m.startswith("("), 2).when(m.rlike("^[0-9]"), 0).otherwise(3)
    values = {
        "kind": F.lit(WIDE_KINDS.index(kind)),
        "digits": F.least(digits, F.lit(20)),
        "length": F.least(F.floor(n / 4), F.lit(7)),
        "separators": F.least(n - plain, F.lit(4)),
        "lead": first,
        "at": F.contains(m, F.lit("@")).cast("int"),
        "letters": (plain > digits).cast("int"),
        "attached": before.rlike("[A-Za-z0-9]$").cast("int"),
    }
    proof = _proof(kind, m, digits, before).alias("proof")
    place = (x["start"].alias("start"), x["end"].alias("end"), F.lit(False).alias("touched"))
    return F.struct(*place, proof, *[v.alias(k) for k, v in values.items()]).cast(PROPOSAL)


def propose(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``base`` (a struct of valid spans by kind) and ``proposals``."""
    results = ("base", "proposals")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    return behind(docs, lambda rows, name: _proposed(rows, name[text], [name[c] for c in kept]), kept, results)


def _proposed(docs: DataFrame, text: str, kept: list[str]) -> DataFrame:
    """``propose`` under names that clash with none in here."""
    own = [F.col(f"`{c}`") for c in kept]
    rows = docs.select(*own, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_body"))
    body = F.col("_body")
    none = F.array().cast("array<string>")
    both = [*BASE.items(), *WIDE.items()]
    found = rows.select(*own, body, *[F.when(_possible(k, body), _matches(body, p)).otherwise(none).alias(f"_m_{k}") for k, p in both])
    split = found.select(
        *own, body, *[f"_m_{k}" for k, _ in both],
        *[F.when(F.size(f"_m_{k}") > 0, F.split(body, p, -1)).otherwise(none).alias(f"_g_{k}") for k, p in both],
    )
    placed = split.select(*own, *[_places(F.col(f"_m_{k}"), F.col(f"_g_{k}")).alias(f"_s_{k}") for k, _ in both])

    def valid(kind: str) -> Column:
        ok = F.filter(F.col(f"_s_{kind}"), lambda x: _valid(kind, x["m"]))
        return F.transform(ok, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).cast(SPAN)

    def described(kind: str) -> Column:
        return F.transform(F.col(f"_s_{kind}"), lambda x: _features(kind, x))

    apart = placed.select(
        *own, F.struct(*[valid(k).alias(k) for k in BASE_KINDS]).alias("base"), F.concat(*map(described, WIDE_KINDS)).alias("_wide")
    )
    return apart.select(*own, "base", _touching(F.col("base"), F.col("_wide")).alias("proposals"))


def _touching(base: Column, proposals: Column) -> Column:
    """Proposals, by their ends, told whether they overlap a base span: one pass over both in
    the order of base starts and proposal ends, which carries the furthest base end so far."""
    typed = f"array<struct<at:int,side:int,end:int,p:{PROPOSAL}>>"

    def entry(at: Column, side: int, end: Column, p: Column) -> Column:
        # where both stand at one place the proposal comes first: it ends before that base span
        return F.struct(at.alias("at"), F.lit(side).alias("side"), end.alias("end"), p.alias("p"))

    nobody = F.lit(None).cast(PROPOSAL)
    spans = F.transform(F.concat(*[base[k] for k in BASE_KINDS]), lambda s: entry(s["start"], 1, s["end"], nobody)).cast(typed)
    wide = F.transform(proposals, lambda p: entry(p["end"], 0, p["end"], p)).cast(typed)

    def step(carry: Column, x: Column) -> tuple[Column, Column]:
        p = x["p"]
        told = [(carry["far"] > p["start"]).alias(f) if f == "touched" else p[f].alias(f) for f in ("start", "end", "touched", "proof", *FEATURES)]
        mine = F.when(x["side"] == 0, F.array(F.struct(*told))).otherwise(F.array().cast(f"array<{PROPOSAL}>"))
        far = F.when(x["side"] == 1, F.greatest(carry["far"], x["end"])).otherwise(carry["far"])
        return F.struct(far.alias("far")), mine

    merged = scan(F.sort_array(F.concat(spans, wide)), F.struct(F.lit(0).alias("far")), step, PROPOSAL)
    return F.when((F.size(proposals) == 0) | (F.size(spans) == 0), F.sort_array(proposals)).otherwise(merged)


# --- the model ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    rounds: int = 30
    depth: int = 3
    rate: float = 0.3
    #: least proposals in a leaf
    leaf: int = 20
    #: share of a kind's proposals at the threshold that are labelled
    precision: float = 0.9


@dataclass(frozen=True)
class Node:
    """A leaf's value, or a split: ``feature <= at`` goes left."""

    value: float = 0.0
    feature: str = ""
    at: int = 0
    left: Node | None = None
    right: Node | None = None


@dataclass(frozen=True)
class Model:
    start: float = 0.0
    trees: list[Node] = field(default_factory=list)
    #: least scores by kind
    thresholds: tuple[float, ...] = (2.0,) * len(WIDE_KINDS)

    @property
    def threshold(self) -> float:
        return min(self.thresholds)


def patterns(proposed: DataFrame) -> DataFrame:
    """How often each feature pattern occurs and is labelled (covered by base spans or evident by
    itself), by half of the documents (a hash of the whole row, its id included)."""

    def label(p: Column) -> Column:
        return (p["proof"] > NOTHING) | p["touched"]

    one = proposed.select(
        F.pmod(F.xxhash64(*proposed.columns), F.lit(2)).cast("int").alias("half"),
        F.explode(F.transform("proposals", lambda p: F.struct(p.alias("p"), label(p).alias("hit")))).alias("x"),
    )
    return one.groupBy("half", *[F.col(f"x.p.{f}").alias(f) for f in FEATURES]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x.hit").cast("int")).alias("hits")
    )


def fit(proposed: DataFrame, settings: Settings = Settings()) -> Model:
    """Boosted trees of the pattern table, one row per pattern at most, and the kinds' thresholds."""
    import numpy as np

    rows = patterns(proposed).collect()
    table = np.asarray([[r["half"], *(r[f] for f in FEATURES), r["n"], r["hits"]] for r in rows], float).reshape(-1, len(FEATURES) + 3)
    table = table[np.lexsort(table.T[::-1])]
    fitted, aside = table[table[:, 0] == 0], table[table[:, 0] == 1]
    if not len(fitted) or not len(aside):
        return Model()
    x, n, hits = fitted[:, 1:-2].astype(int), fitted[:, -2], fitted[:, -1]
    rate0 = (hits.sum() + 0.5) / (n.sum() + 1)
    start = float(np.log(rate0 / (1 - rate0)))
    margin, trees = np.full(len(x), start), []
    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, n, hits - n * p, n * p * (1 - p), settings, settings.depth)
        trees.append(tree)
        margin += _values(tree, x)
    rest = aside[:, 1:-2].astype(int)
    scores = 1 / (1 + np.exp(-(start + sum((_values(t, rest) for t in trees), np.zeros(len(rest))))))
    kinds = rest[:, list(FEATURES).index("kind")]
    of_kind = [kinds == k for k in range(len(WIDE_KINDS))]
    return Model(start, trees, tuple(_least(scores[s], aside[s, -2], aside[s, -1], settings.precision) for s in of_kind))


def _least(scores, n, hits, precision: float) -> float:
    """The least score whose calibrated share of labels (isotonic in the score) is the wanted one; 2: none."""
    import numpy as np

    values, where = np.unique(scores, return_inverse=True)  # patterns of one score go together
    blocks: list[tuple[float, float, float]] = []
    for value, total, good in zip(values, np.bincount(where, n), np.bincount(where, hits), strict=True):
        blocks.append((value, total, good))
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            _, total, good = blocks.pop()
            low, below, labelled = blocks.pop()
            blocks.append((low, below + total, labelled + good))
    # a hair lower: the expression adds the trees up in the same order, but not bit by bit
    return next((float(value) - 1e-9 for value, total, good in blocks if good >= precision * total), 2.0)


def _grow(x, n, gradient, curvature, settings: Settings, depth: int) -> Node:
    """The split of the largest gain, again and again, on rows that stand for n proposals each."""
    import numpy as np

    def weight(g: float, h: float) -> float:
        return g * g / (h + 1.0)

    total_g, total_h = gradient.sum(), curvature.sum()
    best = (1e-6, None)
    if depth:
        for k, (name, values) in enumerate(FEATURES.items()):
            g, h, m = (np.bincount(x[:, k], w, values).cumsum()[:-1] for w in (gradient, curvature, n))
            for at in np.flatnonzero((m >= settings.leaf) & (n.sum() - m >= settings.leaf)):
                gain = weight(g[at], h[at]) + weight(total_g - g[at], total_h - h[at]) - weight(total_g, total_h)
                if gain > best[0]:
                    best = (gain, (k, name, int(at)))
    if best[1] is None:
        return Node(float(settings.rate * total_g / (total_h + 1.0)))
    k, name, at = best[1]
    low = x[:, k] <= at
    sides = [_grow(x[s], n[s], gradient[s], curvature[s], settings, depth - 1) for s in (low, ~low)]
    return Node(0.0, name, at, *sides)


def _values(tree: Node, x):
    import numpy as np

    if not tree.feature:
        return np.full(len(x), tree.value)
    low = x[:, list(FEATURES).index(tree.feature)] <= tree.at
    return np.where(low, _values(tree.left, x), _values(tree.right, x))


def _expression(tree: Node, p: Column) -> Column:
    if not tree.feature:
        return F.lit(tree.value)
    return F.when(p[tree.feature] <= tree.at, _expression(tree.left, p)).otherwise(_expression(tree.right, p))


def score(model: Model, p: Column) -> Column:
    margin = F.lit(model.start)
    for tree in model.trees:
        margin = margin + _expression(tree, p)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


# --- results --------------------------------------------------------------------------------


def select(proposed: DataFrame, model: Model) -> DataFrame:
    """Documents with ``pii_spans``: kind, start, end and score, by kind as listed, then start.

    Base spans, and account numbers whose check digits are right, have score 1.
    """
    typed = "array<struct<kind:string,start:int,end:int,score:double>>"

    def named(kind: str) -> Column:
        return F.transform(
            F.col("base")[kind],
            lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(1.0).alias("score")),
        )

    base = F.concat(*map(named, BASE_KINDS)).cast(typed)
    names = F.array(*[F.lit(k) for k in WIDE_KINDS])
    least = F.array(*[F.lit(t) for t in model.thresholds])
    scored = F.transform(
        F.filter("proposals", lambda p: ~p["touched"]),
        lambda p: F.struct(
            p["start"].alias("start"),
            (-p["end"]).alias("minus_end"),
            F.get(names, p["kind"]).alias("kind"),
            p["kind"].alias("rank"),
            F.when(p["proof"] == CHECKED, 1.0).otherwise(score(model, p)).alias("score"),
            F.when(p["proof"] == CHECKED, 1.0).otherwise(F.get(least, p["kind"])).alias("least"),
        ),
    )
    good = F.sort_array(F.filter(scored, lambda s: s["score"] >= s["least"]))
    chosen = "struct<rank:int,start:int,end:int,kind:string,score:double>"

    def leftmost(carry: Column, s: Column) -> tuple[Column, Column]:
        end = -s["minus_end"]
        one = F.struct(s["rank"].alias("rank"), s["start"].alias("start"), end.alias("end"), s["kind"].alias("kind"), s["score"].alias("score"))
        free = s["start"] >= carry["at"]
        taken = F.when(free, F.array(one)).otherwise(F.array().cast(f"array<{chosen}>"))
        return F.struct(F.when(free, end).otherwise(carry["at"]).alias("at")), taken

    more = F.sort_array(scan(good, F.struct(F.lit(0).alias("at")), leftmost, chosen))
    plain = F.transform(
        more, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"))
    ).cast(typed)
    return proposed.withColumn("pii_spans", F.concat(base, plain)).drop("base", "proposals")


def redact(docs: DataFrame, model: Model, text: str = "text", mark: str = "[PII]") -> DataFrame:
    """Documents whose spans are replaced by a mark; null text stays null."""

    def step(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        body = F.col(name[text])
        found = select(propose(rows, name[text]), model)
        spans = F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

        def parts(pieces: Column) -> Column:
            def between(start: Column, end: Column) -> Column:
                first = F.floor(start / PIECE).cast("int")
                near = F.array_join(F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1), "")
                return F.substr(near, start - first * PIECE + 1, end - start)

            def cut(carry: Column, s: Column) -> tuple[Column, Column]:
                fresh = F.array(between(carry["at"], s["start"]), F.lit(mark))
                kept = F.when(s["start"] >= carry["at"], fresh).otherwise(F.array().cast("array<string>"))
                return F.struct(F.greatest(carry["at"], s["end"]).alias("at")), kept

            last = F.greatest(F.lit(0), F.array_max(F.transform("_spans", lambda s: s["end"])))
            made = F.concat(scan(F.col("_spans"), F.struct(F.lit(0).alias("at")), cut, "string"), F.array(between(last, F.char_length(body))))
            return F.array_join(made, "")

        made = found.withColumn("_spans", spans)
        cut_up = let(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), parts)
        whole = F.when(body.isNull() | (F.size("_spans") == 0), body).otherwise(cut_up)
        return made.withColumn(name[text], whole)

    return behind(docs, step)
