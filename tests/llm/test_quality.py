import random
import re
from collections import defaultdict

from earlybell.llm import quality
from tests.llm.cases import AWKWARD, empty, frame, prose, rows

SPACE = " \t\n\x0b\f\r"


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    places = defaultdict(list)
    for k in range(len(w) - 7):
        places[tuple(w[k : k + 8])].append(k)
    covered = {k + i for at in places.values() if len(at) > 1 for k in at for i in range(8)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_capitals": len(re.findall("[A-Z]", text)),
    }


def shares(c):
    return {
        "symbol_share": 1000 * c["n_symbols"] // max(c["word_chars"], 1),
        "line_share": 1000 * c["n_dup_lines"] // max(c["n_lines"], 1),
        "repeat_share": 1000 * c["n_repeat_words"] // max(c["n_words"], 1),
        "capital_share": 1000 * c["n_capitals"] // max(c["word_chars"], 1),
        "word_length": 100 * c["word_chars"] // max(c["n_words"], 1),
    }


def failed(c):
    return c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]


def brute(data, rules):
    """Verdicts from sorted values instead of sketches; buckets cut values to seven bits."""

    def cut(v):
        s = max(v.bit_length() - 7, 0)
        return v >> s << s

    counted = [counts(r[1]) for r in data]
    groups = defaultdict(list)
    for r, c in zip(data, counted, strict=True):
        if not failed(c):
            for g in ((2, r[2], r[3]), (1, r[2], None), (0, None, None)):
                groups[g].append(shares(c))
    out = []
    for r, c in zip(data, counted, strict=True):
        own = groups.get((2, r[2], r[3]))
        kept = not failed(c)
        if kept:
            use = own if len(own) >= rules.min_rows else groups[(1, r[2], None)]
            use = use if len(use) >= rules.min_rows else groups[(0, None, None)]
            for name, slack in rules.slack:
                values = sorted(cut(x[name]) for x in use)
                q50, q10 = (values[-(-len(values) * p // 100) - 1] for p in (50, 10))
                kept &= shares(c)[name] <= q50 + rules.factor * max(q50 - q10, slack)
        out.append((failed(c), kept))
    return counted, out


def table():
    rng = random.Random(6)
    texts = list(AWKWARD)
    for k in range(120):
        body = prose(rng, rng.randrange(15, 90))
        if k % 10 == 0:
            body = body.replace(" ", " ### ")
        if k % 11 == 0:
            body = body.upper()
        if k % 7 == 0:
            body = "\n".join([body, body[:40], body[:40], " \t", " \t", "", ""])
        if k % 13 == 0:
            body += " " + body[:120]
        texts.append(body)
    return rows(texts + texts[20:30])


def test_counts_and_verdicts_equal_brute_force(spark):
    data, rules = table(), quality.Rules(min_rows=20)
    got = quality.judge(frame(spark, data), rules, keep=["doc_id", "lang"]).orderBy("doc_id").collect()
    counted, verdicts = brute(data, rules)
    assert [{c: r[c] for c in quality.COUNTS} for r in got] == counted
    assert [(r.base_failed, r.kept) for r in got] == verdicts
    assert {v for v in verdicts} == {(True, False), (False, True), (False, False)}


def test_passing_keeps_columns(spark):
    data, rules = table(), quality.Rules(min_rows=20)
    docs = frame(spark, data)
    got = quality.passing(docs, rules)
    assert got.columns == docs.columns
    _, verdicts = brute(data, rules)
    assert {r.doc_id for r in got.collect()} == {k for k, (_, kept) in enumerate(verdicts) if kept}
    assert all(r.n_words == "own" for r in got.collect())


def test_empty_table(spark):
    assert quality.judge(empty(spark)).count() == 0
    assert quality.passing(empty(spark)).count() == 0
