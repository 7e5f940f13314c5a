import re

from earlybell.llm import secrets
from tests.llm.cases import AWKWARD, empty, frame, rows

KEY = "AKIA" + "Q7" * 9
LOOSE = "h8Kd93mZpQ27xLw0Rt5v"
HEX = "0123456789abcdef" * 2
TEXTS = [
    *AWKWARD,
    f"password = hunter2x, {HEX} und {KEY}é {KEY}",
    "token: abc and token: abcdef; API_KEY='zzzzzz' apikey=short1",
    f"id {KEY}\nkey {LOOSE}",
    f"alone {LOOSE} here",
    f"{KEY}\n\n{LOOSE} in another paragraph",
    f"see https://host.example/a {LOOSE} user=anna",
    "https://host.example/only user=anna",
    f"{KEY} " + "far " * 80 + LOOSE,
    "Paſſword=geheim123 toKen=geheim123 secret=geheim123",
    f"secret={LOOSE} https://host.example/b",
]


def base(text):
    out = []
    for m in re.finditer(r"""(?a:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", text or ""):
        if len(m.group(1)) >= 6 and m.group().isascii():
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)), 1):
        for m in re.finditer(pattern, text or ""):
            if len(m.group()) >= least:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def spans(spark):
    got = secrets.scan(frame(spark, rows(TEXTS)), keep=["doc_id"]).orderBy("doc_id").collect()
    return [[f"{s.kind}:{s.start}:{s.end}" for s in r.secret_spans] for r in got]


def test_base_spans_equal_brute_force(spark):
    got = [[s for s in x if s.split(":")[0] in secrets.BASE_KINDS] for x in spans(spark)]
    assert got == [base(t) for t in TEXTS]


def test_weak_parts_need_complements(spark):
    got = [[s.split(":")[0] for s in x if s.split(":")[0] in secrets.WEAK_KINDS] for x in spans(spark)]
    n = len(AWKWARD)
    assert got[n + 2] == ["loose"]  # beside an access identifier
    assert got[n + 3] == []  # alone
    assert got[n + 4] == []  # another paragraph
    assert sorted(got[n + 5]) == ["account", "loose"]  # endpoint, string and account
    assert got[n + 6] == []  # no secret beside them
    assert got[n + 7] == []  # out of reach
    assert got[n + 9] == ["endpoint"]  # the string is reported as an assignment already


def test_redaction_replaces_every_span(spark):
    docs = frame(spark, rows(TEXTS))
    got = secrets.redact(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        before = TEXTS[r.doc_id]
        if before is None:
            assert r.text is None
        elif base(before):
            assert "[SECRET]" in r.text and not base(r.text)
        elif KEY not in before and "host" not in before:
            assert r.text == before


def test_one_span_plays_one_part(spark):
    url = "https://example.com/articles/2023/05/some-title"
    clean = [f"see {url} there", "user=anna20231984smith", f"{url} and {url}-2 too", "user=anna20231984smith login=otto19840101meier",
             f"user=anna20231984smith {url[:19]}"]
    docs = frame(spark, rows([*clean, f"{KEY} {url}", f"https://host.example/b?key={LOOSE} user=anna"]))
    spans = [r.secret_spans for r in secrets.scan(docs).orderBy("doc_id").collect()]
    assert not any(spans[: len(clean)]) and all(spans[len(clean) :])
    got = [r.text for r in secrets.redact(docs).orderBy("doc_id").collect()]
    assert got[: len(clean)] == clean
    assert got[-2] == "[SECRET] [SECRET]"  # an access identifier is beside it
    assert LOOSE not in got[-1]  # and so is an account


def test_empty_table(spark):
    assert secrets.scan(empty(spark)).count() == 0
    assert secrets.redact(empty(spark)).count() == 0
