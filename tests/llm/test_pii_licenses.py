import random
import re

from earlybell.llm import licenses, pii
from tests.llm.cases import AWKWARD, empty, frame, prose, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def texts():
    rng = random.Random(11)
    pieces = ["a@b.c", "é.x@y-z.co.uk_w@v.de", "1.2.3.4", "256.1.1.1", "001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1 2", "@handle", "@", "..", "1 2", "00", "x"]
    made = ["".join(rng.choice([*pieces, " ", ", ", "ß"]) for _ in range(rng.randrange(1, 14))) for _ in range(250)]
    made += [f"call +4930{rng.randrange(10**7, 10**8)} now {prose(rng, 5)} card 4{rng.randrange(10**14, 10**15)}" for _ in range(200)]
    return [*AWKWARD, *made, "1" * 60_000, "1 " * 20_000, "a@" + "b." * 20_000 + "c", "a" * 60_000 + "@", "1." * 20_000]


def test_base_spans_equal_brute_force(spark):
    all_texts = texts()
    proposed = pii.propose(frame(spark, rows(all_texts)), keep=["doc_id"]).cache()
    model = pii.fit(proposed)
    got = pii.select(proposed, model).orderBy("doc_id").collect()
    for r in got:
        found = [(s.kind, s.start, s.end) for s in r.pii_spans]
        own = [s for s in found if s[0] in pii.BASE_KINDS]
        assert own == base(all_texts[r.doc_id])
        more = [s for s in found if s[0] not in pii.BASE_KINDS]
        assert found == own + more
        assert not any(a < e and b > s for _, a, b in more for _, s, e in own)


def test_threshold_admits_what_looks_validated(spark):
    """Card-like numbers among which most pass the check: the others are reported, too."""
    rng = random.Random(1)
    cards = []
    while len(cards) < 600:
        body = f"4{rng.randrange(10**14, 10**15)}"
        check = next(c for c in "0123456789" if luhn(body + c))
        wrong = str((int(check) + 1) % 10)
        cards.append(f"{prose(rng, 3)} visa {body}{wrong if len(cards) % 25 == 0 else check} {prose(rng, 2)}")
    cards += [f"order no {rng.randrange(10**7, 10**8)} {prose(rng, 3)}" for _ in range(300)]
    proposed = pii.propose(frame(spark, rows(cards)), keep=["doc_id"]).cache()
    model = pii.fit(proposed)
    assert 0 < model.threshold < 1
    got = {r.doc_id: [s.kind for s in r.pii_spans] for r in pii.select(proposed, model).collect()}
    assert all(got[k] == (["number"] if k % 25 == 0 else ["card"]) for k in range(600))
    assert not any(got[k] for k in range(600, 900))


def test_each_kind_is_learnt_by_its_own_evidence(spark):
    """Kinds that base can't cover, among many dates and order numbers; every 21st has no cue."""
    rng = random.Random(5)
    made = []
    for k in range(1200):
        word = prose(rng, 3)
        cue = (lambda c: c) if k % 21 else (lambda c: word.split()[0])  # noqa: B023
        number = f"(0{rng.randrange(20, 90)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        other = f"{word} on {rng.randrange(1990, 2024)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}"
        one = [f"{cue('call')} {number}", f"{cue('mail')} {name} (at) host (dot) de", f"{cue('follow')} @{name}", other]
        made.append(f"{word} {one[k % 4]} {word}" if k % 8 < 4 else f"order {rng.randrange(10**7, 10**8)} {word}, {one[k % 4]} ok")
    proposed = pii.propose(frame(spark, rows(made)), keep=["doc_id"]).cache()
    got = {r.doc_id: [s.kind for s in r.pii_spans] for r in pii.select(proposed, pii.fit(proposed)).collect()}
    want = [["number"], ["address"], ["handle"], []]
    assert [k for k in got if got[k] != want[k % 4]] == []


def test_account_numbers_with_right_check_digits(spark):
    data = ["to DE89 3704 0044 0532 0130 00 now", "GB82WEST12345698765432", "to DE88 3704 0044 0532 0130 00 now", "FR1420041010050500013M02606"]
    got = pii.select(pii.propose(frame(spark, rows(data)), keep=["doc_id"]), pii.Model()).orderBy("doc_id").collect()
    assert [[(s.kind, s.start, s.end) for s in r.pii_spans] for r in got] == [[("account", 3, 30)], [("account", 0, 22)], [], [("account", 0, 27)]]


def test_scores_equal_the_trees(spark):
    proposed = pii.propose(frame(spark, rows(texts()[:300])), keep=["doc_id"])
    model = pii.fit(proposed)
    import numpy as np
    from pyspark.sql import functions as F

    one = proposed.select(F.explode("proposals").alias("p")).select("p.*", pii.score(model, F.col("p")).alias("score")).collect()
    x = np.asarray([[r[f] for f in pii.FEATURES] for r in one])
    margin = model.start + sum((pii._values(t, x) for t in model.trees), np.zeros(len(x)))
    assert np.allclose([r.score for r in one], 1 / (1 + np.exp(-margin)))
    assert all(r[f] < n for r in one for f, n in pii.FEATURES.items())


def test_selection_equals_brute_force(spark):
    """Overlaps with base spans, and the leftmost choice among equals, as a loop makes them."""
    proposed = pii.propose(frame(spark, rows(texts()[:450])), keep=["doc_id"]).cache()
    model = pii.Model(thresholds=(0.0, 0.0, 2.0, 0.0))
    chosen = {r.doc_id: [tuple(s)[:3] for s in r.pii_spans if s.kind not in pii.BASE_KINDS] for r in pii.select(proposed, model).collect()}
    for r in proposed.collect():
        taken = [(s.start, s.end) for k in pii.BASE_KINDS for s in r.base[k]]
        assert all(p.touched == any(a < p.end and b > p.start for a, b in taken) for p in r.proposals)
        at, want = 0, []
        for p in sorted(r.proposals, key=lambda p: (p.start, -p.end, pii.WIDE_KINDS[p.kind])):
            if not p.touched and p.start >= at and (pii.WIDE_KINDS[p.kind] != "handle"):
                at = p.end
                want.append((pii.WIDE_KINDS[p.kind], p.start, p.end))
        assert chosen[r.doc_id] == sorted(want, key=lambda w: (pii.WIDE_KINDS.index(w[0]), w[1]))


def test_many_matches_in_one_text(spark):
    """Folds in blocks: as many matches as a log file has, each at its place."""
    text = "\n".join(f"é +4930{k:07d} a{k}@b.de" for k in range(20_000))
    docs = frame(spark, rows([text]))
    found = pii.select(pii.propose(docs, keep=["doc_id"]), pii.Model()).first().pii_spans
    assert [(s.kind, s.start, s.end) for s in found] == base(text)
    assert pii.redact(docs, pii.Model()).first().text == "\n".join(["é [PII] [PII]"] * 20_000)


def test_ordered_folds(spark):
    """A running maximum that emits a value twice, once or not at all, over all block borders."""
    from pyspark.sql import functions as F

    from earlybell.llm.common import scan

    def step(carry, x):
        return F.greatest(carry, x), F.array_repeat(F.greatest(carry, x), (x % 3).cast("int"))

    rng = random.Random(2)
    lists = [[rng.randrange(10**6) for _ in range(n)] for n in (0, 1, 3, 4, 15, 16, 17, 64, 65, 1000)]
    data = spark.createDataFrame([(k, v) for k, v in enumerate(lists)], "id int, v array<bigint>")
    got = {r.id: r.out for r in data.select("id", scan(F.col("v"), F.lit(0).cast("long"), step, "bigint", width=4).alias("out")).collect()}
    for k, values in enumerate(lists):
        want, top = [], 0
        for v in values:
            top = max(top, v)
            want += [top] * (v % 3)
        assert got[k] == want


def test_redaction(spark):
    docs = frame(spark, rows(["mail a@b.cd now", None, "", "é +49 30 1234567.", "é" * 2047 + "+49 30 1234567" + "x" * 3000 + "\n a@b.cd"]))
    got = pii.redact(docs, pii.Model())
    assert got.columns == docs.columns
    assert [r.text for r in got.orderBy("doc_id").collect()] == ["mail [PII] now", None, "", "é [PII].", "é" * 2047 + "[PII]" + "x" * 3000 + "\n [PII]"]


def test_empty_documents(spark):
    proposed = pii.propose(empty(spark))
    assert pii.select(proposed, pii.fit(proposed)).count() == 0


FILES = [
    ("a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("a/x.py", "code without a notice"),
    ("a/b/c/y.py", "deep code"),
    ("a/b/z.py", "line\nLicensed under the Apache License, Version 2.0.\n" + "code " * 50),
    ("d/one", "Released under the MIT License."),
    ("d/two", "Licensed under CC BY-NC 4.0."),
    ("d/e/three", "nothing"),
    ("f/four", "nothing at all"),
    ("f/five", "A licence of no known kind is meant here"),
    (None, "Released under the MIT License."),
    (None, None),
    ("a/null", None),
    ("top", "text"),
    ("a/x.py", "code without a notice"),
]


def test_license_scan(spark):
    data = [(k, p, t, "own") for k, (p, t) in enumerate(FILES)]
    files = spark.createDataFrame(data, "id int, path string, text string, status string").repartition(3)
    got = {r.id: (r.license, r.status, r.declared_in) for r in licenses.scan(files).collect()}
    assert got == {
        0: ("MIT", "own", None),
        1: ("MIT", "inherited", "a"),
        2: ("MIT", "inherited", "a"),
        3: ("Apache-2.0", "own", None),
        4: ("MIT", "own", None),
        5: ("CC-BY-NC-4.0", "own", None),
        6: (None, "conflict", "d"),
        7: (None, "none", None),
        8: (None, "none", None),
        9: ("MIT", "own", None),
        10: (None, "none", None),
        11: ("MIT", "inherited", "a"),
        12: (None, "none", None),
        13: ("MIT", "inherited", "a"),
    }


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions:"
)
APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the"
    " License. You may obtain a copy of the License at",
    "    http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
    " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
)
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
    " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution.",
)
NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission.",
)


def wrapped(paragraphs, sign, gap=True):
    """A header of wrapped comment lines above code."""
    import textwrap

    lines = []
    for p in ("Copyright (c) 2020 Some One", *paragraphs):
        lines += [f"{sign} {x}" for x in textwrap.wrap(p, 72)] + [sign]
    return "\n".join(lines) + ("\n\n" if gap else "\n") + "\n".join(f"x{k} = call(y{k}, {k})" for k in range(40))


def test_wrapped_headers_and_whole_texts(spark):
    want = {"MIT": [MIT], "Apache-2.0": APACHE, "GPL-3.0": GPL, "BSD-2-Clause": BSD, "BSD-3-Clause": BSD + NAME}
    files = [(f"{n}/{k}/x.py", wrapped(p, sign, gap), n) for n, p in want.items() for k, (sign, gap) in enumerate([("#", True), ("//", False), (" *", True)])]
    clauses = "\n\n".join(f"{k}. Clause {k} says what this License grants and what the licensor keeps, part {k}." for k in range(60))
    files += [(f"whole/{n}/LICENSE", f"{clauses}\n\n" + "\n\n".join(want[n]), n) for n in ("Apache-2.0", "GPL-3.0")]
    files += [("whole/MIT/LICENSE", f"MIT License\n\nCopyright (c) 2020 Some One\n\n{MIT}", "MIT"), ("clean/x.py", "a = 1\n# plain\nb = 2", None)]
    found = licenses.scan(spark.createDataFrame(files, "path string, text string, want string")).collect()
    assert [(r.path, r.license) for r in found if r.license != r.want] == []


def test_cue_lines_are_compared_with_the_whole_notice(spark):
    """The notice with a line before it is near as well, but its cue line alone is nearer."""
    line = "This work is licensed under the GNU General Public License, version 3."
    files = spark.createDataFrame([("a/x", f"Some words.\n{line}"), ("b/y", line)], "path string, text string")
    assert [(r.license, r.similarity) for r in licenses.scan(files).collect()] == [("GPL-3.0", 1.0)] * 2


def test_license_scan_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).count() == 0
