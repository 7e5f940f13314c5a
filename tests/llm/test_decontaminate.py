import random
import re

from earlybell.llm import decontaminate
from tests.llm.cases import AWKWARD, empty, frame, prose, rows

ITEMS = "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(texts, items, size=10):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            i = words(body)
            k = min(size, len(i))
            wanted = {tuple(i[a : a + k]) for a in range(len(i) - k + 1)} if i else set()
            for a in range(len(w) - k + 1):
                if k and tuple(w[a : a + k]) in wanted:
                    hit |= set(range(a, a + k))
                    found |= {str(item)} if item is not None else set()
        out.append((len(w), len(hit), sorted(found)))
    return out


def table():
    rng = random.Random(3)
    items = [(k, prose(rng, n)) for k, n in enumerate([12, 30, 10, 9, 3, 1, 0, 25])]
    items += [(None, "nameless item of a few words"), (11, None), (12, items[1][1]), (0, items[0][1])]
    texts = list(AWKWARD)
    for k in range(40):
        body = prose(rng, 60)
        if k % 3:
            i = words(items[k % 8][1])
            body += ".\nÜber " + ", ".join(i[: 10 + k % 5]).upper() + "! " + prose(rng, 5)
        texts.append(body)
    texts += [texts[-1], "So NAMELESS: item-of a few words"]
    return texts, items


def test_marks_equal_brute_force(spark):
    texts, items = table()
    docs, bench = frame(spark, rows(texts)), spark.createDataFrame(items, ITEMS)
    got = decontaminate.mark(docs, bench, keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.hit_items) for r in got] == brute(texts, items)
    for r in got:  # spans are whole words of the original text
        inside = [w for s in r.hit_spans for w in words(texts[r.doc_id][s.start : s.end])]
        assert len(inside) == r.n_hit


def test_several_blocks_give_the_same(spark, monkeypatch):
    texts, items = table()
    docs, bench = frame(spark, rows(texts)), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 150)
    got = decontaminate.mark(docs, bench, keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.hit_items) for r in got] == brute(texts, items)


def test_clean_keeps_columns_and_clean_rows(spark):
    texts, items = table()
    docs, bench = frame(spark, rows(texts)), spark.createDataFrame(items, ITEMS)
    got = decontaminate.clean(docs, bench)
    assert got.columns == docs.columns
    want = {k for k, (_, hit, _) in enumerate(brute(texts, items)) if not hit}
    kept = got.collect()
    assert {r.doc_id for r in kept} == want
    assert all(r.n_words == "own" and r.text == texts[r.doc_id] for r in kept)


def test_empty_tables(spark):
    texts, items = table()
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.mark(empty(spark), spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontaminate.clean(frame(spark, rows(texts)), none).count() == len(texts)
