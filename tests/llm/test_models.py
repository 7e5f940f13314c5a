"""Operators with trained models: held-out accuracy, and the awkward inputs."""

import random

import numpy as np
import pytest

from earlybell.llm import language, toxicity
from earlybell.llm.common import held_out
from tests.llm.cases import AWKWARD, empty, frame, learns, rows

SYLLABLES = {"aa": ["the", "ing", "er", "on", "wh", "sh"], "bb": ["que", "eau", "é", "ai", "tion", "oi"], "cc": ["ung", "sch", "ß", "keit", "ä", "ver"]}
TOXIC = ["zonk", "blarg", "frimp"]


def word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5)))


def corpus(n=400):
    rng = random.Random(2)
    texts, langs, labels = list(AWKWARD), [None] * len(AWKWARD), []
    for k in range(n):
        lang = sorted(SYLLABLES)[k % 3]
        words = [word(rng, lang) for _ in range(rng.randrange(10, 80))]
        toxic = int(k % 7 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(TOXIC))
        texts.append(" ".join(words[:7]).capitalize() + ".\n" + ", ".join(words[7:]))
        langs.append(lang)
        labels.append((len(texts) - 1, toxic))
    return texts, langs, labels


@pytest.fixture(scope="module")
def data(spark):
    texts, langs, labels = corpus()
    return texts, langs, labels, frame(spark, rows(texts, lang=langs))


def test_held_out_fold(spark):
    got = spark.createDataFrame([(k,) for k in [*range(200), None]], "doc_id bigint").select("doc_id", held_out().alias("h"))
    assert all(r.h == (r.doc_id is not None and not learns(r.doc_id)) for r in got.collect())


def test_language_of_held_out_texts(spark, data):
    texts, langs, _, docs = data
    model = language.fit(docs.where(~held_out()))
    assert model.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language.identify(docs, model, keep=["doc_id"]).collect()}
    held = [k for k, x in enumerate(langs) if x and not learns(k)]
    assert np.mean([got[k].lang_pred == langs[k] for k in held]) > 0.97
    for k, t in enumerate(AWKWARD):
        lettered = any(c.isalpha() for c in t or "")
        assert (got[k].lang_pred == "und") == (not lettered)
        assert 0 <= got[k].score <= 1


def test_language_of_long_texts_only(spark):
    rng = random.Random(9)
    long = [" ".join(word(rng, "bb") for _ in range(4500)) for _ in range(100)]
    short = [" ".join(word(rng, "aa") for _ in range(50)) for _ in range(200)]
    assert min(map(len, long)) > language.Settings.max_chars
    docs = frame(spark, rows([*long, *short], lang=["bb"] * 100 + ["aa"] * 200))
    model = language.fit(docs)
    assert model.languages == ["aa", "bb"]
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, model, keep=["doc_id"]).collect()}
    assert all(got[k] == ("bb" if k < 100 else "aa") for k in got)
    taken = language.training_rows(docs, language.Settings(), "text", "lang", "doc_id")
    assert {len(t) for n, t in taken if n == "bb"} == {language.Settings.max_chars}


def test_every_language_is_learned(spark):
    """However many there are: then each has fewer rows, and none is left out."""
    docs = frame(spark, rows([f"text {k}" for k in range(90)], lang=[f"l{k % 30:02}" for k in range(90)]))
    taken = language.training_rows(docs, language.Settings(per_language=100, rows=60), "text", "lang", "doc_id")
    assert len(taken) <= 120
    assert len({n for n, _ in language.training_rows(docs, language.Settings(rows=90), "text", "lang", "doc_id")}) == 30


def plain_prediction(text, model):
    """Average, softmax and temperature, gram by gram."""
    words = b" " + b" ".join("".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).encode().split()) + b" "
    total, count = np.zeros(len(model.languages)), 0
    for n in (2, 3, 4):
        for at in range(len(words) - n + 1):
            gram = words[at : at + n]
            if 32 in gram[1:-1]:
                continue
            h = n
            for b in gram:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ b
            h ^= h >> 15
            total += model.table[(h * 0x85EBCA6B & 0xFFFFFFFF) >> 8 & (len(model.table) - 1)]
            count += 1
    z = (total / max(1, count) + model.bias) / model.temperature
    e = np.exp(z - z.max())
    return model.languages[int(e.argmax())], float(e.max() / e.sum())


def test_language_scores_equal_brute_force(spark, data):
    texts, _, _, docs = data
    small = language.fit(docs.where(~held_out()), language.Settings(buckets=256, epochs=1))  # long texts have more grams
    for r in language.identify(docs, small, keep=["doc_id"]).collect():
        if texts[r.doc_id] and r.lang_pred != "und":
            want, score = plain_prediction(texts[r.doc_id], small)
            assert abs(r.score - score) < 1e-5
            assert r.lang_pred == want or score < 0.51


def test_toxicity_learns_from_long_texts_only(spark):
    rng = random.Random(12)
    texts, labels = [], []
    for k in range(120):
        words = [word(rng, "aa") for _ in range(2600)]
        if toxic := int(k % 3 == 0):
            for at in range(0, len(words), 40):
                words[at] = rng.choice(TOXIC)
        texts.append("\n".join(" ".join(words[i : i + 20]) for i in range(0, len(words), 20)))
        labels.append((k, toxic))
    assert min(map(len, texts)) > toxicity.Settings.max_chars
    docs = frame(spark, rows(texts))
    known = spark.createDataFrame([*labels, (0, 7)], "doc_id bigint, toxic int").where(~held_out())
    model = toxicity.fit(docs, known)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    held = [(k, x) for k, x in labels if not learns(k)]
    assert np.mean([(got[k] >= 0.7) == bool(x) for k, x in held]) > 0.9


def test_language_without_training_rows(spark):
    assert language.identify(empty(spark), language.fit(empty(spark))).count() == 0
    model = language.fit(empty(spark))
    got = language.identify(frame(spark, rows(["some text"])), model).first()
    assert (got.lang_pred, got.score, got.rejected) == ("und", 0.0, True)


def test_toxicity_of_held_out_texts(spark, data):
    texts, _, labels, docs = data
    known = spark.createDataFrame([*labels, (None, 1), (5, None), labels[0]], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known.where(~held_out()))
    got = {r.doc_id: r for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    right, agrees, found = [], [], []
    for k, toxic in labels:
        assert 0 <= got[k].score <= 1
        spans = [texts[k][s.start : s.end].lower() for s in got[k].toxic_spans]
        if not learns(k):
            found.append((got[k].score >= 0.7) == bool(toxic))
            agrees.append(bool(spans) == bool(toxic))
        right += [any(t in s for t in TOXIC) for s in spans]
    assert min(np.mean(x) for x in (right, agrees, found)) > 0.95
    for k in range(len(AWKWARD)):
        assert got[k].score < 0.7 and got[k].toxic_spans == []


def test_shared_passages_are_no_copies():
    rng = random.Random(6)
    passage = " ".join(word(rng, "aa") for _ in range(25))
    texts = [f"{passage} " + " ".join(word(rng, "bb") for _ in range(100)) for _ in range(60)]
    mixed = [(t, k % 2) for k, t in enumerate(texts)]
    copies = [(t + " end", k % 2) for k, t in enumerate(texts)]
    relabelled = [(texts[0], 1)]
    got = toxicity._without_copies([*mixed, *copies, *relabelled])
    assert [label for _, label in got] == [label for _, label in [*mixed, *relabelled]]


def test_logistic_is_fitted_on_documents_put_aside(monkeypatch):
    texts, _, labels = corpus()
    sizes = {}
    monkeypatch.setattr(toxicity, "_fit_field", lambda model, chains, *_: sizes.update(field=len(chains)))
    monkeypatch.setattr(toxicity, "_fit_logistic", lambda model, docs, share: sizes.update(logistic=len(docs)))
    toxicity.train([(texts[k], toxic) for k, toxic in labels], 0.15)
    assert 0.2 < sizes["logistic"] / len(labels) < 0.4


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(empty(spark), none)
    assert toxicity.score(frame(spark, rows(["a b", None])), model).count() == 2


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(2, 5)), rng.normal(size=(2, 2))
    sizes = np.asarray([5, 3])
    got, pairs, log_z = toxicity.marginals(scores, sizes, moves)
    want_pairs, want_z = np.zeros((2, 2)), 0.0
    for row, n in enumerate(sizes):
        total, ones, moved = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            tags = [(code >> t) & 1 for t in range(n)]
            w = np.exp(sum(scores[row, t] for t in range(n) if tags[t]) + sum(moves[a, b] for a, b in zip(tags, tags[1:], strict=False)))
            total += w
            ones += w * np.asarray(tags)
            for a, b in zip(tags, tags[1:], strict=False):
                moved[a, b] += w
        assert np.allclose(got[row, :n], ones / total)
        want_pairs += moved / total
        want_z += np.log(total)
    assert np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_posteriors_equal_marginals():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(1, 9, 60))
    scores, moves = rng.normal(size=(60, 8)), rng.normal(size=(2, 2))
    want, _, _ = toxicity.marginals(scores, sizes, moves)
    inside = np.arange(8)[None] < sizes[:, None]
    got = toxicity.posteriors(scores.T.copy(), sizes, moves).T
    assert np.allclose(got[inside], want[inside])


def test_features_depend_on_the_word_alone():
    words = [b"zonk", "é".encode(), b"wonderfully", b"a"]
    together = toxicity.features(words)
    for k, w in enumerate(words):
        whole, parts, _ = toxicity.features([w])
        assert whole[0] == together[0][k]
        assert sorted(parts) == sorted(together[1][together[2] == k])


def test_spans_map_to_the_original_text():
    text = "İİ a Zonk, b\nzonk"
    chains = list(toxicity.lines_of_words(text))
    mass = np.asarray([1.0 if w == b"zonk" else 0.0 for c in chains for w in c])
    assert [text[s["start"] : s["end"]] for s in toxicity.spans_of(text, mass)] == ["Zonk", "zonk"]
