"""Language identification: averaged hashed subword embeddings, linear softmax.

Byte n-grams of two to four characters within words (with their borders) are hashed
into an embedding table; a text is their average, and a linear softmax names the
language. Table and softmax are trained together by stochastic gradient descent in
numpy on stretches of sampled training texts. Scores are calibrated by a temperature,
and a rejection threshold by the wanted accuracy among accepted stretches, both on
training texts that were put aside.

Training reads a bounded sample: at most ``per_language`` rows a language, found by a
hash of the id, each cut to a stretch of ``max_chars`` at a place that the hash gives.
Prediction reads every text whole.

* null text, or none with a letter: ``und``, score 0, rejected
* no training row at all: ``und`` for every text
* repeated documents are predicted row by row; a tie goes to the first language by name
* an input column named like a result column gives way to it
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from earlybell.llm.common import annotate, blobs, unit_hash

UNKNOWN = "und"
FIELDS = [
    StructField("lang_pred", StringType()),
    StructField("score", DoubleType()),
    StructField("rejected", BooleanType()),
]
# Bytes of words: letters in lower case and everything beyond ASCII; the rest separates.
WORD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    per_language: int = 1000
    max_chars: int = 20_000
    #: training rows of all languages together; where there are many, each has fewer
    rows: int = 1_000_000
    buckets: int = 1 << 16
    size: int = 16
    epochs: int = 3
    batch: int = 64
    rate: float = 1.0
    accuracy: float = 0.99
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: logits of each bucket: embedding times softmax weights
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def normal(text: bytes) -> bytes:
    """Lower-case words between single spaces."""
    return b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().translate(WORD).split()) + b" "


def grams(words: bytes, buckets: int) -> np.ndarray:
    """Buckets (a power of two of them) of the n-grams of 2, 3 and 4 bytes that no word border crosses."""
    b = np.frombuffer(words, np.uint8).astype(np.uint32)
    out = []
    for n in (2, 3, 4):
        if len(b) < n:
            break
        stop = len(b) - n + 1
        h = np.full(stop, n, np.uint32)
        inside = np.ones(stop, bool)
        for k in range(n):
            h = h * np.uint32(0x01000193) ^ b[k : k + stop]
            if 0 < k < n - 1:
                inside &= b[k : k + stop] != 32
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x85EBCA6B) >> np.uint32(8))[inside] & np.uint32(buckets - 1))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def has_letter(words: bytes) -> bool:
    if any(97 <= c <= 122 for c in words[:64]) or any(97 <= c <= 122 for c in words):
        return True
    return any(c.isalpha() for c in words.decode("utf-8", "replace"))


def training_rows(docs: DataFrame, settings: Settings, text: str, lang: str, doc_id: str) -> list[tuple[str, str]]:
    """A bounded sample of (language, text): the ids' hashes decide."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = usable.groupBy(F.col(lang).alias("lang")).count().collect()
    if not sizes:
        return []
    wanted = max(1, min(settings.per_language, settings.rows // len(sizes)))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], wanted / r["count"])])
    spare = F.greatest(F.char_length(text) - settings.max_chars, F.lit(0))
    at = F.pmod(F.xxhash64(F.lit("stretch"), F.col(doc_id)), spare + 1).cast("int")
    stretch = F.col(text).substr(at + 1, F.lit(settings.max_chars))
    rows = usable.where(unit_hash(doc_id) < share[F.col(lang)]).select(F.col(lang), stretch)
    return sorted(map(tuple, rows.limit(2 * wanted * len(sizes)).collect()))


def _stretches(rows: list[tuple[str, str]], settings: Settings, rng: np.random.Generator) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Stretches of 3 to 60 words with their language's number, and whether they are put aside."""
    names = sorted({r[0] for r in rows})
    number = {n: k for k, n in enumerate(names)}
    examples, labels, aside = [], [], []
    for lang, text in dict.fromkeys(rows):
        words = normal(text.encode()).split()
        held = rng.random() < 0.2
        for _ in range(3 if words else 0):
            n = int(rng.integers(3, 61))
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            found = grams(b" " + b" ".join(words[at : at + n]) + b" ", settings.buckets)
            if len(found):
                examples.append(found)
                labels.append(number[lang])
                aside.append(held)
    return examples, np.asarray(labels, np.int64), np.asarray(aside, bool)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, str]], settings: Settings = Settings()) -> Model:
    """Fit embeddings and softmax by gradient descent; calibrate on stretches put aside."""
    rng = np.random.default_rng(settings.seed)
    names = sorted({r[0] for r in rows})
    examples, labels, aside = _stretches(rows, settings, rng)
    classes = len(names)
    if not examples:
        return Model(names, np.zeros((settings.buckets, classes), np.float32), np.zeros(classes), 1.0, 0.0)
    emb = rng.uniform(-0.5, 0.5, (settings.buckets, settings.size)) / settings.size
    weights, bias = np.zeros((settings.size, classes)), np.zeros(classes)
    fit = np.flatnonzero(~aside)
    steps, step = max(1, settings.epochs * -(-len(fit) // settings.batch)), 0
    for _ in range(settings.epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), settings.batch):
            chosen = fit[at : at + settings.batch]
            ids = np.concatenate([examples[i] for i in chosen])
            sizes = np.asarray([len(examples[i]) for i in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(emb[ids], starts, axis=0) / sizes[:, None]
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            rate = settings.rate * (1 - step / steps)
            back = error @ weights.T / sizes[:, None]
            weights -= rate * mean.T @ error / len(chosen) * 8
            bias -= rate * error.mean(axis=0)
            unique, where = np.unique(ids, return_inverse=True)
            owner = np.repeat(np.arange(len(chosen)), sizes)
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(len(unique)))
            emb[unique] -= rate * np.add.reduceat(back[owner[order]], cuts, axis=0) * 8
            step += 1
    table = (emb @ weights).astype(np.float32)
    return _calibrated(names, table, bias, [examples[i] for i in np.flatnonzero(aside)], labels[aside], settings)


def _calibrated(names, table, bias, examples, labels, settings: Settings) -> Model:
    """Temperature of least loss, and the lowest score that keeps the wanted accuracy."""
    if not len(examples):
        return Model(names, table, bias, 1.0, 0.0)
    logits = np.stack([table[x].mean(axis=0) for x in examples]) + bias
    loss = {
        t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean()
        for t in np.geomspace(0.05, 20, 60)
    }
    t = min(loss, key=loss.get)
    p = _softmax(logits / t)
    score, right = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-score)
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(accuracy >= settings.accuracy)
    return Model(names, table, bias, float(t), float(score[order][enough[-1]]) if len(enough) else 1.0)


def _compute(column: pa.Array, model: Model) -> list[list]:
    names, scores, rejected = [], [], []
    for text in blobs(column):
        words = normal(text)
        if not model.languages or not has_letter(words):
            names.append(UNKNOWN)
            scores.append(0.0)
            rejected.append(True)
            continue
        found = grams(words, len(model.table))
        if len(found) <= len(model.table):
            total = model.table[found].sum(axis=0, dtype=np.float64)
        else:  # no more rows than buckets are gathered
            buckets, times = np.unique(found, return_counts=True)
            total = times @ model.table[buckets]
        mean = total / max(1, len(found))
        p = _softmax(((mean + model.bias) / model.temperature)[None])[0]
        k = int(p.argmax())
        names.append(model.languages[k])
        scores.append(float(p[k]))
        rejected.append(bool(p[k] < model.threshold))
    return [names, scores, rejected]


def fit(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """A model of the given training documents (whoever calls leaves held-out ones away)."""
    return train(training_rows(docs, settings, text, lang, doc_id), settings)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with lang_pred, score and rejected. No shuffle; the model, of a fixed number
    of buckets times languages, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text, FIELDS, lambda column: _compute(column, shared.value), keep)
