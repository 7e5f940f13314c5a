"""Toxic spans by a linear-chain conditional random field.

Training sees documents with a yes/no label only, so token labels are made first:
words and word beginnings that documents labelled toxic hold significantly more often
(a likelihood-ratio test on document counts, near copies counted once) mark toxic tokens
there. The field has two tags and features of the word, its letter trigrams and
beginnings, and its neighbours; it is
fitted by gradient steps on the exact likelihood from the forward-backward pass. In
every text, forward-backward marginals of chains (lines, cut after CHAIN words) give
each word's probability; spans are runs of words above one half, and a logistic on the
summed and the largest toxic mass, fitted on documents put aside, is the score.

Training reads a bounded sample: at most ``per_class`` rows of each label, found by a
hash of the id, each cut to a stretch of ``max_chars`` at a place that the hash gives. Scoring reads every text whole.

* null, empty or wordless text: no span, the score of no toxic mass
* no label of one of the classes: every score is the share of toxic labels
* contradicting labels of one id: toxic wins; null ids and labels are no labels
* repeated documents are scored row by row
* an input column named like a result column gives way to it
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from earlybell.llm.common import annotate, mix, texts, unit_hash

CHAIN = 64
BUCKETS = 1 << 16
#: A mark is so many times more frequent in toxic documents, at least.
PURITY = 20
#: Lengths of word beginnings that can be marks and features.
STEMS = (5, 6, 7, 8)
CACHE_WORDS = 400_000
SPAN = StructType(
    [StructField("start", LongType(), False), StructField("end", LongType(), False), StructField("probability", DoubleType(), False)]
)
FIELDS = [StructField("score", DoubleType()), StructField("toxic_spans", ArrayType(SPAN, False))]
# ASCII digits and letters belong to words, as does everything beyond ASCII; lines stay.
_SEPARATOR = {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) != "\n"}
_SEPARATED = bytes(32 if b in _SEPARATOR else b for b in range(256))

#: Near copies share so much of their runs of words; hashes that find them.
COPY = 0.8
SALTS = 32


@dataclass(frozen=True)
class Settings:
    per_class: int = 2500
    max_chars: int = 8_000
    #: likelihood ratio that makes a word a toxic one
    significance: float = 18.0
    #: chains without a toxic token in the field's training, for each one with such
    others: int = 6
    steps: int = 80
    rate: float = 0.5
    #: weight decay of words and their parts, and of what words say of their neighbours
    penalty: float = 0.2
    neighbour_penalty: float = 5.0
    seed: int = 7


@dataclass
class Field:
    """Weights of the tag "toxic" against the other one, and of tag changes."""

    word: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    part: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    before: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    after: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = -3.0
    #: moves[a, b]: from tag a to tag b
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: logistic on what ``summary`` gives
    logistic: np.ndarray = field(default_factory=lambda: np.zeros(3))


def lines_of_words(text: str) -> Iterator[list[bytes]]:
    """Words in lower case, line by line, in chains of at most CHAIN words."""
    for line in text.lower().encode("utf-8", "replace").translate(_SEPARATED).split(b"\n"):
        words = line.split()
        for at in range(0, len(words), CHAIN):
            yield words[at : at + CHAIN]


def beginnings(word: bytes) -> list[bytes]:
    return [word[:n] + b"~" for n in STEMS if n < len(word)]


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The base's powers and their inverses modulo 2^64, n of each at least."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.multiply.accumulate(factors)
    return _POWERS


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words; those of their parts (trigrams of ^word$ and beginnings), with each part's word.

    Every hash is the difference of two prefix sums, so all words are hashed at once.
    """
    text = b"".join(b"^" + w + b"$" for w in words)
    power, inverse = _powers(len(text) + 1)
    letters = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * power[: len(letters)])])

    def hashed(start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        h = (sums[end] - sums[start]) * inverse[start] + np.uint64(salt)
        return (mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64)

    sizes = np.asarray([len(w) for w in words], np.int64) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    at = np.arange(len(text))
    owner = np.repeat(np.arange(len(words)), sizes)
    inner = at + 3 <= ends[owner]
    parts, owners = [hashed(at[inner], at[inner] + 3, 3)], [owner[inner]]
    for n in STEMS:
        long = np.flatnonzero(sizes - 2 > n)
        parts.append(hashed(starts[long], starts[long] + 1 + n, 7))
        owners.append(long)
    return hashed(starts, ends, 1), np.concatenate(parts), np.concatenate(owners)


class Words:
    """Number and feature scores of the words met; starts anew when full."""

    def __init__(self, model: Field) -> None:
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.scores = np.zeros((0, 3))

    def ids(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        fresh = list(dict.fromkeys(w for w in words if w not in number))
        if fresh:
            number.update(zip(fresh, range(len(number), len(number) + len(fresh)), strict=True))
            self.scores = np.concatenate([self.scores, word_scores(self.model, fresh)])
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def word_scores(model: Field, words: list[bytes]) -> np.ndarray:
    """Each word's own score, and what it says of its successor and its predecessor."""
    whole, parts, owner = features(words)
    share = np.bincount(owner, model.part[parts], len(words)) / np.bincount(owner, minlength=len(words))
    return np.stack([model.word[whole] + share, model.before[whole], model.after[whole]], axis=1)


def marginals(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over chains in the rows of ``scores``: the log-odds of "toxic" at each
    word. Gives each word's marginal, the expected tag changes, and the log partition sum."""
    n, width = scores.shape
    trans = np.exp(moves)
    emit = np.stack([np.ones_like(scores), np.exp(np.clip(scores, -30, 30))], axis=2)
    alpha, scale = np.empty((n, width, 2)), np.ones((n, width))
    for t in range(width):
        a = emit[:, t] if t == 0 else (alpha[:, t - 1] @ trans) * emit[:, t]
        live = t < sizes
        total = np.where(live, a.sum(axis=1), 1.0)
        alpha[:, t] = np.where(live[:, None], a / total[:, None], alpha[:, t - 1] if t else a)
        scale[:, t] = total
    beta, pairs = np.ones((n, 2)), np.zeros((2, 2))
    out = np.zeros((n, width))
    for t in range(width - 1, -1, -1):
        gamma = alpha[:, t] * beta
        gamma /= gamma.sum(axis=1, keepdims=True)
        out[:, t] = np.where(t < sizes, gamma[:, 1], 0.0)
        if t:
            live = (t < sizes)[:, None]
            message = emit[:, t] * beta
            xi = alpha[:, t - 1][:, :, None] * trans[None] * message[:, None, :]
            xi /= xi.sum(axis=(1, 2), keepdims=True)
            pairs += (xi * live[:, :, None]).sum(axis=0)
            down = message @ trans.T
            beta = np.where(live, down / down.sum(axis=1, keepdims=True), beta)
    return out, pairs, float(np.log(scale).sum())


def posteriors(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The marginals alone, by ratios of the two tags' messages; chains ascend by size.

    ``scores`` has a row per position. At each position only the chains that reach it are
    worked on: the last ones.
    """
    (m00, m01), (m10, m11) = np.exp(moves)
    emit = np.exp(np.clip(scores, -30, 30))
    width = len(scores)
    first = np.searchsorted(sizes, np.arange(width), side="right")  # chains before it end earlier
    ahead = emit  # becomes the forward ratios, in place
    for t in range(1, width):
        r = ahead[t - 1, first[t] :]
        ahead[t, first[t] :] *= (m01 + r * m11) / (m00 + r * m10)
    out = np.zeros_like(scores)
    raw = np.exp(np.clip(scores, -30, 30))
    back = np.ones(scores.shape[1])
    for t in range(width - 1, -1, -1):
        odds = ahead[t, first[t] :] * back[first[t] :]
        out[t, first[t] :] = odds / (1 + odds)
        x = raw[t, first[t] :] * back[first[t] :]
        back[first[t] :] = (m10 + m11 * x) / (m00 + m01 * x)
    return out


def _padded(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), int(sizes.max())))
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = flat
    return out


def _shifted(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each word's predecessor and successor in its chain, -1 where there is none."""
    at = np.arange(len(ids))
    ends = np.cumsum(sizes)
    before, after = at - 1, at + 1
    before[ends - sizes] = -1
    after[ends - 1] = -1
    return before, after


def chain_scores(own: np.ndarray, left: np.ndarray, right: np.ndarray, sizes: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds per word: its own, what its predecessor and its successor say, the bias."""
    before, after = _shifted(own, sizes)
    return own + bias + np.where(before >= 0, left[before], 0) + np.where(after >= 0, right[after], 0)


# --- training ---------------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings, text: str, doc_id: str) -> tuple[list[tuple[str, int]], float]:
    """A bounded sample of (text, label) and the share of toxic labels among all."""
    one = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    if not total:
        return [], 0.0
    share = F.when(F.col("toxic") == 1, settings.per_class / max(1, sizes.get(1, 0))).otherwise(
        settings.per_class / max(1, sizes.get(0, 0))
    )
    # at most twice the wanted number by this limit, so the broadcast is bounded
    chosen = one.where(unit_hash("doc_id") < share).limit(4 * settings.per_class)
    spare = F.greatest(F.char_length(text) - settings.max_chars, F.lit(0))
    at = F.pmod(F.xxhash64(F.lit("stretch"), F.col(doc_id)), spare + 1).cast("int")
    stretch = F.col(text).substr(at + 1, F.lit(settings.max_chars))
    body = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), stretch.alias("body"))
    rows = (
        body.join(F.broadcast(chosen), "doc_id")
        .select("body", "toxic")
        .limit(4 * settings.per_class)
    )
    return sorted((r[0], int(r[1])) for r in rows.collect()), sizes.get(1, 0) / total


def _without_copies(rows: list[tuple[str, int]]) -> list[tuple[list[list[bytes]], int]]:
    """Tokenised rows; of those with one label that share most of their runs of four words, one.

    Rows whose least hashes agree under half of the salts are compared by the runs themselves.
    """
    salts = (np.random.default_rng(0).integers(0, 1 << 31, SALTS, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
    kept: dict[int, list[set[int]]] = {0: [], 1: []}
    least = {label: np.empty((len(rows), SALTS), np.uint32) for label in kept}
    out = []
    for text, label in rows:
        chains = list(lines_of_words(text))
        runs = {zlib.crc32(b" ".join(c[i : i + 4])) for c in chains for i in range(len(c) - 3)}
        if runs:
            hashes = np.fromiter(runs, np.uint64, len(runs))
            own = ((hashes * salts) & np.uint64(0xFFFFFFFF)).min(axis=1).astype(np.uint32)
            before = kept[label]
            like = np.flatnonzero((least[label][: len(before)] == own).sum(axis=1) * 2 >= SALTS)
            if any(len(runs & before[k]) >= COPY * len(runs | before[k]) for k in like):
                continue
            least[label][len(before)] = own
            before.append(runs)
        out.append((chains, label))
    return out


def toxic_words(rows: list[tuple[list[list[bytes]], int]], significance: float) -> set[bytes]:
    """Words and beginnings (with ~) significantly more frequent in toxic documents, by document counts."""
    n = Counter(label for _, label in rows)
    hits: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for chains, label in rows:
        words = {w for c in chains for w in c}
        hits[label].update(words | {x for w in words for x in beginnings(w)})
    total = n[0] + n[1]
    out = set()
    for w, a in hits[1].items():
        b = hits[0][w]
        if a * n[0] <= PURITY * b * n[1]:
            continue
        ratio = 0.0
        for seen, size in ((a, n[1]), (n[1] - a, n[1]), (b, n[0]), (n[0] - b, n[0])):
            expected = size * ((a + b) if seen in (a, b) and (seen, size) in ((a, n[1]), (b, n[0])) else total - a - b) / total
            if seen and expected:
                ratio += 2 * seen * math.log(seen / expected)
        if ratio >= significance:
            out.add(w)
    return out


def is_marked(word: bytes, marked: set[bytes]) -> bool:
    return word in marked or not marked.isdisjoint(beginnings(word))


def train(rows: list[tuple[str, int]], share: float, settings: Settings = Settings()) -> Field:
    model = Field()
    docs = _without_copies(rows)
    if {label for _, label in docs} != {0, 1}:
        model.logistic[0] = math.log(max(share, 1e-3) / max(1 - share, 1e-3))
        return model
    rng = np.random.default_rng(settings.seed)
    aside = rng.random(len(docs)) < 0.3
    marked = toxic_words([d for d, x in zip(docs, aside, strict=True) if not x], settings.significance)
    chains = [(c, label == 1) for (d, label), x in zip(docs, aside, strict=True) if not x for c in d]
    with_toxic = [c for c in chains if c[1] and any(is_marked(w, marked) for w in c[0])]
    others = [c for c in chains if not (c[1] and any(is_marked(w, marked) for w in c[0]))]
    rng.shuffle(others)
    _fit_field(model, [*with_toxic, *others[: max(2000, settings.others * len(with_toxic))]], marked, settings)
    rest = [d for d, x in zip(docs, aside, strict=True) if x]
    # too few to have both labels put aside: better all than none
    _fit_logistic(model, rest if {label for _, label in rest} == {0, 1} else docs, share)
    return model


def _fit_field(model: Field, chains: list[tuple[list[bytes], bool]], marked: set[bytes], settings: Settings) -> None:
    """Gradient steps with a running scale per weight, on the exact log-likelihood of chains,
    each with the mark of its document."""
    vocabulary = sorted({w for c, _ in chains for w in c})
    if not vocabulary:
        return
    number = {w: k for k, w in enumerate(vocabulary)}
    hashes, parts, owner = features(vocabulary)
    n_parts = np.bincount(owner, minlength=len(vocabulary))
    words = np.asarray([number[w] for c, _ in chains for w in c])
    tags = np.asarray([float(toxic and is_marked(w, marked)) for c, toxic in chains for w in c])
    sizes = np.asarray([len(c) for c, _ in chains])
    before, after = _shifted(words, sizes)
    inner = before >= 0
    observed = np.zeros((2, 2))
    np.add.at(observed, (tags[before[inner]].astype(int), tags[inner].astype(int)), 1)
    squares: dict[str, np.ndarray | float] = {}

    def step(name: str, value, gradient):
        decay = settings.neighbour_penalty if name in ("before", "after") else settings.penalty
        gradient = gradient - decay * value
        squares[name] = squares.get(name, 0) + gradient**2
        return value + settings.rate * gradient / np.sqrt(squares[name] + 1e-8)

    def per_bucket(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.bincount(at, values, BUCKETS)

    for _ in range(settings.steps):
        own = model.word[hashes] + np.bincount(owner, model.part[parts], len(vocabulary)) / n_parts
        scores = chain_scores(own[words], model.before[hashes][words], model.after[hashes][words], sizes, model.bias)
        got, pairs, _ = marginals(_padded(scores, sizes), sizes, model.moves)
        rest = tags - got[np.arange(got.shape[1])[None] < sizes[:, None]]
        by_word = np.bincount(words, rest, len(vocabulary))
        as_before = np.bincount(words[before[inner]], rest[inner], len(vocabulary))
        follows = after >= 0
        as_after = np.bincount(words[after[follows]], rest[follows], len(vocabulary))
        model.word = step("word", model.word, per_bucket(by_word, hashes))
        model.part = step("part", model.part, per_bucket((by_word / n_parts)[owner], parts))
        model.before = step("before", model.before, per_bucket(as_before, hashes))
        model.after = step("after", model.after, per_bucket(as_after, hashes))
        model.bias = float(step("bias", model.bias, rest.sum()))
        model.moves = step("moves", model.moves, observed - pairs)


def _mass(model: Field, docs: list[list[list[bytes]]]) -> list[np.ndarray]:
    """Marginals of each document's words."""
    table = Words(model)
    chains = [c for d in docs for c in d]
    counts = [sum(map(len, d)) for d in docs]
    flat = _marginals_of(model, table, chains)
    return np.split(flat, np.cumsum(counts)[:-1]) if docs else []


def _marginals_of(model: Field, table: Words, chains: list[list[bytes]]) -> np.ndarray:
    """Marginals of all words of chains, in order."""
    if len(table.number) > CACHE_WORDS:
        table.reset()
    if not chains:
        return np.zeros(0)
    ids = table.ids([w for c in chains for w in c])
    sizes = np.asarray([len(c) for c in chains])
    own, left, right = table.scores[ids].T
    scores = chain_scores(own, left, right, sizes, model.bias)
    out = np.empty(len(ids))
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")  # chains of like length together
    for at in range(0, len(order), 4096):
        rows = order[at : at + 4096]
        n = sizes[rows]
        place = np.arange(int(n[-1]))[:, None]
        inside = place < n
        where = np.where(inside, starts[rows] + place, 0)
        got = posteriors(np.where(inside, scores[where], 0.0), n, model.moves)
        out[where[inside]] = got[inside]
    return out


def summary(mass: np.ndarray) -> tuple[float, float, float]:
    """What the logistic sees of a document: 1, log of the mass of words above one half, largest
    marginal. Small marginals stay out, or any text would turn toxic with its length."""
    if not len(mass):
        return 1.0, 0.0, 0.0
    return 1.0, math.log1p(float(mass[mass > 0.5].sum())), float(mass.max())


def _fit_logistic(model: Field, docs, share: float) -> None:
    """Newton steps with a small ridge; rows weigh by the classes' true shares."""
    x = np.asarray([summary(m) for m in _mass(model, [d for d, _ in docs])])
    y = np.asarray([label for _, label in docs], float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - 0.05 * w * [0, 1, 1]
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.diag([1e-6, 1, 1])
        change = np.linalg.solve(hessian, gradient)
        w += change
        if np.abs(change).max() < 1e-8:
            break
    model.logistic = w


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), text: str = "text", doc_id: str = "doc_id") -> Field:
    """A field of the given labels (whoever calls leaves held-out ones away)."""
    rows, share = training_rows(docs, labels, settings, text, doc_id)
    return train(rows, share, settings)


# --- scoring ----------------------------------------------------------------------------


def spans_of(text: str, mass: np.ndarray) -> list[dict]:
    """Runs of words above one half, as code-point spans of the text."""
    lowered = text.lower()
    if len(lowered) != len(text):  # some letters grow in lower case: map letter by letter
        places = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    else:
        places = range(len(text) + 1)
    found, at, k = [], 0, 0
    plain = lowered.translate(_SEPARATOR)
    for line in plain.split("\n"):
        column = 0
        for word in line.split(" "):
            if word:
                if mass[k] > 0.5:
                    a, b = at + column, at + column + len(word)
                    if found and found[-1][2] == k - 1:
                        found[-1] = (found[-1][0], b, k, max(found[-1][3], float(mass[k])))
                    else:
                        found.append((a, b, k, float(mass[k])))
                k += 1
            column += len(word) + 1
        at += len(line) + 1
    return [{"start": places[a], "end": places[b], "probability": p} for a, b, _, p in found]


_TABLES: dict[str, Words] = {}


def _compute(column: pa.Array, model: Field, key: str) -> list[list]:
    table = _TABLES.get(key)
    if table is None:
        _TABLES.clear()
        table = _TABLES[key] = Words(model)
    scores, spans = [], []
    held: list[tuple[str, list[list[bytes]]]] = []

    def flush() -> None:
        flat = _marginals_of(model, table, [c for _, chains in held for c in chains])
        at = 0
        for body, chains in held:
            n = sum(map(len, chains))
            mass = flat[at : at + n]
            at += n
            scores.append(float(1 / (1 + math.exp(-float(np.clip(np.dot(model.logistic, summary(mass)), -30, 30))))))
            spans.append(spans_of(body, mass) if n and mass.max() > 0.5 else [])
        held.clear()

    size = 0
    for body in texts(column):
        held.append((body, list(lines_of_words(body))))
        size += len(body)
        if size > 1_000_000:
            flush()
            size = 0
    flush()
    return [scores, spans]


def score(docs: DataFrame, model: Field, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``score`` (0 to 1) and ``toxic_spans``. No shuffle; the field, four tables
    of a fixed number of weights, is broadcast.
    """
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    return annotate(docs, text, FIELDS, lambda column: _compute(column, shared.value, key), keep)
