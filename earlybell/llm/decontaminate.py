"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's words.

Texts are lower-cased (A-Z) and cut into words of digits, letters and non-ASCII
characters. An item gives its windows of ten consecutive words, or itself where it
is shorter. The automaton works on word numbers, so a match's end is a word index,
and a word's place in the original text is found again by its byte offset.

* null or empty text, or none with a word: no words, no hits
* null or wordless items have no window; an item without id still marks words, but
  is not named nor counted
* repeated documents are judged row by row; repeated items count once by id
* an input column named like a result column gives way to it
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from earlybell.llm.common import annotate, behind, blobs, store

WINDOW = 10
#: Benchmark bytes in one automaton: at about 70 bytes a node some 300 MB in a worker.
#: A larger benchmark is cut into blocks, each of which scans the texts once.
BLOCK_BYTES = 4 << 20

# Lower case for A-Z, a space for every other ASCII character that is no digit or letter.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

SPAN = StructType([StructField("start", LongType(), False), StructField("end", LongType(), False)])
FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("hit_items", ArrayType(StringType(), False)),
    StructField("hit_spans", ArrayType(SPAN, False)),
]
RUNS = "_hit_runs"
_BUILT: dict[int, Automaton] = {}


class Automaton:
    """Windows of items over word numbers; 0 stands for words that no item has."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int) -> None:
        import ahocorasick

        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            words = text.translate(FOLD).split()
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(item)
        self.owners = list(owners.values())
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for k, ids in enumerate(owners):
            self.trie.add_word(ids, (k, len(ids)))
        self.trie.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """A mark per word, and the items with an occurring window."""
        edges, found = np.zeros(len(words) + 1, np.int64), set()
        if self.owners:
            number = self.number.get
            for end, (k, n) in self.trie.iter(tuple([number(w, 0) for w in words])):
                edges[end + 1 - n] += 1
                edges[end + 1] -= 1
                found.add(k)
        items = {i for k in found for i in self.owners[k] if i is not None}
        return edges.cumsum()[:-1] > 0, items


def _runs(mask: np.ndarray) -> np.ndarray:
    """First and past-last index of each run of true."""
    steps = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)], axis=1)


def original_spans(text: bytes, folded: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point spans, in the original text, of the runs of hit words."""
    places = _runs(np.frombuffer(folded, np.uint8) != 32)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[places[a, 0]]), int(points[places[b - 1, 1]])) for a, b in _runs(hit)]


def _built(shared, window: int) -> Automaton:
    """A broadcast block's automaton, built once per worker process."""
    if shared.id not in _BUILT:
        _BUILT.clear()
        _BUILT[shared.id] = Automaton(shared.value, window)
    return _BUILT[shared.id]


class Block:
    """A block of items as the driver broadcast it."""

    def __init__(self, broadcast) -> None:
        self.broadcast, self.id = broadcast, str(uuid.uuid4())

    @property
    def value(self):
        return self.broadcast.value


def _scan(column: pa.Array, runs: pa.Array | None, items: pa.Array | None, block: Block, window: int) -> list[list]:
    """Columns of FIELDS and the runs of hit words, united with those of earlier blocks."""
    automaton = _built(block, window)
    out: list[list] = [[], [], [], [], []]
    earlier = zip(runs.to_pylist(), items.to_pylist(), strict=True) if runs is not None else None
    for text in blobs(column):
        folded = text.translate(FOLD)
        words = folded.split()
        hit, found = automaton.scan(words)
        if earlier is not None:
            was, who = next(earlier)
            for r in was:
                hit[r["start"] : r["end"]] = True
            found |= set(who)
        n_hit = int(hit.sum())
        spans = original_spans(text, folded, hit) if n_hit else []
        own = [(int(a), int(b)) for a, b in _runs(hit)] if n_hit else []
        named = [[{"start": a, "end": b} for a, b in x] for x in (spans, own)]
        for column_values, v in zip(out, (len(words), n_hit, sorted(found), *named), strict=True):
            column_values.append(v)
    return out


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """Distinct items in blocks of bounded size."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("body")).where("body IS NOT NULL")
    rows = rows.distinct()
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES) or 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("body"), F.lit(2 * n)).isin(2 * k, 2 * k + 1))
        yield [(r[0], r[1].encode()) for r in part.collect()]


def mark(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
) -> DataFrame:
    """Documents with n_words, n_hit, hit_items (sorted as strings) and hit_spans.

    Spans are in code points of the original text. No shuffle: the automaton goes to
    the texts. Where the benchmark needs several blocks, the texts are scanned once a
    block and the spans united.
    """
    sc = docs.sparkSession.sparkContext
    fields = [*FIELDS, StructField(RUNS, ArrayType(SPAN, False))]
    kept = docs.columns if keep is None else keep
    marked, extra = docs, ()
    for rows in _blocks(items, item_id, item_text):
        if extra:  # a further block: what the earlier ones found is stored, and joins this scan
            marked = store(marked, "decontaminated")
        block = Block(sc.broadcast(rows))

        def scan(column, runs=None, named=None, block=block):
            return _scan(column, runs, named, block, window)

        marked = annotate(marked, text, fields, scan, list(dict.fromkeys([*kept, text])), extra)
        extra = (RUNS, "hit_items")
    made = {f.name.lower() for f in FIELDS}
    return marked.select(*[F.col(f"`{c}`") for c in kept if c.lower() not in made], *[f.name for f in FIELDS])


def clean(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents in which no window of an item occurs, with their own columns."""

    def step(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        return mark(rows, items, text=name[text], window=window).where("n_hit = 0")

    return behind(docs, step)
