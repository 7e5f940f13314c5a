"""Token counts with a whole-token shortcut.

The driver proves once which vocabulary strings are one token by themselves; workers
count pieces found among them directly and merge only the rest. Counts equal those of
the ``tokenizers`` library without added tokens (special strings in a text are one
token each, as by its default).

* null or empty text: 0 bytes, 0 tokens
* repeated documents are counted row by row
* an input column named like a result column gives way to it
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from earlybell.llm.bpe import Counter, load
from earlybell.llm.common import annotate, blobs

FIELDS = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
_COUNTERS: dict[str, Counter] = {}


def counter(path: str, single: list[str]) -> Counter:
    """One counter, with its cache, per worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(load(path), single)
    return _COUNTERS[path]


def _compute(column: pa.Array, path: str, single: list[str]) -> list[list]:
    count = counter(path, single).count
    n_bytes, n_tokens = [], []
    for body in blobs(column):
        n_bytes.append(len(body))
        n_tokens.append(count(body.decode("utf-8", "replace")))
    return [n_bytes, n_tokens]


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with n_bytes (UTF-8) and n_tokens; ``tokenizer`` is a vocabulary file that
    every node has. No shuffle; the proven strings, at most the vocabulary, are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer).single_pieces())
    return annotate(docs, text, FIELDS, lambda column: _compute(column, tokenizer, shared.value), keep)
