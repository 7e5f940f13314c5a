"""Small awkward tables and brute-force versions that the operator tests share."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, score string, base string"


def rows(texts: list[str | None], **columns) -> list[tuple]:
    """Rows with ids from 0 and, by default, extra columns whose names clash with results."""
    langs = columns.get("lang", [None if k % 7 == 3 else "ab"[k % 2] for k in range(len(texts))])
    return [
        (k, t, langs[k], None if k % 5 == 4 else "s", None if t is None else len(t), "own", "own", "own")
        for k, t in enumerate(texts)
    ]


def frame(spark: SparkSession, data: list[tuple], parts: int = 3) -> DataFrame:
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def learns(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 != 1


AWKWARD = [None, "", " ", "\n\n\t", "a", "É ß 漢字", "\x00\x01", "one two three", "x" * 50_000, "a b " * 20_000]
