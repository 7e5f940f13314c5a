"""What the operators share: row-wise Arrow steps, folds, hashing, stored tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from earlybell.sources.staging import store

__all__ = ["annotate", "behind", "blobs", "held_out", "let", "mix", "scan", "store", "table", "texts", "unit_hash", "with_package"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver's path alone has it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blobs(column: pa.Array, step: int = 256) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, a few hundred at a time; null is empty."""
    column = column.cast(pa.binary())
    for at in range(0, len(column), step):
        for b in column.slice(at, step).to_pylist():
            yield b or b""


def texts(column: pa.Array, step: int = 256) -> Iterator[str]:
    for b in blobs(column, step):
        yield b.decode("utf-8", "replace")


def annotate(
    docs: DataFrame,
    text: str,
    fields: list[StructField],
    compute: Callable[..., list[list]],
    keep: list[str] | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Rows with computed columns: ``compute`` gets a batch's texts, gives a list per field.

    ``keep`` names the input columns to hand on (default all); one named like a field
    gives way to the computed one. ``extra`` names columns that ``compute`` gets besides
    the texts. No shuffle; a lost task is computed again.
    """
    with_package(docs.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    lead = "_taken"
    while any(c.lower().startswith(lead) for c in kept):
        lead = f"_{lead}"
    taken = [F.col(f"`{c}`").alias(f"{lead}_{k}") for k, c in enumerate((text, *extra))]
    carried = docs.select(*[F.col(f"`{c}`") for c in kept], *taken)
    schema = StructType([*carried.schema.fields[: len(kept)], *fields])
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = compute(*batch.columns[len(kept) :])
            arrays = [pa.array(v, t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], names)

    return carried.mapInArrow(run, schema)


def behind(
    docs: DataFrame,
    step: Callable[[DataFrame, dict[str, str]], DataFrame],
    keep: list[str] | None = None,
    added: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``step`` to the rows under neutral column names, which it gets as a mapping, and
    give the rows that it returns their own columns back: no name that it uses can clash.

    ``keep`` names the columns to give back (default all); those of ``added``, which ``step``
    makes, follow, and an own column of such a name gives way.
    """
    new = {a.lower() for a in added}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    name = {c: f"_own_{k}" for k, c in enumerate(docs.columns)}
    out = step(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in name.items()]), name)
    return out.select(*[F.col(name[c]).alias(c) for c in kept], *added)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(
    items: Column,
    carry: Column,
    step: Callable[[Column, Column], tuple[Column, Column]],
    typed: str,
    width: int = 32,
    depth: int = 2,
) -> Column:
    """The outputs of an ordered fold over an array, as an array of the type ``typed``.

    ``step`` gets the carried value and an item, gives the next carried value and an array
    of outputs (of any number, none included). Outputs are gathered in blocks of blocks:
    appending one by one to a single array would copy it each time, which is quadratic.
    """

    def fold(part: Column, start: Column, level: int) -> Column:
        out_type = f"array<array<{typed}>>" if level else f"array<{typed}>"
        empty = F.struct(start.alias("carry"), F.array().cast(out_type).alias("out"))

        def one(acc: Column, x: Column) -> Column:
            if level:
                below = fold(F.slice(part, x, F.lit(width**level)), acc["carry"], level - 1)
                return let(below, lambda b: F.struct(b["carry"].alias("carry"), F.concat(acc["out"], F.array(b["out"])).alias("out")))
            carried, made = step(acc["carry"], x)
            return F.struct(carried.alias("carry"), F.concat(acc["out"], made).alias("out"))

        if not level:
            return F.aggregate(part, empty, one)
        starts = F.sequence(F.lit(1), F.size(part), F.lit(width**level))
        done = F.aggregate(starts, empty, one)
        return let(done, lambda d: F.struct(d["carry"].alias("carry"), F.flatten(d["out"]).alias("out")))

    nothing = F.array().cast(f"array<{typed}>")
    return let(items, lambda every: F.when(F.size(every) > 0, fold(every, carry, depth)["out"]).otherwise(nothing))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that nothing learns from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit_hash(doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
