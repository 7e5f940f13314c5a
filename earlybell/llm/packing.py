"""Concatenate-and-cut packing by two passes of prefix sums.

Pass one tokenises every text where it is read, and stores its ids with the running
token total of its partition. Prefix sums over the partitions' totals, one row each,
turn these into global offsets. Pass two cuts each document at the multiples of the
sequence length: every piece is a boundary record that says where the document's
tokens lie. Only the last sequence is shorter than the others.

* null or empty text: one piece, of the end id alone
* repeated documents are packed row by row; rows keep their partition's order
* extra columns are left out; only the id is carried
* a lost task writes the same rows again; the second pass reads the stored ones
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from earlybell.llm.bpe import load
from earlybell.llm.common import blobs, store, with_package

#: Bytes of one id in the stored and returned binaries (little-endian unsigned).
ID_BYTES = 4


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, text: str, doc_id: str) -> DataFrame:
    """First pass: id, partition, running total before the row, token count, ids."""
    with_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    tail = [
        StructField("partition", IntegerType()),
        StructField("before", LongType()),
        StructField("n", LongType()),
        StructField("ids", BinaryType()),
    ]
    schema = StructType([rows.schema["doc_id"], *tail])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        codec, part, total = load(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                ids = [
                    np.asarray([*codec.encode(b.decode("utf-8", "replace")), end_id], "<u4").tobytes()
                    for b in blobs(piece.column(1))
                ]
                n = np.asarray([len(b) // ID_BYTES for b in ids], np.int64)
                before = total + np.cumsum(n) - n
                total += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(before), pa.array(n), pa.array(ids, pa.binary())],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = 2048,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and their ``ids``."""
    rows = store(tokenised(docs, tokenizer, end_id, text, doc_id), "token_ids")
    totals = rows.groupBy("partition").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    ahead = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("partition", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    # one row for each task of the first pass, which the driver has to track anyway
    placed = rows.join(F.broadcast(bases), "partition").withColumn("at", F.col("base") + F.col("before"))
    width = F.lit(length)
    first, last = F.floor(F.col("at") / width), F.floor((F.col("at") + F.col("n") - 1) / width)
    pieces = placed.select("doc_id", "at", "n", "ids", F.explode(F.sequence(first, last)).alias("sequence_id"))
    start = F.greatest(F.lit(0), F.col("sequence_id") * width - F.col("at"))
    end = F.least(F.col("n"), (F.col("sequence_id") + 1) * width - F.col("at"))
    cut = pieces.withColumn("start", start).withColumn("length", end - F.col("start"))
    ids = F.expr(f"substring(ids, cast(start * {ID_BYTES} + 1 as int), cast(length * {ID_BYTES} as int))")
    return cut.select(
        "doc_id",
        "start",
        "length",
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * width).alias("offset"),
        ids.alias("ids"),
    )
