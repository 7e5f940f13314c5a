"""Connected components of an edge table: local contraction, then alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earlybell.llm.common import store, with_package

#: Edges (16 bytes each) that one task contracts at once.
EDGES = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``node`` and ``root`` of all nodes of the edges but the roots, the least of each component.

    Each root hooks on to its least neighbour, then all pointers jump to their roots.
    """
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        loose = low < high
        if not loose.any():
            break
        x, y = x[loose], y[loose]
        np.minimum.at(root, high[loose], low[loose])
        while not np.array_equal(further := root[root], root):
            root = further
    hung = root < np.arange(len(nodes))
    return nodes[hung], nodes[root[hung]]


def _contracted(edges: DataFrame) -> DataFrame:
    """The same components with each task's edges, ``EDGES`` at a time, turned into stars."""
    with_package(edges.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def given() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            node, root = stars(table["a"].to_numpy(), table["b"].to_numpy())
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], ["a", "b"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= EDGES:
                yield given()
                held, size = [], 0
        if size:
            yield given()

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = both.join(least, both["a"] == least["u"]).where("b > a")
    return _distinct(hung.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    hung = down.join(least, down["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node that an edge
    (``a``, ``b``, both long) names, but for the roots themselves.

    Each task contracts its own edges before anything is shuffled. Where what is left fits
    one task by its counted rows (``EDGES``), that task contracts it once more and is done;
    else alternating stars go on over all tasks, in rounds that grow with the logarithm of
    the longest chain. Minima are combined before the shuffle, so a node with very many
    edges costs no task more than its edges' join.
    """
    now = store(_contracted(edges), "stars")
    if now.count() <= EDGES:
        return _contracted(now.coalesce(1)).toDF("node", "root")
    now, seen = store(_small_star(now), "stars"), None
    while True:
        size = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if size == seen:
            return now.toDF("node", "root")
        seen = size
        now = store(_small_star(_large_star(now)), "stars")
