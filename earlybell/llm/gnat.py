"""Exact hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Split points chosen from a bounded sample (``Settings.sample`` rows, greedily far apart)
divide each node among ``Settings.fanout`` subtrees: a row belongs to the nearest one, so
the boundaries are the hyperplanes between split points. Over *all* rows every split point
keeps the least and greatest distance to the rows of each sibling subtree, and the range
of their lengths.

A search is a set of score windows around an anchor. With the lengths of the rows a window
of inner products is an annulus of distances; a subtree goes when, for some split point,
its range does not meet the annulus widened by the anchor's distance to that point. What
is left are leaves; they hold all rows in chunks, and anchors in blocks meet them by an
equi-join on the leaf, where scores are exact integers.

1. own leaf, then all leaves within reach of the positives found there: an anchor's
   first rows of the same label;
2. own leaf, then all leaves that meet a positive's window, cut to what the negatives of
   the own leaf leave open: the first rows of other labels.

Defined cases: rows with a null id, label or vector, or null or non-finite components, take
no part, nor do vectors of another than the most frequent length; repeated rows are rows
of their own, also as anchors; a negative positive score has no window; columns besides the
three named ones are left out; an empty table gives no rows. Scores are exact while squared
lengths stay below 2**53. Each step reads stored tables, so lost executors cost tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earlybell.llm.common import store, with_package
from earlybell.llm.vectors import matrix, packed, same_length, unpacked, whole

SCALE = 256


@dataclass(frozen=True)
class Settings:
    #: rows that split points are chosen from (about so many, by a hash of the row)
    sample: int = 8192
    fanout: int = 12
    #: a node with fewer sampled rows is a leaf
    leaf_sample: int = 96
    #: rows of a chunk of a leaf, and anchors of a block, on average
    chunk: int = 1024
    block: int = 256
    positives: int = 5
    negatives: int = 5
    #: percent of the positive's score that a negative must reach
    share: int = 80
    seed: int = 11


@dataclass
class Tree:
    """Nodes with their split points; ``child[node][j]`` is a node (>= 0) or a leaf (~leaf)."""

    points: list[np.ndarray] = field(default_factory=list)
    child: list[list[int]] = field(default_factory=list)
    leaves: int = 0
    #: node x point x subtree: least and greatest distance; node x subtree: squared lengths
    low: dict[int, np.ndarray] = field(default_factory=dict)
    high: dict[int, np.ndarray] = field(default_factory=dict)
    least: dict[int, np.ndarray] = field(default_factory=dict)
    most: dict[int, np.ndarray] = field(default_factory=dict)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squared = (rows * rows).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squared, 0))


def _far_apart(rows: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Distinct rows, each far from those taken before, out of three times as many candidates."""
    pool = np.unique(rows[rng.permutation(len(rows))[: 3 * count]], axis=0)
    taken = [0]
    near = distances(pool, pool[:1])[:, 0]
    while len(taken) < min(count, len(pool)):
        k = int(near.argmax())
        if near[k] <= 0:
            break
        taken.append(k)
        near = np.minimum(near, distances(pool, pool[k : k + 1])[:, 0])
    return pool[taken]


def plant(sample: np.ndarray, settings: Settings) -> Tree:
    """The tree over a sample's vectors, without ranges."""
    rng, tree = np.random.default_rng(settings.seed), Tree()

    def grow(rows: np.ndarray) -> int:
        points = _far_apart(rows, settings.fanout, rng) if len(rows) >= settings.leaf_sample else rows[:0]
        if len(points) < 2:
            tree.leaves += 1
            return ~(tree.leaves - 1)
        node = len(tree.points)
        tree.points.append(points)
        tree.child.append([])
        near = distances(rows, points).argmin(1)
        tree.child[node] = [grow(rows[near == j]) for j in range(len(points))]
        return node

    if grow(sample) >= 0:
        return tree
    return Tree(leaves=1)


def place(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """Each row's leaf."""
    leaf = np.zeros(len(rows), np.int64)
    todo = [(0, np.arange(len(rows)))] if tree.points else []
    while todo:
        node, at = todo.pop()
        near = distances(rows[at], tree.points[node]).argmin(1)
        for j, child in enumerate(tree.child[node]):
            own = at[near == j]
            if child < 0:
                leaf[own] = ~child
            elif len(own):
                todo.append((child, own))
    return leaf


def _paths(tree: Tree) -> list[list[tuple[int, int]]]:
    """The (node, subtree) steps from the root to each leaf."""
    paths: list[list[tuple[int, int]]] = [[] for _ in range(tree.leaves)]
    todo = [(0, [])] if tree.points else []
    while todo:
        node, steps = todo.pop()
        for j, child in enumerate(tree.child[node]):
            if child < 0:
                paths[~child] = [*steps, (node, j)]
            else:
                todo.append((child, [*steps, (node, j)]))
    return paths


def survivors(tree: Tree, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """anchors x leaves: whether a leaf may hold rows with low <= inner product <= high."""
    alive = np.zeros((len(anchors), tree.leaves), bool)
    if not tree.points:
        alive[:] = (low <= high)[:, None]
        return alive
    square = (anchors * anchors).sum(1)
    todo = [(0, np.flatnonzero(low <= high))]
    while todo:
        node, at = todo.pop()
        if node not in tree.low or not len(at):
            continue
        with np.errstate(invalid="ignore"):
            far = np.sqrt(np.maximum(square[at, None] + tree.most[node] - 2 * low[at, None], -1.0))
            near = np.sqrt(np.maximum(square[at, None] + tree.least[node] - 2 * high[at, None], 0.0))
        own = distances(anchors[at], tree.points[node])
        slack = 1e-6 + 1e-9 * (own.max(1)[:, None] + np.where(np.isfinite(far), far, 0.0))
        keep = ~np.isnan(far) & np.isfinite(tree.most[node])
        for i in range(own.shape[1]):
            a = own[:, i, None]
            inner = np.maximum(np.maximum(near - a, a - far), 0.0) - slack
            keep &= (tree.low[node][i] <= a + far + slack) & (tree.high[node][i] >= inner)
        for j, child in enumerate(tree.child[node]):
            rows = at[keep[:, j]]
            if child < 0:
                alive[rows, ~child] = True
            else:
                todo.append((child, rows))
    return alive


def prepared(table: DataFrame, vec_id: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """Rows that take part: a key of the row, id, label, integer vector."""
    own, name = F.col(f"`{vec_id}`").cast("long"), F.col(f"`{label}`").cast("long")
    rows = table.select(own.alias("id"), name.alias("label"), F.col(f"`{vector}`").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole(F.col("vector")))
    rows, length = same_length(rows, "vector")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole_parts = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    key = F.monotonically_increasing_id().alias("key")
    return rows.select(key, "id", moved.alias("label"), whole_parts.alias("vector")), length


@dataclass
class Index:
    tree: Tree
    length: int
    #: key, id, label, leaf, vector (bytes of doubles)
    rows: DataFrame
    #: leaf, ids, keys, labels, vectors of a chunk
    chunks: DataFrame


def build(table: DataFrame, settings: Settings, vec_id: str, vector: str, label: str) -> Index:
    with_package(table.sparkSession)
    rows, length = prepared(table, vec_id, vector, label)
    rows = store(rows, "gnat_rows")
    total = rows.count()
    rate = min(1.0, settings.sample / max(1, total))
    drawn = F.pmod(F.xxhash64(F.lit(settings.seed), "id", "key"), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
    sample = [r[0] for r in rows.where(drawn).select("vector").collect()]
    tree = plant(np.asarray(sample, float).reshape(len(sample), length), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column(3))
                arrays = [*batch.columns[:3], pa.array(place(tree, values)), pa.array(packed(values), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "label", "leaf", "vector"])

    placed = rows.mapInArrow(run, "key bigint, id bigint, label bigint, leaf bigint, vector binary")
    placed = store(placed, "gnat_placed")
    parts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / settings.chunk).cast("long").alias("parts"))
    # one row for each leaf of the tree, whose size the sample bounds
    dealt = placed.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    chunks = dealt.groupBy("leaf", "part").agg(F.collect_list(F.struct("key", "id", "label", "vector")).alias("held"))
    chunks = store(chunks.select("leaf", "held"), "gnat_chunks")
    _measure(tree, length, chunks)
    return Index(tree, length, placed, chunks)


def _held(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, ids, labels and vectors of one list of rows."""
    own = column.flatten()
    return (*[own.field(k).to_numpy(zero_copy_only=False) for k in range(3)], unpacked(own.field(3), "<f8", length))


def _measure(tree: Tree, length: int, chunks: DataFrame) -> None:
    """Ranges over all rows; they are gathered for each split point and subtree of the tree."""
    paths = _paths(tree)
    for node, points in enumerate(tree.points):
        k = len(points)
        tree.low[node], tree.high[node] = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        tree.least[node], tree.most[node] = np.full(k, np.inf), np.full(k, -np.inf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], tuple[float, float]] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                values = _held(batch.column(1).slice(k, 1), length)[3]
                squares = (values * values).sum(1)
                for node, j in paths[batch.column(0)[k].as_py()]:
                    far = distances(values, tree.points[node])
                    spans = [(i, a, b) for i, (a, b) in enumerate(zip(far.min(0), far.max(0), strict=True))]
                    for i, a, b in [(-1, squares.min(), squares.max()), *spans]:
                        low, high = found.get((node, i, j), (a, b))
                        found[node, i, j] = (min(low, a), max(high, b))
        if found:
            node, i, j = (pa.array(c, pa.int32()) for c in zip(*found, strict=True))
            low, high = (pa.array(c, pa.float64()) for c in zip(*found.values(), strict=True))
            yield pa.RecordBatch.from_arrays([node, i, j, low, high], ["node", "i", "j", "low", "high"])

    spans = chunks.select("leaf", "held").mapInArrow(run, "node int, i int, j int, low double, high double")
    for r in spans.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        if r.i < 0:
            tree.least[r.node][r.j], tree.most[r.node][r.j] = r.low, r.high
        else:
            tree.low[r.node][r.i, r.j], tree.high[r.node][r.i, r.j] = r.low, r.high


def _first(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of each owner's first rows: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    start = np.r_[True, own[1:] != own[:-1]]
    rank = np.arange(len(own)) - np.maximum.accumulate(np.where(start, np.arange(len(own)), 0))
    return order[rank < count]


def search(index: Index, asked: DataFrame, same: bool, count: int, own_leaf: bool, blocks: int) -> DataFrame:
    """The first ``count`` rows of each window: key, low, high, id, score.

    ``asked`` has an anchor's key, label, leaf, vector and ``windows`` (arrays of low and high).
    Rows of the same label, without the anchor's own row, or of other labels are wanted;
    ``own_leaf`` looks at the anchor's leaf alone.
    """
    tree, length = index.tree, index.length
    windows = "array<struct<low: bigint, high: bigint>>"

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["leaf", "key", "label", "vector", "windows"]
        for batch in batches:
            if not batch.num_rows:
                continue
            home = batch.column(2).to_numpy(zero_copy_only=False)
            if own_leaf:
                anchor, leaf = np.arange(batch.num_rows), home
            else:
                values, wanted = unpacked(batch.column(3), "<f8", length), batch.column(4)
                of = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
                low, high = (wanted.flatten().field(k).to_numpy(zero_copy_only=False).astype(float) for k in (0, 1))
                alive = np.zeros((batch.num_rows, tree.leaves), bool)
                np.logical_or.at(alive, of, survivors(tree, values[of], low, high))
                anchor, leaf = np.nonzero(alive)
            at = pa.array(anchor)
            for s in range(0, len(anchor), 4096):
                part = at.slice(s, 4096)
                columns = [batch.column(k).take(part) for k in (0, 1, 3, 4)]
                yield pa.RecordBatch.from_arrays([pa.array(leaf[s : s + 4096]), *columns], names)

    requests = asked.select("key", "label", "leaf", "vector", "windows").mapInArrow(
        plan, f"leaf bigint, key bigint, label bigint, vector binary, windows {windows}"
    )
    block = F.pmod(F.xxhash64("key"), F.lit(blocks))
    requests = requests.groupBy("leaf", block.alias("block")).agg(
        F.collect_list(F.struct("key", "label", "vector", "windows")).alias("anchors")
    )
    # requests outgrow the estimate of what they are planned from: no broadcast on its word
    met = requests.select("leaf", "anchors").join(index.chunks.hint("merge"), "leaf").select("anchors", "held")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def cut() -> tuple[np.ndarray, ...]:
            key, low, high, ids, scores = (np.concatenate(c) for c in zip(*kept, strict=True))
            _, owner = np.unique(np.stack([key, low, high], 1), axis=0, return_inverse=True)
            first = _first(owner.ravel(), scores, ids, count)
            return tuple(c[first] for c in (key, low, high, ids, scores))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cut()], ["key", "low", "high", "id", "score"])

        for batch in batches:
            for k in range(batch.num_rows):
                anchors = batch.column(0).slice(k, 1).flatten()
                a_key, a_label = (anchors.field(f).to_numpy(zero_copy_only=False) for f in (0, 1))
                keys, ids, labels, values = _held(batch.column(1).slice(k, 1), length)
                scores = np.rint(unpacked(anchors.field(2), "<f8", length) @ values.T).astype(np.int64)
                fits = (a_label[:, None] == labels[None, :]) == same
                fits &= a_key[:, None] != keys[None, :]
                spans = anchors.field(3)
                of = np.repeat(np.arange(len(a_key)), spans.value_lengths().to_numpy(zero_copy_only=False))
                low, high = (spans.flatten().field(f).to_numpy(zero_copy_only=False) for f in (0, 1))
                inside = fits[of] & (scores[of] >= low[:, None]) & (scores[of] <= high[:, None])
                w, r = np.nonzero(inside)
                first = _first(w, scores[of[w], r], ids[r], count)
                w, r = w[first], r[first]
                kept.append((a_key[of[w]], low[w], high[w], ids[r], scores[of[w], r]))
                if sum(len(c[0]) for c in kept) > 200_000:
                    kept[:] = [cut()]
                    if len(kept[0][0]) > 100_000:  # many anchors: hand on what there is
                        yield out()
                        kept.clear()
        if kept:
            yield out()

    found = met.mapInArrow(score, "key bigint, low bigint, high bigint, id bigint, score bigint")
    best = Window.partitionBy("key", "low", "high").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)


FLOOR, CEILING = -(1 << 62), 1 << 62


def hard_negatives(
    table: DataFrame,
    settings: Settings = Settings(),
    every: int = 100,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    index = build(table, settings, vec_id, vector, label)
    anchors = index.rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-anchors.count() // settings.block))

    def run(asked: DataFrame, same: bool, count: int, own_leaf: bool) -> DataFrame:
        return search(index, asked, same, count, own_leaf, blocks)

    def window(low, high):
        return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    everything = anchors.withColumn("windows", F.array(window(F.lit(FLOOR), F.lit(CEILING))))
    near = run(everything, True, settings.positives, True)
    bound = near.where(F.col("rank") == settings.positives).select("key", F.col("score").alias("bound"))
    reach = F.coalesce("bound", F.lit(FLOOR))
    asked = store(
        anchors.join(bound, "key", "left").withColumn("windows", F.array(window(reach, F.lit(CEILING)))).drop("bound"),
        "gnat_asked",
    )
    found = run(asked, True, settings.positives, False)
    positives = store(found.select("key", F.col("id").alias("positive_id"), F.col("score").alias("top")), "gnat_positives")

    reached = F.expr(f"({settings.share} * top + 99) div 100")  # the least whole score that reaches the share
    spans = positives.where("top >= 0").select("key", reached.alias("low"), F.col("top").alias("high")).distinct()
    each = spans.groupBy("key").agg(F.collect_list(window(F.col("low"), F.col("high"))).alias("windows"))
    near = run(anchors.join(each, "key"), False, settings.negatives, True)
    bound = near.where(F.col("rank") == settings.negatives).select("key", "high", F.col("score").alias("bound"))
    cut = spans.join(bound, ["key", "high"], "left").withColumn("low", F.greatest("low", F.coalesce("bound", "low")))
    each = cut.groupBy("key").agg(F.collect_list(window(F.col("low"), F.col("high"))).alias("windows"))
    found = run(store(anchors.join(each, "key"), "gnat_windows"), False, settings.negatives, False)
    found = found.select(
        "key",
        F.col("high").alias("top"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = anchors.select("key", F.col("id").alias("anchor_id"))
    return (
        positives.join(named, "key")
        .join(found, ["key", "top"])
        .select("anchor_id", "positive_id", "rank", "negative_id", F.col("top").alias("positive_score"), "negative_score")
    )
