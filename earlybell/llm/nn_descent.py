"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Equal vectors are one node, so copies can't fill each other's lists; a node keeps the
smallest ids of its rows, more than any answer needs. Nodes are laid out in shards of
neighbours in a random projection order; a node's address says where its vector lies.

* **Graph**: the shards of two such orders give the first lists. Then rounds of joins: each
  node is the pivot of its neighbours and of those that have it as neighbour; the vectors of
  both come to the pivot by a join, all pairs with a fresh edge are compared there, and what
  improves a list goes to its node. Rounds end when few lists change. Lengths are evened out
  by one more component (the root of the greatest squared length less the own), so that the
  nearest nodes are those of largest inner product.
* **Search**: a query keeps its best ``beam`` nodes. In each step the best ones that were not
  expanded ask their shards for their neighbours, and the neighbours' shards for scores.
  Queries meet shards in blocks, by an equi-join on the shard. It ends when all nodes of
  all beams are expanded. Queries that are nodes start at themselves, others at the best of
  ``Settings.entries`` entry nodes.

The result is approximate by nature; scores are exact, and so is the order among the nodes
found. Recall against brute force is measured in the tests.

Defined cases: rows with a null id, or a vector that is null, empty, zero or holds null or
non-finite components, take no part, nor do those of another than the most frequent length;
repeated rows are candidates of their own, and a query leaves out one row of its own id and
vector; ties go to the smaller id; columns besides the two named ones are left out; an empty
table gives no rows. Each round is a stored table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earlybell.llm.common import store, with_package
from earlybell.llm.vectors import matrix, packed, same_length, unpacked, whole

#: Bits of an address that say the place in a shard.
PLACE = 12


@dataclass(frozen=True)
class Settings:
    neighbours: int = 30
    #: backward edges that join a pivot's comparison and, at last, the graph
    backward: int = 20
    shard: int = 1024
    rounds: int = 6
    #: rounds end when fewer than this share of the edges is fresh
    settled: float = 0.04
    beam: int = 192
    #: nodes that a query expands in one step
    step: int = 192
    #: entry nodes, by a hash, for queries that are no nodes
    entries: int = 512
    #: queries of a block, on average
    block: int = 128
    seed: int = 17


@dataclass
class Graph:
    length: int
    #: shard, vectors (bytes of doubles or floats), neighbours (addresses of each node, one after another), degree
    shards: DataFrame
    #: address, vector, ids (the smallest ones of the rows with this vector)
    nodes: DataFrame
    settings: Settings
    kind: str


def finish_round(spark: SparkSession) -> None:
    """Shuffle files of finished rounds go when the driver's JVM collects its garbage: ask for it."""
    spark.sparkContext._jvm.System.gc()


def taking_part(table: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    rows = table.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & whole(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    return same_length(rows, "vector")


def _kind(rows: DataFrame) -> str:
    return "<f4" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"


def as_bytes(rows: DataFrame, kind: str) -> DataFrame:
    """The rows with their vector as bytes (negative zeros become zeros)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column(1), kind[1:]) + 0.0
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed(values.astype(kind)), pa.binary())], ["id", "vector"])

    return rows.mapInArrow(run, "id bigint, vector binary")


def _ordered(rows: DataFrame, kind: str, length: int, seed: int) -> DataFrame:
    """Rows sorted, over range partitions, by sign bits of random projections, then by one more."""
    planes = np.random.default_rng(seed).normal(size=(length, 11))
    names = rows.columns
    at = names.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                places = unpacked(batch.column(at), kind, length).astype(float) @ planes
                code = ((places[:, :10] > 0) << np.arange(10)).sum(1)
                code = code ^ (code >> 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code), pa.array(places[:, 10])], [*names, "code", "along"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    laid = rows.mapInArrow(run, f"{schema}, code bigint, along double")
    # vectors are distinct here, so ranges can be cut anywhere
    return laid.repartitionByRange("code", "along", "vector").sortWithinPartitions("code", "along", "vector")


def _lists(near: np.ndarray, addresses: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's best ``count`` columns of a square of similarities: addresses and values."""
    np.fill_diagonal(near, -np.inf)
    k = min(count, len(near) - 1)
    if k < 1:
        return np.zeros((len(near), 0), np.int64), np.zeros((len(near), 0), np.float32)
    top = np.argpartition(-near, k - 1, 1)[:, :k]
    return addresses[top], np.take_along_axis(near, top, 1).astype(np.float32)


def _even(values: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that gives all of them one length."""
    values = values.astype(np.float32)
    rest = np.sqrt(np.maximum(most - (values.astype(float) ** 2).sum(1), 0))
    return np.concatenate([values, rest[:, None].astype(np.float32)], 1)


def _best(address: np.ndarray, score: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``count`` distinct addresses."""
    order = np.lexsort((-score, address))
    address, score = address[order], score[order]
    first = np.r_[True, address[1:] != address[:-1]] if len(address) else np.zeros(0, bool)
    address, score = address[first], score[first]
    top = np.lexsort((address, -score))[:count]
    return address[top], score[top]


def _flat(column: pa.Array, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(b or b"", dtype) for b in column.to_pylist()]


def _first_lists(rows: DataFrame, kind: str, length: int, most: float, settings: Settings, place: bool) -> DataFrame:
    """Cut ordered rows into shards and list each node's best of its shard: a, vector, bs, ss.

    With ``place`` the nodes get their addresses (a) here; else they bring them.
    """
    count, size = settings.neighbours, settings.shard
    tail = [] if not place else ["ids"]
    names = ["a", "vector", *tail, "bs", "ss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, chunk = TaskContext.get().partitionId(), [], 0

        def out(table: pa.Table) -> pa.RecordBatch:
            nonlocal chunk
            values = unpacked(table["vector"].combine_chunks(), kind, length)
            if place:
                shard = (part << 24) | chunk
                addresses = (shard << PLACE) | np.arange(len(values), dtype=np.int64)
            else:
                addresses = table["a"].to_numpy()
            even = _even(values, most)
            bs, ss = _lists(even @ even.T, addresses, count)
            chunk += 1
            more = [table["ids"].combine_chunks()] if place else []
            return pa.RecordBatch.from_arrays(
                [pa.array(addresses), table["vector"].combine_chunks(), *more, pa.array(packed(bs), pa.binary()), pa.array(packed(ss), pa.binary())],
                names,
            )

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= 2 * size:  # what is left is at least a whole shard
                table = pa.Table.from_batches(held)
                yield out(table.slice(0, size))
                held = table.slice(size).to_batches()
        if held and sum(b.num_rows for b in held):
            table = pa.Table.from_batches(held)
            half = table.num_rows if table.num_rows <= size else -(-table.num_rows // 2)
            for at in range(0, table.num_rows, half):
                yield out(table.slice(at, half))

    ids = "ids array<bigint>, " if place else ""
    return rows.mapInArrow(run, f"a bigint, vector binary, {ids}bs binary, ss binary")


def _merged(graph: DataFrame, found: DataFrame, count: int) -> DataFrame:
    """Nodes (a, vector, bs, ss, fresh) with the candidates of ``found`` (a, bs, ss) taken in."""
    lists = found.groupBy("a").agg(F.collect_list(F.struct("bs", "ss")).alias("found"))
    met = graph.join(lists, "a", "left").select("a", "vector", "bs", "ss", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            olds, values, news = _flat(batch.column(2), "<i8"), _flat(batch.column(3), "<f4"), batch.column(4).to_pylist()
            bs, ss, fresh, kth, changed = [], [], [], [], []
            for old, value, new in zip(olds, values, news, strict=True):
                address = [old, *[np.frombuffer(x["bs"], "<i8") for x in new or ()]]
                score = [value, *[np.frombuffer(x["ss"], "<f4") for x in new or ()]]
                top, best = _best(np.concatenate(address), np.concatenate(score), count)
                added = ~np.isin(top, old)
                bs.append(top.tobytes())
                ss.append(best.tobytes())
                fresh.append(added.astype(np.uint8).tobytes())
                kth.append(float(best[-1]) if len(best) == count else float("-inf"))
                changed.append(int(added.sum()))
            columns = [bs, ss, fresh]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.binary()) for c in columns], pa.array(kth, pa.float32()), pa.array(changed, pa.int64())],
                ["a", "vector", "bs", "ss", "fresh", "kth", "changed"],
            )

    return met.mapInArrow(run, "a bigint, vector binary, bs binary, ss binary, fresh binary, kth float, changed bigint")


def _edges(graph: DataFrame) -> DataFrame:
    """a, b, fresh of each edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, fresh = _flat(batch.column(1), "<i8"), _flat(batch.column(2), "u1")
            if lists and sum(map(len, lists)):
                a = np.repeat(batch.column(0).to_numpy(), [len(x) for x in lists])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(np.concatenate(lists)), pa.array(np.concatenate(fresh) > 0)], ["a", "b", "fresh"]
                )

    return graph.select("a", "bs", "fresh").mapInArrow(run, "a bigint, b bigint, fresh boolean")


def _backward(edges: DataFrame, count: int, salt: int) -> DataFrame:
    """Edges turned round: up to ``count`` for each node, fresh ones first."""
    order = Window.partitionBy("b").orderBy(F.desc("fresh"), F.xxhash64(F.lit(salt), "a", "b"))
    ranked = edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select(F.col("b").alias("w"), F.col("a").alias("n"), "fresh")


def _local_joins(graph: DataFrame, settings: Settings, salt: int) -> DataFrame:
    """Candidates (a, bs, ss) from comparing all neighbours of each pivot."""
    edges = _edges(graph)
    both = edges.select(F.col("a").alias("w"), F.col("b").alias("n"), "fresh").union(_backward(edges, settings.backward, salt))
    vectors = graph.select(F.col("a").alias("n"), F.col("vector").alias("v"), "kth")
    # the edges outgrow the estimate of what they are planned from: no broadcast on its word
    met = both.join(vectors.hint("merge"), "n").groupBy("w").agg(
        F.collect_list(F.struct("n", "fresh", "kth", "v")).alias("own"), F.max("fresh").alias("any")
    )
    met = met.where("any").select("own")
    count = settings.neighbours

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            size = own.value_lengths().to_numpy()
            flat = own.flatten()
            n, kth = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            fresh = flat.field(1).to_numpy(zero_copy_only=False).astype(bool)
            joined = b"".join(flat.field(3).to_pylist())
            if not joined:
                continue
            v = np.frombuffer(joined, "<f2").reshape(len(n), -1).astype(np.float32)
            starts = np.r_[0, np.cumsum(size)[:-1]]
            found: list[tuple[np.ndarray, ...]] = []
            for s in range(0, len(size), 128):
                lens, first = size[s : s + 128], starts[s : s + 128]
                slots = np.arange(lens.max())
                there = slots[None, :] < lens[:, None]
                at = np.where(there, first[:, None] + slots[None, :], 0)
                near = v[at] @ v[at].transpose(0, 2, 1)
                node, new = n[at], fresh[at] & there
                fits = there[:, :, None] & there[:, None, :] & (new[:, :, None] | new[:, None, :])
                fits &= node[:, :, None] != node[:, None, :]
                fits &= near > kth[at][:, :, None]
                p, i, j = np.nonzero(fits)
                found.append((node[p, i], node[p, j], near[p, i, j]))
                if sum(len(x[0]) for x in found) > 2_000_000:
                    found = [_cut(found, count)]
            if found:
                yield _lists_of(*_cut(found, count))

    return met.mapInArrow(run, "a bigint, bs binary, ss binary")


def _cut(found: list[tuple[np.ndarray, ...]], count: int) -> tuple[np.ndarray, ...]:
    """The best ``count`` distinct candidates of each node, ordered by node."""
    a, b, s = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((-s, b, a))
    a, b, s = a[order], b[order], s[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, s = a[first], b[first], s[first]
    order = np.lexsort((-s, a))
    a, b, s = a[order], b[order], s[order]
    start = np.ones(len(a), bool)
    start[1:] = a[1:] != a[:-1]
    rank = np.arange(len(a)) - np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
    return a[rank < count], b[rank < count], s[rank < count]


def _lists_of(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]][: len(a)])
    end = np.r_[at[1:], len(a)][: len(at)]
    b, s = b.astype("<i8"), s.astype("<f4")
    bs = [b[x:y].tobytes() for x, y in zip(at, end, strict=True)]
    ss = [s[x:y].tobytes() for x, y in zip(at, end, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(bs, pa.binary()), pa.array(ss, pa.binary())], ["a", "bs", "ss"])


def build(rows: DataFrame, kind: str, length: int, keep: int, settings: Settings) -> Graph:
    """The graph over rows (id, vector as bytes); ``keep`` smallest ids stay with each node."""
    spark = rows.sparkSession
    with_package(spark)
    order = Window.partitionBy("vector").orderBy("id")
    least = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    nodes = least.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = store(nodes, "ann_distinct")

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = unpacked(batch.column(0), kind, length).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array([float((values * values).sum(1).max())])], ["most"])

    most = nodes.select("vector").mapInArrow(squares, "most double").agg(F.max("most")).first()[0] or 0.0
    laid = _ordered(nodes, kind, length, settings.seed)
    first = store(_first_lists(laid, kind, length, most, settings, True), "ann_first")
    nodes = first.select(F.col("a").alias("address"), "vector", "ids")
    again = _ordered(first.select("a", "vector"), kind, length, settings.seed + 1)
    second = _first_lists(again, kind, length, most, settings, False).select("a", "bs", "ss")

    def halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                even = _even(unpacked(batch.column(1), kind, length), most)
                even = even / max(most, 1e-300) ** 0.5  # halves hold numbers of moderate size only
                empty = pa.array([b""] * len(even), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(packed(even.astype("<f2")), pa.binary()), empty, empty], ["a", "vector", "bs", "ss"]
                )

    def scaled(lists: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ss = [(x / max(most, 1e-300)).astype("<f4").tobytes() for x in _flat(batch.column(2), "<f4")]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ss, pa.binary())], ["a", "bs", "ss"])

        return lists.mapInArrow(run, "a bigint, bs binary, ss binary")

    bare = first.select("a", "vector").mapInArrow(halved, "a bigint, vector binary, bs binary, ss binary")
    lists = scaled(first.select("a", "bs", "ss").union(second))
    graph = store(_merged(bare, lists, settings.neighbours), "ann_graph")
    total = graph.count()
    for k in range(settings.rounds):
        graph = store(_merged(graph, _local_joins(graph, settings, k), settings.neighbours), "ann_graph")
        finish_round(spark)
        changed = graph.agg(F.sum("changed")).first()[0] or 0
        if changed <= settings.settled * total * settings.neighbours:
            break
    edges = _edges(graph)
    back = _backward(edges, settings.backward, -1).groupBy("w").agg(F.collect_list("n").alias("back"))
    near = graph.select("a", "bs").join(back, graph["a"] == back["w"], "left").select("a", "bs", "back")
    shard = F.shiftright("address", PLACE)
    held = nodes.select("address", "vector").join(near, F.col("address") == F.col("a"))
    held = held.groupBy(shard.alias("shard")).agg(F.sort_array(F.collect_list(F.struct("address", "vector", "bs", "back"))).alias("own"))
    return Graph(length, store(held.mapInArrow(_shard_of, _SHARD), "ann_shards"), nodes, settings, kind)


_SHARD = "shard bigint, vectors binary, neighbours binary, degree binary"


def _shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            own = batch.column(1).slice(k, 1).flatten()
            forward, back = _flat(own.field(2), "<i8"), own.field(3).to_pylist()
            all_of = [np.unique(np.r_[f, np.asarray(b or [], np.int64)]) for f, b in zip(forward, back, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(k, 1),
                    pa.array([b"".join(own.field(1).to_pylist())], pa.binary()),
                    pa.array([np.concatenate(all_of).astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.asarray([len(x) for x in all_of], "<i4").tobytes()], pa.binary()),
                ],
                ["shard", "vectors", "neighbours", "degree"],
            )


def _by_shard(addresses: np.ndarray) -> list[tuple[int, np.ndarray]]:
    if not len(addresses):
        return []
    addresses = np.sort(addresses)
    shard = addresses >> PLACE
    cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    return [(int(shard[x]), addresses[x:y]) for x, y in zip(cuts, [*cuts[1:], len(shard)], strict=True)]


#: A block of queries in one row, the unit that meets shards; ``i`` is a query's place in it.
_BLOCK = "block bigint, held array<struct<q: bigint, vector: binary, beam: binary, scores: binary, done: binary>>, open boolean"
_EXPAND = "shard bigint, block bigint, asked array<struct<i: int, own: binary>>"
_NEAR = "block bigint, near array<struct<i: int, own: binary>>"
_ASK = "shard bigint, block bigint, asked array<struct<i: int, vector: binary, own: binary>>"
_FOUND = "block bigint, found array<struct<i: int, own: binary, scores: binary>>"


def _steps(rows: DataFrame, schema: str, compute: Callable[..., Iterator[dict]]) -> DataFrame:
    """mapInArrow a row at a time: rows are blocks of queries, so a row is a task's unit of work."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for made in compute(*[c[k].as_py() for c in batch.columns]):
                    yield pa.RecordBatch.from_pylist([made], arrow)

    return rows.mapInArrow(run, schema)


def _array(raw: bytes, dtype: str = "<i8") -> np.ndarray:
    return np.frombuffer(raw, dtype)


def _requests(wanted: list[tuple[int, np.ndarray, dict]], block: int) -> Iterator[dict]:
    """A row for each shard that the queries (place, addresses, more) of a block ask."""
    by: dict[int, list[dict]] = {}
    for i, addresses, more in wanted:
        for shard, own in _by_shard(addresses):
            by.setdefault(shard, []).append({"i": i, **more, "own": own.astype("<i8").tobytes()})
    for shard, asked in by.items():
        yield {"shard": shard, "block": block, "asked": asked}


def _gathered(lists: list[list[dict]], count: int, field: str, dtype: str) -> list[np.ndarray]:
    """What the shards answered, put together for each place of a block."""
    parts: list[list[np.ndarray]] = [[np.zeros(0, dtype)] for _ in range(count)]
    for answers in lists or ():
        for x in answers:
            parts[x["i"]].append(_array(x[field], dtype))
    return [np.concatenate(p) for p in parts]


def _met(requests: DataFrame, shards: DataFrame, *columns: str) -> DataFrame:
    """Requests beside their shard's columns."""
    # requests outgrow the estimate of what they are planned from: no broadcast on its word
    return requests.join(shards.select("shard", *columns).hint("merge"), "shard").select("block", "asked", *columns)


def search(graph: Graph, queries: DataFrame) -> DataFrame:
    """q, and its beam: ``beam`` (addresses, best first) and ``scores``, as bytes, of queries (q,
    vector as bytes, start: an address or null).
    """
    settings, length, kind = graph.settings, graph.length, graph.kind
    width, step, mask = settings.beam, settings.step, (1 << PLACE) - 1
    state = store(_started(graph, queries), "ann_beams")

    def opened(held: list[dict]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Place, beam and the places in it to expand now, of each query."""
        for i, x in enumerate(held):
            yield i, _array(x["beam"]), np.flatnonzero(_array(x["done"], "u1") == 0)[:step]

    def expand(block: int, held: list[dict]) -> Iterator[dict]:
        yield from _requests([(i, beam[at], {}) for i, beam, at in opened(held)], block)

    def neighbours(block: int, asked: list[dict], near: bytes, degree: bytes) -> Iterator[dict]:
        sizes, lists, out = _array(degree, "<i4"), _array(near), []
        end = np.cumsum(sizes)
        for x in asked:
            places = _array(x["own"]) & mask
            of = np.unique(np.concatenate([lists[end[p] - sizes[p] : end[p]] for p in places]))
            out.append({"i": x["i"], "own": of.astype("<i8").tobytes()})
        yield {"block": block, "near": out}

    def ask(block: int, held: list[dict], near: list[list[dict]]) -> Iterator[dict]:
        wanted = []
        for i, own in enumerate(_gathered(near, len(held), "own", "<i8")):
            wanted.append((i, np.setdiff1d(own, _array(held[i]["beam"])), {"vector": held[i]["vector"]}))
        yield from _requests(wanted, block)

    def score(block: int, asked: list[dict], vectors: bytes) -> Iterator[dict]:
        rows, out = _array(vectors, kind).reshape(-1, length).astype(float), []
        for x in asked:
            scores = rows[_array(x["own"]) & mask] @ _array(x["vector"], kind).astype(float)
            out.append({"i": x["i"], "own": x["own"], "scores": scores.astype("<f8").tobytes()})
        yield {"block": block, "found": out}

    def take_in(block: int, held: list[dict], found: list[list[dict]]) -> Iterator[dict]:
        addresses, scores = (_gathered(found, len(held), f, t) for f, t in (("own", "<i8"), ("scores", "<f8")))
        out, is_open = [], False
        for i, beam, at in list(opened(held)):
            x = held[i]
            done = _array(x["done"], "u1").copy()
            done[at] = 1
            address = np.r_[beam, addresses[i]]
            value = np.r_[_array(x["scores"], "<f8"), scores[i]]
            done = np.r_[done, np.zeros(len(address) - len(done), np.uint8)]
            order = np.lexsort((address, -value))[:width]
            is_open |= bool((done[order] == 0).any())
            made = {"beam": address[order].tobytes(), "scores": value[order].tobytes(), "done": done[order].tobytes()}
            out.append({"q": x["q"], "vector": x["vector"], **made})
        yield {"block": block, "held": out, "open": is_open}

    while not state.where("open").isEmpty():
        going = state.where("open")
        asked = _met(_steps(going.select("block", "held"), _EXPAND, expand), graph.shards, "neighbours", "degree")
        near = _steps(asked, _NEAR, neighbours).groupBy("block").agg(F.collect_list("near").alias("near"))
        wanted = going.select("block", "held").join(near, "block").select("block", "held", "near")
        scored = _steps(_met(_steps(wanted, _ASK, ask), graph.shards, "vectors"), _FOUND, score)
        found = scored.groupBy("block").agg(F.collect_list("found").alias("found"))
        met = going.select("block", "held").join(found, "block", "left").select("block", "held", "found")
        settled = state.where("NOT open")
        state = store(_steps(met, _BLOCK, take_in).unionByName(settled), "ann_beams")
        finish_round(graph.shards.sparkSession)
    return state.select(F.explode("held").alias("x")).select("x.q", "x.beam", "x.scores")


def _started(graph: Graph, queries: DataFrame) -> DataFrame:
    """First beams, in blocks: the own node where there is one, else the best entry nodes."""
    settings, length, kind = graph.settings, graph.length, graph.kind
    hashed = F.xxhash64(F.lit(settings.seed), "address")
    share = F.lit(min(1.0, 4 * settings.entries / max(1, graph.nodes.count())))
    drawn = graph.nodes.where(F.pmod(hashed, F.lit(1 << 30)) < share * (1 << 30)).orderBy(hashed).limit(settings.entries)
    entries = drawn.select("address", "vector").collect()  # at most ``entries`` rows
    addresses = np.asarray([r.address for r in entries], "<i8")
    rows = np.frombuffer(b"".join(bytes(r.vector) for r in entries), kind).reshape(len(entries), length).astype(float)

    def begin(q: int, vector: bytes, start: int | None) -> Iterator[dict]:
        value = _array(vector, kind).astype(float)
        if start is not None:
            beam, scores = np.asarray([start], "<i8"), np.asarray([value @ value])
        else:
            scores = rows @ value
            top = np.argsort(-scores, kind="stable")[: settings.step]
            beam, scores = addresses[top], scores[top]
        held = {"q": q, "vector": vector, "beam": beam.tobytes(), "scores": scores.astype("<f8").tobytes(), "done": bytes(len(beam))}
        yield {"block": 0, "held": [held], "open": len(beam) > 0}

    begun = _steps(queries.select("q", "vector", "start"), _BLOCK, begin)
    blocks = max(1, -(-queries.count() // settings.block))
    one = begun.select(F.get("held", F.lit(0)).alias("x"), "open")
    grouped = one.groupBy(F.pmod(F.xxhash64("x.q"), F.lit(blocks)).alias("block"))
    return grouped.agg(F.collect_list("x").alias("held"), F.max("open").alias("open"))


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def nearest(
    table: DataFrame,
    settings: Settings = Settings(),
    every: int = 20,
    count: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``count`` nearest rows found of each row whose id
    ``every`` divides.
    """
    rows, length = taking_part(table, vec_id, vector)
    kind = _kind(rows)
    with_package(table.sparkSession)
    rows = store(as_bytes(rows, kind), "ann_rows")
    graph = build(rows, kind, length, count + 1, settings)
    asked = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "vector")
    asked = asked.join(graph.nodes.select("address", "vector"), "vector")
    asked = store(asked.select(F.monotonically_increasing_id().alias("own"), "query_id", "address", "vector"), "ann_queries")
    distinct = asked.groupBy("address").agg(F.first("vector").alias("vector"))  # equal queries are searched once
    found = search(graph, distinct.select(F.col("address").alias("q"), "vector", F.col("address").alias("start")))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for q, beam, scores in zip(batch.column(0).to_pylist(), _flat(batch.column(1), "<i8"), _flat(batch.column(2), "<f8"), strict=True):
                near = scores >= scores[: count + 1][-1]
                out += [(q, int(a), float(s)) for a, s in zip(beam[near], scores[near], strict=True)]
            yield _rows(out, ["q", "address", "score"], [pa.int64(), pa.int64(), pa.float64()])

    # count + 1 nodes hold at least as many rows; what ties with the last of them comes along,
    # as equal scores are ordered by id
    near = found.mapInArrow(listed, "q bigint, address bigint, score double")
    near = near.join(graph.nodes.select("address", "ids"), "address").select("q", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= count + 1)
    near = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("near"))
    met = asked.select("query_id", F.col("address").alias("q")).join(near, "q")
    own = F.expr("array_position(transform(near, x -> x.id), query_id)")
    rest = F.expr("CASE WHEN own > 0 THEN concat(slice(near, 1, int(own) - 1), slice(near, int(own) + 1, size(near))) ELSE near END")
    met = met.withColumn("own", own).select("query_id", F.posexplode(F.slice(rest, 1, count)).alias("rank", "row"))
    return met.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("row.id").alias("vec_id"), F.col("row.score").alias("score"))
