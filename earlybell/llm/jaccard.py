"""N-gram Jaccard self-join by signature trees.

Texts are lower-cased (A-Z) and cut at white space; a document's set holds its distinct
shingles of five words. Two documents link at a Jaccard similarity of 0.8 or more.

1. Documents with equal sets form one class (64-bit key of the sorted set).
2. Shingles, packed per document and hash range, meet by hash range; one that only one
   class has is dropped. A link needs 80 % of both sets in common, so classes that share
   less of theirs with anyone are done; this leaves the near copies.
3. Rarest shingles first, two linked sets share one of their first 20 % (prefix filter).
   Classes sharing one hang together; the components of that are clusters.
4. In each cluster a signature tree (see ``signature_tree``) finds the links by dual
   traversal; a cluster of more than a block's size is cut into blocks, whose linked
   classes are then represented by one each until no round links any more, and finally
   blocks that still hold different components are compared pair by pair.
5. The components of all links, spread over the documents of each class.

Nothing is sampled or capped: what the steps leave out can't link. Pairs within a group
that is connected already are not compared again, so a group of copies or near copies of
any size costs about its number of rows; per-task work is bounded by the hash ranges and
block sizes, and a shingle of very many documents is passed on rather than held.

* null, empty or wordless text: no shingle, linked with nothing, its own component
* fewer than five words: the whole sequence is the one shingle
* repeated rows link as copies; ties at 0.8 link
* a null id counts in no minimum; a component of null ids has a null id
* extra columns are left out; only the id is carried
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from earlybell.llm.common import annotate, behind, blobs, mix, store, with_package
from earlybell.llm.graph import components as connected
from earlybell.llm.signature_tree import PERCENT, links

SHINGLE = 5
#: Shingles in a hash range, which one task holds (6 bytes each, some 100 MB at work).
RANGE_SHINGLES = 2_000_000
#: Hash ranges are a power of two. Beyond so many bits a task takes several ranges in turn.
TASK_BITS = 16
#: A shingle of more classes is called common: it sorts last, and its rows are passed on.
COMMON = 4_096
#: Classes, and shingles, in a block: what one task compares at once.
BLOCK_SETS = 2_048
BLOCK_SHINGLES = 1_000_000
#: Words in a task's cache, and bytes of a word that is worth a place there.
CACHE_WORDS = 500_000
CACHE_WORD_BYTES = 64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_WORD_BYTES:
            if len(self) > CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


_HASHES = _WordHashes()


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    rolled = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(rolled)]
    return np.unique(mix(rolled))


def class_key(shingle_set: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingle_set.tobytes())).view(np.int64))


def _describe(column: pa.Array) -> list[list]:
    sizes, keys = [], []
    for text in blobs(column):
        s = shingles(text)
        sizes.append(len(s))
        keys.append(class_key(s) if len(s) else None)
    return [sizes, keys]


DESCRIBED = [StructField("n_shingles", LongType()), StructField("class_key", LongType())]


def described(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, n_shingles and class_key (null without shingles) of each row."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    return annotate(own, "body", DESCRIBED, _describe, ["doc_id"])


# --- step 2: shingles that several classes have ---------------------------------------------


def _low_bytes(x: np.ndarray) -> np.ndarray:
    """The six low bytes of each number, flat."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def _binary_rows(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of consecutive stretches of bytes."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


#: Rows of a chunk of texts for one hash range: class keys (8 bytes each), how many
#: shingles each has there (2 bytes), and these (6 bytes, the 48 bits below the range).
PACKED = "hash_range int, keys binary, lengths binary, packed binary"
CHUNK_TEXTS = 512
MAX_RUN = (1 << 16) - 1


def _chunk_rows(part: pa.Array, bits: int) -> pa.RecordBatch | None:
    sets: dict[int, np.ndarray] = {}
    for body in blobs(part):
        s = shingles(body)
        if len(s):
            sets.setdefault(class_key(s), s)
    if not sets:
        return None
    keys = np.fromiter(sets, np.int64, len(sets))
    flat = np.concatenate(list(sets.values()))
    owner = np.repeat(np.arange(len(keys)), [len(s) for s in sets.values()])
    ranges = (flat >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(flat), np.int32)
    order = np.argsort(ranges, kind="stable")  # by range, then text
    flat, owner, ranges = flat[order], owner[order], ranges[order]
    at = np.arange(len(flat))
    first = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(ranges) != 0)])
    first |= (at - np.maximum.accumulate(np.where(first, at, 0))) % MAX_RUN == 0
    runs = np.flatnonzero(first)
    lengths = np.diff(np.append(runs, len(flat)))
    of_range = np.flatnonzero(np.concatenate([[True], np.diff(ranges[runs]) != 0]))
    run_ends = np.append(of_range[1:], len(runs))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ranges[runs[of_range]]),
            _binary_rows(keys[owner[runs]].astype("<i8").view(np.uint8), run_ends * 8),
            _binary_rows(lengths.astype("<u2").view(np.uint8), run_ends * 2),
            _binary_rows(_low_bytes((flat << np.uint64(bits)) >> np.uint64(16)), np.cumsum(lengths)[run_ends - 1] * 6),
        ],
        ["hash_range", "keys", "lengths", "packed"],
    )


def packed_shingles(docs: DataFrame, text: str, bits: int) -> DataFrame:
    """One row for each chunk of texts and hash range, so rows don't grow with ranges times texts."""
    with_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_TEXTS):
                made = _chunk_rows(batch.column(0).slice(at, CHUNK_TEXTS), bits)
                if made is not None:
                    yield made

    return docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(run, PACKED)


class _Range:
    """The shingles of one hash range as they come in, held until it is known who shares them."""

    def __init__(self) -> None:
        self.tokens, self.keys = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.common = np.zeros(0, np.uint64)

    def add(self, tokens: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take rows in; give out those of common shingles."""
        known = np.isin(tokens, self.common)
        if known.any():
            yield self._shared(tokens[known], keys[known], np.full(known.sum(), COMMON))
        self.tokens = np.concatenate([self.tokens, tokens[~known]])
        self.keys = np.concatenate([self.keys, keys[~known]])
        counts = self._count()
        many = counts > COMMON
        if many.any():
            self.common = np.union1d(self.common, self.tokens[many])
            yield self._shared(self.tokens[many], self.keys[many], np.full(many.sum(), COMMON))
            self.tokens, self.keys = self.tokens[~many], self.keys[~many]

    def _count(self) -> np.ndarray:
        """Sort the held rows, drop repeated ones, and count each row's classes."""
        order = np.lexsort((self.keys, self.tokens))
        tokens, keys = self.tokens[order], self.keys[order]
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = tokens[1:] != tokens[:-1]
        first = fresh.copy()
        first[1:] |= keys[1:] != keys[:-1]
        self.tokens, self.keys = tokens[first], keys[first]
        starts = np.flatnonzero(fresh[first])
        counts = np.diff(np.append(starts, len(self.tokens)))
        return np.repeat(counts, counts)

    def rest(self) -> Iterator[pa.RecordBatch]:
        counts = self._count()
        several = counts > 1
        if several.any():
            yield self._shared(self.tokens[several], self.keys[several], counts[several])

    @staticmethod
    def _shared(tokens: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """One row for each class: its shared shingles, and how many classes have each."""
        order = np.lexsort((tokens, keys))
        tokens, keys, counts = tokens[order], keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(starts[1:], len(keys))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys[starts]),
                pa.array((ends - starts).astype(np.int32)),
                _binary_rows(tokens.astype("<u8").view(np.uint8), ends * 8),
                _binary_rows(counts.astype("<u2").view(np.uint8), ends * 2),
            ],
            ["key", "shared", "tokens", "counts"],
        )


def _unpacked(rows: list[tuple[int, bytes, bytes, bytes]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (range and the 48 bits, or as many as the hash has, below) and the class key of each."""
    blob = b"".join(r[3] for r in rows)
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    lengths = np.frombuffer(b"".join(r[2] for r in rows), "<u2").astype(np.int64)
    keys = np.repeat(np.frombuffer(b"".join(r[1] for r in rows), "<i8"), lengths)
    top = np.repeat([r[0] for r in rows], [len(r[3]) // 6 for r in rows]).astype(np.uint64)
    spare = np.uint64(max(bits - 16, 0))  # zeros below the hash's last bit
    return (wide.reshape(-1).view("<u8") >> spare) | (top << (np.uint64(48) - spare)), keys


def shared_shingles(packed: DataFrame, bits: int) -> DataFrame:
    """What of a class's shingles others have, by class. The rows of a hash range come
    together, and a task holds one range at a time.
    """
    if bits <= TASK_BITS:
        packed = packed.repartitionById(1 << bits, F.col("hash_range"))
    else:
        task = F.shiftright("hash_range", bits - TASK_BITS)
        packed = packed.repartitionById(1 << TASK_BITS, task).sortWithinPartitions("hash_range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, waiting, size = None, _Range(), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    if row[0] != current:
                        if waiting:
                            yield from state.add(*_unpacked(waiting, bits))
                        yield from state.rest()
                        current, state, waiting, size = row[0], _Range(), [], 0
                    waiting.append(row)
                    size += len(row[3])
                    if size > 6 * RANGE_SHINGLES // 2:
                        yield from state.add(*_unpacked(waiting, bits))
                        waiting, size = [], 0
        if waiting:
            yield from state.add(*_unpacked(waiting, bits))
        yield from state.rest()

    return packed.mapInArrow(run, "key bigint, shared int, tokens binary, counts binary")


def prefix_length(n: int) -> int:
    """So many of a set's first shingles hold one of any linked set's first ones."""
    return n - (PERCENT * n + 99) // 100 + 1


def near_copies(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """Classes that share enough to link at all: key, n, tokens (sorted) and prefix.
    ``sizes`` has each class's key and its set's size n.

    A class's rows, one for each hash range at most, come together; what only this class
    has sorts before all else, so the prefix is cut short by as many.
    """
    by_class = shared.groupBy("key").agg(
        F.sum("shared").alias("shared"), F.collect_list(F.struct("tokens", "counts")).alias("parts")
    )
    enough = by_class.join(sizes, "key").where(100 * F.col("shared") >= PERCENT * F.col("n")).select("key", "n", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                for r in batch.slice(at, 256).to_pylist():
                    tokens = np.frombuffer(b"".join(p["tokens"] for p in r["parts"]), "<u8")
                    counts = np.frombuffer(b"".join(p["counts"] for p in r["parts"]), "<u2")
                    tokens, first = np.unique(tokens, return_index=True)
                    if 100 * len(tokens) < PERCENT * r["n"]:
                        continue
                    rarest = np.lexsort((tokens, counts[first]))[: prefix_length(r["n"]) - (r["n"] - len(tokens))]
                    out.append((r["key"], r["n"], tokens.tobytes(), tokens[rarest].view(np.int64).tolist()))
                if out:
                    keys, ns, sets, prefixes = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(ns, pa.int64()), pa.array(sets, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                        ["key", "n", "tokens", "prefix"],
                    )

    return enough.mapInArrow(run, "key bigint, n bigint, tokens binary, prefix array<bigint>")


# --- steps 3 and 4: clusters, and the links in them -----------------------------------------


#: Prefix shingles that a task groups at once.
POSTINGS = 1_000_000


def _grouped_postings(sets: DataFrame) -> DataFrame:
    """Within a task, classes of one prefix shingle hang on the least of them (edges ``a``, ``b``,
    null ``token``), which alone stands for them outside (``a`` = ``b``, ``token``): a shingle of
    very many classes leaves one row for each task.
    """
    with_package(sets.sparkSession)

    def given(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        prefix = pa.chunked_array([b.column(1) for b in held]).combine_chunks()
        keys = np.concatenate([b.column(0).to_numpy() for b in held])
        keys, tokens = np.repeat(keys, prefix.value_lengths().to_numpy()), prefix.flatten().to_numpy()
        order = np.lexsort((keys, tokens))
        keys, tokens = keys[order], tokens[order]
        first = np.concatenate([[True], tokens[1:] != tokens[:-1]])[: len(tokens)]
        low = keys[np.flatnonzero(first)][np.cumsum(first) - 1]
        apart = keys != low
        a, b = np.concatenate([keys[apart], keys[first]]), np.concatenate([low[apart], keys[first]])
        token = np.concatenate([np.zeros(apart.sum(), np.int64), tokens[first]])
        within = np.arange(len(a)) < apart.sum()
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(token, mask=within)], ["a", "b", "token"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(1).flatten())
            if size >= POSTINGS:
                yield given(held)
                held, size = [], 0
        if size:
            yield given(held)

    return sets.select("key", "prefix").mapInArrow(run, "a bigint, b bigint, token bigint")


def clusters(sets: DataFrame) -> DataFrame:
    """``key`` and ``cluster`` of the classes that share a prefix shingle with another."""
    grouped = _grouped_postings(sets)
    postings = grouped.where("token IS NOT NULL").select("token", "a")
    least = postings.groupBy("token").agg(F.min("a").alias("b"))
    between = postings.join(least, "token").where("a <> b").select("a", "b")
    found = store(connected(grouped.where("token IS NULL").select("a", "b").union(between)), "clusters")
    roots = found.select("root").distinct()
    return found.select(F.col("node").alias("key"), F.col("root").alias("cluster")).union(roots.select("root", "root"))


def _blocks(members: DataFrame) -> DataFrame:
    """Rows (key, n, cluster) with ``block``: a cluster's classes dealt out so that no block
    is too large, and how many ``blocks`` the cluster has."""
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES))
    dealt = members.join(size.select("cluster", blocks.alias("blocks")), "cluster")
    return dealt.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))


def _tree_links(rows: DataFrame, unit: list[str]) -> DataFrame:
    """Links (a, b) within each unit, whose rows have key, n, tokens, grp and side (null:
    any two rows are compared). Rows of a unit come together and one unit is held at a time.
    """
    with_package(rows.sparkSession)
    together = rows.select(*unit, "key", "n", "tokens", "grp", "side").repartition(*unit).sortWithinPartitions(*unit)
    width = len(unit)

    def found(unit_rows: list[tuple]) -> list[tuple[int, int]]:
        keys, sizes, blobs_, groups, sides = zip(*unit_rows, strict=True)
        sets = [np.frombuffer(b, "<u8") for b in blobs_]
        across = None if sides[0] is None else np.asarray(sides)
        return links(np.asarray(keys), np.asarray(sizes, np.int64), sets, np.asarray(groups), across)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, out = None, [], []

        def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*pairs, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True):
                    if row[:width] != current:
                        if held:
                            out += found(held)
                        current, held = row[:width], []
                        if len(out) > 10_000:
                            yield batch_of(out)
                            out = []
                    held.append(row[width:])
        if held:
            out += found(held)
        if out:
            yield batch_of(out)

    return together.mapInArrow(run, "a bigint, b bigint")


def _grouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with ``grp``, the component of the links so far."""
    return members.join(roots, members["key"] == roots["node"], "left").select(
        *members.columns, F.coalesce("root", "key").alias("grp")
    )


def _across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between blocks of clusters that hold several components.

    A component of a block's size or more has blocks of its own, smaller ones share
    blocks, so two blocks of one component are never compared, nor are two whose sizes
    are too far apart.
    """
    size = members.groupBy("cluster", "grp").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    weight = F.greatest(F.col("sets") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES)
    size = size.withColumn("weight", weight)
    small = F.sum(F.when(F.col("weight") < 0.5, F.col("weight"))).alias("small")
    pools = size.groupBy("cluster").agg(small, F.count(F.lit(1)).alias("groups")).where("groups > 1")
    plan = size.join(pools, "cluster").select(
        "cluster", "grp", (F.col("weight") >= 0.5).alias("large"), F.ceil("weight").alias("own"), F.greatest(F.lit(1), F.ceil("small")).alias("pools")
    )
    node = F.when(F.col("large"), F.struct(F.col("grp").alias("of"), F.pmod(F.xxhash64("key"), F.col("own")).alias("k"))).otherwise(
        F.struct(F.lit(None).cast("bigint").alias("of"), F.pmod(F.xxhash64("grp"), F.col("pools")).alias("k"))
    )
    placed = members.join(plan, ["cluster", "grp"]).select("cluster", "key", "n", "grp", F.to_json(node).alias("node"))
    placed = store(placed, "tree_nodes")
    nodes = placed.groupBy("cluster", "node").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("grp").alias("g0"), F.max("grp").alias("g1")
    )
    x, y = nodes.alias("x"), nodes.alias("y")
    differ = ~((F.col("x.g0") == F.col("x.g1")) & (F.col("y.g0") == F.col("y.g1")) & (F.col("x.g0") == F.col("y.g0")))
    sizes = (100 * F.col("x.high") >= PERCENT * F.col("y.low")) & (100 * F.col("y.high") >= PERCENT * F.col("x.low"))
    pairs = x.join(y, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.node") <= F.col("y.node")) & differ & sizes)
    pairs = pairs.select(F.col("x.cluster").alias("cluster"), F.col("x.node").alias("left"), F.col("y.node").alias("right"))
    ends = pairs.select(
        "cluster", "left", "right",
        F.explode(
            F.when(F.col("left") == F.col("right"), F.array(F.struct(F.col("left").alias("node"), F.lit(None).cast("int").alias("side"))))
            .otherwise(F.array(F.struct(F.col("left").alias("node"), F.lit(0).alias("side")), F.struct(F.col("right").alias("node"), F.lit(1).alias("side"))))
        ).alias("end"),
    ).select("cluster", "left", "right", "end.node", "end.side")
    rows = ends.join(placed, ["cluster", "node"]).join(sets.select("key", "tokens"), "key")
    return _tree_links(rows, ["cluster", "left", "right"])


def class_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect all classes whose similarity reaches the threshold.

    Each round's links are contracted together with the stars of the rounds before, not
    with all their links. Classes are dealt out by key and size alone; their sets join where they are compared.
    """
    shingles_of = sets.select("key", "tokens")

    def compared(dealt: DataFrame) -> DataFrame:
        rows = dealt.select("key", "n", "cluster", "block", F.col("key").alias("grp"), F.lit(None).cast("int").alias("side"))
        return store(_tree_links(rows.join(shingles_of, "key"), ["cluster", "block"]), "links")

    members = store(_blocks(sets.select("key", "n").join(clusters(sets), "key")), "tree_blocks")
    found = compared(members)
    large = members.where("blocks > 1").select("key", "n", "cluster")
    if large.isEmpty():
        return found
    while True:
        roots = store(connected(found), "roots")
        grouped = store(_grouped(large, roots), "large_clusters")
        more = compared(_blocks(grouped.where("key = grp").drop("grp")))
        found = roots.toDF("a", "b")
        if more.isEmpty():
            return found.union(_across(grouped, shingles_of))
        found = found.union(more)


# --- step 5 ---------------------------------------------------------------------------------


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, class_key and component_id (its least doc_id) of each document."""
    return _components(docs, text, doc_id).drop("top")


def _components(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``components`` with ``top``, the class that names the component (null without shingles)."""
    rows = store(described(docs, text, doc_id), "shingle_counts")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    bits = max(0, (-(-total // RANGE_SHINGLES) - 1).bit_length())
    packed = packed_shingles(docs, text, bits)
    sizes = rows.where("class_key IS NOT NULL").groupBy(F.col("class_key").alias("key")).agg(F.first("n_shingles").alias("n"))
    sets = store(near_copies(shared_shingles(packed, bits), sizes), "near_copies")
    roots = connected(class_links(sets))
    classes = rows.where("class_key IS NOT NULL").groupBy("class_key").agg(F.min("doc_id").alias("least"))
    joined = classes.join(roots, classes["class_key"] == roots["node"], "left").select(
        "class_key", "least", F.coalesce("root", "class_key").alias("top")
    )
    ids = joined.groupBy("top").agg(F.min("least").alias("component_id"))
    named = joined.select("class_key", "top").join(ids, "top").select(F.col("class_key").alias("of_class"), "component_id", "top")
    out = rows.join(named, rows["class_key"] == named["of_class"], "left")
    own = F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "class_key", own.alias("component_id"), "top")


def without_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Documents of which each component keeps one row of least id, with all their columns.

    Rows that repeat an id are told apart by their classes. Rows without shingles are nobody's
    copies, and rows without id can't be named; both stay.
    """
    found = store(_components(docs, text, doc_id), "components")
    twice = store(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    once = found.where("doc_id <> component_id").select("doc_id")
    if twice.isEmpty():
        gone = store(once, "copies")
        return docs.join(gone, docs[doc_id] == gone["doc_id"], "left_anti")
    gone = store(once.distinct().union(twice).distinct(), "copies")
    left = docs.join(gone, docs[doc_id] == gone["doc_id"], "left_anti")

    def kept(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        own = F.col(name[doc_id])
        keyed = annotate(rows.join(twice, own == twice["doc_id"], "left_semi"), name[text], DESCRIBED, _describe)
        known = keyed.where("class_key IS NOT NULL")
        tops = found.join(twice, "doc_id", "left_semi").where("class_key IS NOT NULL").select(
            F.col("class_key").alias("of_class"), "component_id", "top"
        ).distinct()
        least = known.join(tops, (known["class_key"] == tops["of_class"]) & (own == tops["component_id"]))
        columns = [F.col(n) for n in name.values()]
        one = least.dropDuplicates(["top"]).select(*columns)
        return one.union(keyed.where("class_key IS NULL").select(*columns))

    return left.unionByName(behind(docs, kept))
