"""Merkle manifest of a dataset: content-addressed records and descents along rank digits.

Every row is a leaf, the hash of its columns with their lengths. Leaves of one group
(language) ascend by id; runs of ``arity`` nodes hash to their parent until one node is
left, the group's subroot; subroots, ordered by group, are the leaves of the tree above.

* **Ranks** come from a range-partitioned sort that is stored once: a row's rank is its
  place in its partition plus the sizes of the group's earlier partitions, so a group that
  holds most rows is sorted by many tasks.
* **Records** (digest to children) are built a segment of ``SEGMENT`` levels at a time: the
  ``arity ** SEGMENT`` nodes of a block meet in one task, which hashes all levels above
  them. A tree over N leaves takes log(N) / log(block) rounds; only block tops go on.
* **Descent**: requests go down from the root, segment by segment. A segment's records are
  joined by the digest of its top; the digits of a request's rank select the child at each
  level, the unselected ones are collected, and the path segment is reversed behind the one
  above. Only distinct prefixes of the requested ranks travel, so the root is no hot key.

Defined cases: null columns hash as ``-``; rows with null ids come first and are never
tampered with; equal ids are ordered by their leaf; repeated rows are leaves of their own;
an empty table gives no rows. Columns besides the five named ones are left out, whatever
their names. Every round is a stored table, which a lost executor's tasks read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earlybell.llm.common import store, with_package

ARITY = 2
#: Levels of one segment; a block holds ARITY ** SEGMENT nodes.
SEGMENT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree string, pos bigint, n bigint, digest binary"
_RECORDS = "records array<struct<digest: binary, children: array<binary>>>"
_PATH = "path array<struct<before: binary, after: binary>>"
#: Name of the tree over the subroots; groups are named '-' (null) or '=' and their value.
TOP = ""


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**columns: Column) -> Column:
    """Digest (binary) of a row's five columns, given in the order in which they are hashed."""
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in columns.values()]), 256))


def tampered(doc_id: Column) -> Column:
    """Whether the drill changes this row: 7 divides the crc32 of its id's digits."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, the leaf and, where the drill changes the row, the leaf of the changed row."""
    own = {c: F.col(f"`{c}`") for c in COLUMNS}
    more = own | {"n_chars": own["n_chars"].cast("decimal(20,0)") + 1}
    changed = tampered(own["doc_id"]) & own["n_chars"].isNotNull()
    return docs.select(
        F.coalesce(F.concat(F.lit("="), own["lang"]), F.lit("-")).alias("tree"),
        own["doc_id"].alias("doc_id"),
        leaf_hash(**own).alias("digest"),
        F.when(changed, leaf_hash(**more)).alias("changed"),
    )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the row's rank in its ``tree`` by ``order``, and ``n``, the tree's size."""
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())  # splits runs of equal rows
    keys = ["tree", *order, "_tie"]
    placed = tie.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    at = F.monotonically_increasing_id()
    laid = store(placed.select("*", F.spark_partition_id().alias("_part"), at.alias("_at")), "merkle_ranks")
    parts = laid.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    tree = Window.partitionBy("tree")
    before = F.sum("_size").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        F.col("tree").alias("_tree"),
        F.col("_part").alias("_of"),
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_base"),
        F.sum("_size").over(tree).alias("n"),
    )
    found = laid.join(parts, (F.col("tree") == F.col("_tree")) & (F.col("_part") == F.col("_of")))
    return found.withColumn("pos", F.col("_at") + F.col("_base")).drop("_part", "_at", "_tree", "_of", "_base")


def join_hash(digests: list[bytes]) -> bytes:
    return sha256(b"".join([d.hex().encode() for d in digests])).digest()


def height(n: int, arity: int = ARITY) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _segments(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """The blocks of one level hashed up to their tops: tree, pos, n, digest and the records between."""
    width = arity**levels
    blocks = nodes.groupBy("tree", "n", F.floor(F.col("pos") / width).cast("long").alias("pos"))
    blocks = blocks.agg(F.sort_array(F.collect_list(F.struct(F.col("pos").alias("at"), "digest"))).alias("own"))
    schema = _parsed(nodes, f"{_NODE}, {_RECORDS}")
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tree, n, pos, own = (c[k].as_py() for c in batch.columns)
                now, records = [x["digest"] for x in own], []
                for _ in range(min(levels, height(n, arity))):
                    runs = [now[i : i + arity] for i in range(0, len(now), arity)]
                    now = [join_hash(r) for r in runs]
                    records += zip(now, runs, strict=True)
                made = [{"digest": d, "children": c} for d, c in records]
                yield _table([(tree, pos, -(-n // width), now[0], made)], arrow)

    return blocks.select("tree", "n", "pos", "own").mapInArrow(run, schema)


def _parsed(df: DataFrame, ddl: str) -> StructType:
    return df.sparkSession.createDataFrame([], ddl).schema


def build(nodes: DataFrame, arity: int = ARITY, levels: int = SEGMENT) -> tuple[list[DataFrame], DataFrame]:
    """Of leaves (tree, pos, n, digest): the records by segment, lowest first, and the roots (tree, n, digest).

    ``n`` of a root is its tree's number of leaves. The loop's length is that of the
    largest tree; trees that have reached their root stay behind.
    """
    with_package(nodes.sparkSession)
    most = nodes.agg(F.max("n")).first()[0] or 0
    sizes = nodes.where("pos = 0").select("tree", F.col("n").alias("size"))
    done, records = [nodes.where("n = 1").select("tree", "digest")], []
    now = nodes.where("n > 1").select("tree", "pos", "n", "digest")
    while most > 1:
        made = store(_segments(now, arity, levels), "merkle_records")
        records.append(made.select("digest", "records"))
        done.append(made.where("n = 1").select("tree", "digest"))
        now = made.where("n > 1").select("tree", "pos", "n", "digest")
        most = -(-most // arity**levels)
    roots = reduce(DataFrame.union, done).join(sizes, "tree")
    return records, roots.select("tree", F.col("size").alias("n"), "digest")


def descend(
    requests: DataFrame, tops: DataFrame, records: list[DataFrame], arity: int = ARITY, levels: int = SEGMENT
) -> DataFrame:
    """The node at each request's rank, and the siblings of its path from there up to the root.

    ``requests`` has tree, pos (the rank), n and any columns named ``own_*``; ``tops`` has a
    tree's digest, the ``path`` above it (siblings, lowest first) and columns named ``top_*``.
    Returns pos, the ``own_*`` and ``top_*`` columns, ``digest`` and ``path``.
    """
    with_package(requests.sparkSession)
    width = arity**levels
    own = [c for c in requests.columns if c.startswith("own_")]
    kept = [c for c in tops.columns if c.startswith("top_")]
    front = tops.select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path", *kept)
    for s in reversed(range(max(1, len(records)))):
        step, carried = width**s, own if s == 0 else []
        wanted = requests.select("tree", "n", F.floor(F.col("pos") / step).cast("long").alias("at"), *carried)
        wanted = (wanted if s == 0 else wanted.distinct()).groupBy(
            "tree", "n", F.floor(F.col("at") / width).cast("long").alias("pos")
        )
        wanted = wanted.agg(F.collect_list(F.struct("at", *carried)).alias("wanted"))
        met = front.join(wanted, ["tree", "pos"])
        if records:
            met = met.join(records[s].dropDuplicates(["digest"]), "digest", "left")
        else:
            met = met.withColumn("records", F.expr("cast(null as array<struct<digest: binary, children: array<binary>>>)"))
        front = _walk(met, kept, carried, requests.schema, step, arity, levels)
        if s:
            front = store(front, "merkle_paths")
    return front


def _walk(
    met: DataFrame, kept: list[str], carried: list[str], given: StructType, step: int, arity: int, levels: int
) -> DataFrame:
    typed = {f.name: f for f in met.schema.fields} | {f.name: f for f in given.fields}
    columns = ["tree", "pos", "digest", "path", *kept]
    schema = StructType([*[typed[c] for c in columns], *[typed[c] for c in carried]])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tree, top, above, n, wanted, records, *tags = (c[k].as_py() for c in batch.columns)
                children = {r["digest"]: r["children"] for r in records or ()}
                depth = max(0, min(levels, height(-(-n // step), arity)))
                out = []
                for w in wanted:
                    digest, segment = top, []
                    for level in reversed(range(depth)):
                        run_of, digit = children[digest], w["at"] // arity**level % arity
                        segment.append({"before": b"".join(run_of[:digit]), "after": b"".join(run_of[digit + 1 :])})
                        digest = run_of[digit]
                    out.append((tree, w["at"], digest, segment[::-1] + above, *tags, *[w[c] for c in carried]))
                yield _table(out, arrow)

    return met.select("tree", "digest", "path", "n", "wanted", "records", *kept).mapInArrow(run, schema)


def _split(digests: bytes) -> list[bytes]:
    return [digests[i : i + 32] for i in range(0, len(digests), 32)]


def fold(digest: bytes, path: list[dict]) -> bytes:
    """The root that a node and the siblings of its path give."""
    for p in path:
        digest = join_hash([*_split(p["before"]), digest, *_split(p["after"])])
    return digest


def proof_of(path: list[dict]) -> bytes:
    return join_hash([d for p in path for d in _split(p["before"] + p["after"])])


def proofs(docs: DataFrame, arity: int = ARITY, levels: int = SEGMENT) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (digests as hex text)."""
    spark = docs.sparkSession
    rows = ranked(store(leaves(docs), "merkle_leaves"), ["doc_id", "digest"])
    records, subroots = build(rows.select("tree", "pos", "n", "digest"), arity, levels)
    above = ranked(
        subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("own_tree"), "digest"), ["own_tree"]
    )
    above = store(above, "merkle_subroots")
    top_records, roots = build(above.select("tree", "pos", "n", "digest"), arity, levels)
    empty = F.expr("cast(array() as array<struct<before: binary, after: binary>>)")
    top = roots.select("tree", "digest", empty.alias("path"), F.col("digest").alias("top_root"))
    met = descend(above.select("tree", "pos", "n", "own_tree"), top, top_records, arity, levels)
    tops = met.select(
        F.col("own_tree").alias("tree"), "digest", "path", "top_root", F.col("digest").alias("top_subroot")
    )
    requests = rows.select(
        "tree", "pos", "n", F.col("doc_id").alias("own_id"), F.col("changed").alias("own_changed")
    )
    found = descend(requests, store(tops, "merkle_tops"), records, arity, levels)
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    schema = _parsed(docs, f"doc_id {doc_id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, changed, leaf, path, subroot, root in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                folded = fold(changed or leaf, path)
                hexes = [d.hex() for d in (leaf, subroot, root, proof_of(path), folded)]
                out.append((doc, *hexes, folded == root))
            yield _table(out, arrow)

    with_package(spark)
    return found.select("own_id", "own_changed", "digest", "path", "top_subroot", "top_root").mapInArrow(run, schema)
