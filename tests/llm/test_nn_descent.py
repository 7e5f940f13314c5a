import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from earlybell.llm import nn_descent
from earlybell.llm.common import store, table
from earlybell.llm.queries import QUERIES

SCHEMA = "id string, vec_id bigint, embedding array<{}>, rank string, score string, address string, ids string"
SMALL = nn_descent.Settings(neighbours=10, backward=6, shard=64, beam=40, step=10, block=16)


def frame(spark, data, kind="float"):
    return spark.createDataFrame([("own", i, v, "own", "own", "own", "own") for i, v in data], SCHEMA.format(kind)).repartition(3)


def takes_part(row, length):
    i, v = row
    return i is not None and v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(data, length, every=20, count=20):
    """Nearest rows of each query row: lists of (score, id)."""
    own = [(i, np.asarray(v, float)) for i, v in data if takes_part((i, v), length)]
    out = defaultdict(list)
    for a, (i, v) in enumerate(own):
        if i % every == 0:
            out[i].append(sorted((-float(v @ w), j) for b, (j, w) in enumerate(own) if b != a)[:count])
    return out


def grouped(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in out.items()}


def recall(got, want):
    hit = total = 0
    for q, lists in want.items():
        wanted = {j for _, j in lists[0]}
        hit += len(wanted & {j for _, j, _ in got.get(q, [])})
        total += len(wanted)
    return hit / total


def scattered(rng, n, length):
    """Half scattered, half in tight groups; lengths differ."""
    centre = rng.normal(size=(5, length))
    rows = np.where(rng.random((n, 1)) < 0.5, rng.normal(size=(n, length)), centre[rng.integers(5, size=n)] + rng.normal(0, 0.05, (n, length)))
    return (rows * rng.uniform(0.5, 1.5, (n, 1))).astype(np.float32)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_recall_scores_and_order(spark, kind):
    rows = scattered(np.random.default_rng(2), 1500, 12)
    data = [(k, [float(x) for x in v]) for k, v in enumerate(rows)]
    got, want = grouped(nn_descent.nearest(frame(spark, data, kind), SMALL)), brute(data, 12)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
    vectors = {k: v.astype(float) for k, v in enumerate(rows)}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
        assert len({j for _, j, _ in found} - {q}) == 20
        assert all(s == pytest.approx(float(vectors[q] @ vectors[j]), abs=1e-9) for _, j, s in found)


def test_given_table_reaches_the_recall(spark):
    """A query's rows of the smallest given table against brute force."""
    sf = "/root/testdata/sf0.001"
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    data = [(r.vec_id, r.embedding) for r in rows]
    got = grouped(QUERIES["op12_neighbour_search"].build(spark, sf))
    assert recall(got, brute(data, len(data[0][1]))) >= 0.9


def test_defined_cases(spark):
    """Few distinct vectors, so that the answer is exact: copies, ties, rows that take no part."""
    rng = random.Random(4)
    some = [[rng.choice([-1.0, 0.5, 1.0]) for _ in range(3)] for _ in range(9)]
    data = [(k, some[k % 9]) for k in range(300)]
    data += [data[40], data[40], data[7]]  # repeated rows, a query among them
    data += [(60, [0.25, 0.5, 2.0]), (None, some[0]), (400, None), (420, []), (440, [0.0, 0.0, 0.0]), (460, [1.0, None, 0.0])]
    data += [(480, [math.nan, 1.0, 0.0]), (500, [math.inf, 1.0, 0.0]), (520, [1.0, 1.0]), (-20, some[3])]
    got = defaultdict(list)
    for r in nn_descent.nearest(frame(spark, data), SMALL).collect():
        got[r.query_id].append((-r.score, r.vec_id))
    want = brute(data, 3)
    assert set(got) == set(want)
    for q, lists in want.items():
        assert sorted(got[q]) == sorted(x for found in lists for x in found)


@pytest.mark.parametrize("data", [[], [(20, [1.0, 2.0])], [(20, [1.0, 2.0]), (21, [1.0, 0.0])], [(k, [1.0, 0.0]) for k in range(50)]])
def test_small_tables(spark, data):
    got, want = grouped(nn_descent.nearest(frame(spark, data), SMALL)), brute(data, 2)
    assert {q: [(-s, j) for _, j, s in rows] for q, rows in got.items()} == {q: lists[0] for q, lists in want.items() if lists[0]}


def test_queries_that_are_no_nodes(spark):
    rng = np.random.default_rng(8)
    rows, asked = scattered(rng, 1200, 8), scattered(rng, 30, 8)
    nodes = store(nn_descent.as_bytes(frame(spark, list(enumerate(rows.tolist()))).select("vec_id", "embedding"), "<f4"), "nodes")
    graph = nn_descent.build(nodes, "<f4", 8, 21, SMALL)
    queries = spark.createDataFrame([(k, v.tobytes(), None) for k, v in enumerate(asked)], "q bigint, vector binary, start bigint")
    ids = {r.address: r.ids for r in graph.nodes.select("address", "ids").collect()}
    hit = 0
    for r in nn_descent.search(graph, queries).collect():
        found = [i for a in np.frombuffer(r.beam, "<i8") for i in ids[a]][:10]
        hit += len(set(found) & set(np.argsort(-(rows.astype(float) @ asked[r.q].astype(float)), kind="stable")[:10].tolist()))
    assert hit >= 0.9 * 300


def test_backward_edges_are_bounded_and_fresh_first(spark):
    edges = spark.createDataFrame([(k, 1, k >= 90) for k in range(100)], "a bigint, b bigint, fresh boolean")
    kept = nn_descent._backward(edges, 12, 0).agg(F.count(F.lit(1)), F.sum(F.col("fresh").cast("int"))).first()
    assert tuple(kept) == (12, 10)
