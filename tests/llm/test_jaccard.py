import random

import numpy as np
import pytest

from earlybell.llm import graph, jaccard, signature_tree
from tests.llm.cases import AWKWARD, empty, frame, prose, rows


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(a, b):
    common = len(a & b)
    return bool(a and b) and 100 * common >= 80 * (len(a) + len(b) - common)


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=5):
    """Groups of near copies around the threshold, chains, passages in many texts, copies."""
    rng = random.Random(seed)
    texts = list(AWKWARD)
    passage = prose(rng, 40)
    for g in range(12):
        base = prose(rng, rng.choice([6, 30, 80, 200]))
        texts += [edited(rng, base, rng.randrange(0, max(2, len(base.split()) // 15))) for _ in range(12)]
        texts.append(base + " " + passage)
    texts += [prose(rng, 8) + " " + passage for _ in range(25)]
    chain = prose(rng, 120)
    for _ in range(8):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    return texts + texts[5:30]


def result(frame_):
    return [(r.n_shingles, r.component_id) for r in frame_.orderBy("doc_id").collect()]


def test_components_equal_brute_force(spark):
    texts = corpus()
    assert result(jaccard.components(frame(spark, rows(texts)))) == brute(texts)


@pytest.mark.parametrize("common", [4096, 3])
def test_small_blocks_and_ranges_give_the_same(spark, monkeypatch, common):
    """Several hash ranges, blocks and rounds, and shingles passed on as common ones."""
    texts = corpus(9)
    monkeypatch.setattr(jaccard, "RANGE_SHINGLES", 3_000)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2_000)
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard, "POSTINGS", 50)
    monkeypatch.setattr(jaccard, "TASK_BITS", 1)
    assert result(jaccard.components(frame(spark, rows(texts)))) == brute(texts)


def test_without_copies_keeps_one_of_each(spark):
    texts = corpus(2)
    data = rows(texts)
    docs = frame(spark, [*data, *data[20:24], (None, texts[30], None, None, None, None, None, None)])
    got = jaccard.without_copies(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in brute(texts)})
    assert ids.count(None) == 1


def test_without_copies_decides_by_row_where_ids_repeat(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    data = [(3, a), (5, a), (5, b), (9, b), (5, ""), (7, c), (7, d), (7, d), (8, ""), (None, a)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.text) for r in jaccard.without_copies(docs).collect())
    assert got == [(0, a), (3, a), (5, ""), (5, b), (7, c), (7, d), (8, "")]


def test_empty_table(spark):
    assert jaccard.components(empty(spark)).count() == 0
    assert jaccard.without_copies(empty(spark)).count() == 0


def test_tree_loses_no_link():
    rng = np.random.default_rng(1)
    base = [np.sort(rng.choice(2**62, n, replace=False)).astype(np.uint64) for n in (40, 60, 300)]
    sets = []
    for b in base:
        for _ in range(60):
            keep = b[rng.random(len(b)) > rng.choice([0.02, 0.1, 0.2])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**62, rng.integers(0, 8)).astype(np.uint64)])))
    sizes = np.asarray([len(s) for s in sets])
    first, second = signature_tree.candidate_pairs(sizes, sets)
    found = set(zip(first.tolist(), second.tolist(), strict=True))
    true = {
        (a, b)
        for b in range(len(sets))
        for a in range(b)
        if linked(frozenset(sets[a].tolist()), frozenset(sets[b].tolist()))
    }
    assert true and true <= found
    assert len(found) < len(sets) * (len(sets) - 1) / 2  # different bases are pruned


@pytest.mark.parametrize("bits", [0, 7, 16, 21, 30])
def test_shingles_are_packed_whole(bits):
    """What of a shingle's hash lies in the range and in the packed bits tells it from others."""
    import pyarrow as pa

    text = prose(random.Random(3), 400)
    batch = jaccard._chunk_rows(pa.array([text]), bits)
    tokens, keys = jaccard._unpacked(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)), bits)
    whole = jaccard.shingles(text.encode())
    kept = min(64, 48 + bits)
    want = (whole << np.uint64(bits)) >> np.uint64(16) if not bits else (whole >> np.uint64(64 - kept))
    assert sorted(tokens.tolist()) == sorted(want.tolist())
    assert set(keys.tolist()) == {jaccard.class_key(whole)}


@pytest.mark.parametrize("held", [1_000_000, 7])
def test_components_of_chains_and_stars(spark, monkeypatch, held):
    """In one task's stars, and by alternating stars where a task can't hold all edges."""
    monkeypatch.setattr(graph, "EDGES", held)
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == (
        {(k, 0) for k in range(1, 21)} | {(k, 100) for k in range(101, 160)} | {(200, 199)}
    )
