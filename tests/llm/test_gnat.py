import math
import random

import numpy as np
import pytest

from earlybell.llm import gnat

SCHEMA = "key string, vec_id bigint, label int, embedding array<float>, leaf string, score string, rank string"
SMALL = gnat.Settings(sample=300, fanout=3, leaf_sample=8, chunk=16, block=4)


def frame(spark, data):
    return spark.createDataFrame([("own", i, label, v, "own", "own", "own") for i, label, v in data], SCHEMA).repartition(3)


def takes_part(row, length):
    i, label, v = row
    return i is not None and label is not None and v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)


def brute(data, length, every=100, share=80):
    own = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, label, v in data if takes_part((i, label, v), length)]
    out = []
    for a, (i, label, v) in enumerate(own):
        if i % every:
            continue
        rest = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, m) for b, (j, m, w) in enumerate(own) if b != a)
        for top, p, _ in [r for r in rest if r[2] == label][:5]:
            fits = [(s, n) for s, n, m in rest if m != label and share * -top <= 100 * -s <= 100 * -top]
            out += [(i, p, k + 1, n, -top, -s) for k, (s, n) in enumerate(fits[:5])]
    return sorted(out)


def vectors(rng, n, length=5, first=0):
    """Scattered vectors, tight groups, vectors without a positive product and equal ones."""
    centre = [[rng.gauss(0, 1) for _ in range(length)] for _ in range(6)]
    data = []
    for k in range(n):
        c = rng.choice(centre)
        spread = rng.choice([0, 0.01, 0.3, 2])
        data.append((first + k, rng.randrange(4), [x + rng.gauss(0, spread) if spread else x for x in c]))
    return data


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("settings", [SMALL, gnat.Settings()])
def test_equals_brute_force(spark, settings):
    rng = random.Random(3)
    data = vectors(rng, 900)
    data += [data[100], data[200], data[200]]  # repeated rows, anchors among them
    data += [(100, 1, [rng.gauss(0, 1) for _ in range(5)])]  # an id with another vector
    data += [(None, 1, data[0][2]), (1000, None, data[0][2]), (1100, 1, None), (1200, 1, []), (1300, 1, [1.0, None, 0.0, 0.0, 0.0])]
    data += [(1400, 1, [1.0, math.nan, 0.0, 0.0, 0.0]), (1500, 1, [math.inf, 1.0, 0.0, 0.0, 0.0]), (1600, 1, [1.0, 2.0])]
    data += [(1700, 9, [0.0] * 5), (-100, 2, [-x for x in data[7][2]])]
    assert found(gnat.hard_negatives(frame(spark, data), settings, every=50)) == brute(data, 5, every=50)


def test_windows_with_few_or_no_rows(spark):
    data = [(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 2, [1.0, 0.0]), (100, 3, [1.0, 1.0]), (7, 2, [0.03, 0.0]), (8, 2, [0.02, 0.0])]
    assert found(gnat.hard_negatives(frame(spark, data), SMALL)) == brute(data, 2)
    alone = [(100, 1, [1.0, 0.0]), (3, 2, [1.0, 0.5])]
    assert found(gnat.hard_negatives(frame(spark, alone), SMALL)) == []


def test_share_of_a_score_is_rounded_up(spark):
    """80 % of 7 is 5.6: a score of 5 is outside, 6 inside."""
    data = [(100, 1, [1 / 256, 0.0]), (1, 1, [7 / 256, 0.0]), (2, 2, [5 / 256, 0.0]), (3, 2, [6 / 256, 0.0])]
    assert found(gnat.hard_negatives(frame(spark, data), SMALL)) == [(100, 1, 1, 3, 7, 6)] == brute(data, 2)


def test_one_vector_everywhere(spark):
    data = [(k, k % 3, [0.5, 0.25]) for k in range(301)]
    assert found(gnat.hard_negatives(frame(spark, data), SMALL)) == brute(data, 2)


def test_empty_table(spark):
    assert gnat.hard_negatives(frame(spark, vectors(random.Random(1), 3)).where("false")).count() == 0


def test_only_leaves_without_matches_are_left_out():
    rng = np.random.default_rng(5)
    rows = np.floor(np.concatenate([rng.normal(c, 0.2, (150, 4)) for c in rng.normal(0, 3, (8, 4))]) * 256)
    tree = gnat.plant(rows[::2], SMALL)
    leaf = gnat.place(tree, rows)
    for node, points in enumerate(tree.points):
        k = len(points)
        tree.low[node], tree.high[node] = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        tree.least[node], tree.most[node] = np.full(k, np.inf), np.full(k, -np.inf)
    for at, steps in enumerate(gnat._paths(tree)):
        held = rows[leaf == at]
        for node, j in steps if len(held) else []:
            far, square = gnat.distances(held, tree.points[node]), (held * held).sum(1)
            tree.low[node][:, j] = np.minimum(tree.low[node][:, j], far.min(0))
            tree.high[node][:, j] = np.maximum(tree.high[node][:, j], far.max(0))
            tree.least[node][j], tree.most[node][j] = min(tree.least[node][j], square.min()), max(tree.most[node][j], square.max())
    anchors = rows[::40]
    scores = anchors @ rows.T
    top = np.sort(scores, 1)[:, -6]
    alive = gnat.survivors(tree, anchors, np.ceil(0.8 * top), top)
    for a in range(len(anchors)):
        inside = (scores[a] >= np.ceil(0.8 * top[a])) & (scores[a] <= top[a])
        assert alive[a][leaf[inside]].all()
    assert alive.mean() < 0.5  # and most of the tree is
