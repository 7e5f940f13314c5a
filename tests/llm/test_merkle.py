import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from earlybell.llm import merkle
from tests.llm.cases import AWKWARD, empty, frame, prose, rows


def H(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(row, more=0):
    values = (row[0], row[3], row[2], None if row[4] is None else row[4] + more, row[1])
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, arity):
    """Root and, for each leaf, the siblings (left, right) of its path."""
    paths, own = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, above = [], []
        for i in range(0, len(nodes), arity):
            run = nodes[i : i + arity]
            for j in range(len(run)):
                for k in own[i + j]:
                    paths[k].append((run[:j], run[j + 1 :]))
            up.append(H(*run))
            above.append([k for o in own[i : i + arity] for k in o])
        nodes, own = up, above
    return nodes[0], paths


def brute(data, arity=2):
    groups = defaultdict(list)
    for r in data:
        groups[(r[2] is not None, (r[2] or "").encode())].append(r)
    keys = sorted(groups)
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subtrees = [tree([leaf(r) for r in groups[k]], arity) for k in keys]
    if not keys:
        return []
    root, ups = tree([s for s, _ in subtrees], arity)
    out = []
    for k, (subroot, paths), up in zip(keys, subtrees, ups, strict=True):
        for r, path in zip(groups[k], paths, strict=True):
            drilled = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded, siblings = leaf(r, int(drilled)), [x for b, a in path + up for x in b + a]
            for before, after in path + up:
                folded = H(*before, folded, *after)
            out.append((r[0], leaf(r), subroot, root, H(*siblings), folded, folded == root))
    return out


def collected(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def data():
    rng = random.Random(6)
    texts = [*AWKWARD, *[prose(rng, rng.randrange(1, 30)) for _ in range(80)]]
    langs = ["de"] * 60 + [None] * 3 + ["Ä", "z"] + ["en"] * (len(texts) - 65)
    made = rows(texts, lang=langs)
    made += [made[70], made[70], made[3]]  # repeated rows
    made += [(70, "another text under a used id", "en", "s", None, *made[0][5:])]
    made += [(None, "no id", "en", None, 5, *made[0][5:]), (-7, "below zero", "en", None, 5, *made[0][5:])]
    return made


@pytest.mark.parametrize(("arity", "levels"), [(2, merkle.SEGMENT), (2, 2), (2, 1), (3, 2)])
def test_proofs_equal_brute_force(spark, arity, levels):
    made = data()
    got = merkle.proofs(frame(spark, made), arity, levels)
    assert collected(got) == sorted(brute(made, arity), key=str)


def test_only_changed_rows_fail(spark):
    made = data()
    changed = {r[0] for r in made if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}
    got = merkle.proofs(frame(spark, made)).collect()
    assert changed and {r.doc_id for r in got if not r.verified} == changed


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    made = data()[:n]
    assert collected(merkle.proofs(frame(spark, made))) == sorted(brute(made), key=str)


def test_empty_table(spark):
    assert merkle.proofs(empty(spark)).count() == 0


def test_some_requests_of_a_stored_tree(spark):
    """Descents of a few ranks give the paths that all ranks get."""
    nodes = [H(str(k)) for k in range(77)]
    leaves = spark.createDataFrame([("t", k, 77, bytes.fromhex(d)) for k, d in enumerate(nodes)], merkle._NODE)
    records, roots = merkle.build(leaves, 2, 3)
    from pyspark.sql import functions as F

    tops = roots.select("tree", "digest", F.expr("cast(array() as array<struct<before: binary, after: binary>>)").alias("path"))
    asked = spark.createDataFrame([("t", k, 77) for k in (0, 5, 64, 76)], "tree string, pos bigint, n bigint")
    root, paths = tree(nodes, 2)
    for r in merkle.descend(asked, tops, records, 2, 3).collect():
        assert r.digest.hex() == nodes[r.pos]
        assert [(p.before.hex(), p.after.hex()) for p in r.path] == [("".join(b), "".join(a)) for b, a in paths[r.pos]]
        assert merkle.fold(r.digest, [p.asDict() for p in r.path]).hex() == root
