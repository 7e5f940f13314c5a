import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from earlybell.llm import bpe, packing, tokens
from tests.llm.cases import AWKWARD, empty, frame, prose, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mixtures(n=300):
    rng = random.Random(4)
    pieces = list("ab Z9 \n\t'’sé漢½     \u0085​😀.,!?") + ["<|endoftext|>", "  ", "'ll", " the", "Don't"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(n)]


def texts():
    rng = random.Random(8)
    return [*AWKWARD, *mixtures(), *[prose(rng, rng.randrange(1, 900), 9000) for _ in range(30)], " " * 400_000]


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, library):
    all_texts = texts()
    got = tokens.count_tokens(frame(spark, rows(all_texts)), PATH, keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_tokens) for r in got] == [(len((t or "").encode()), len(ids(library, t))) for t in all_texts]


def test_proven_pieces_are_single_tokens(library):
    proven = bpe.load(PATH).single_pieces()
    assert len(proven) > 10_000
    assert all(len(ids(library, " " + p)) == 1 for p in proven[::50])


def test_vocabulary_strings_that_merges_do_not_reach(tmp_path):
    whole = json.loads(open(PATH, encoding="utf-8").read())
    pair = lambda m: "".join(m if isinstance(m, list) else m.split(" "))
    whole["model"]["merges"] = [m for m in whole["model"]["merges"] if pair(m) != "Ġthe"]
    path = str(tmp_path / "cut.json")
    (tmp_path / "cut.json").write_text(json.dumps(whole), encoding="utf-8")
    cut, codec = Tokenizer.from_file(path), bpe.load(path)
    assert len(ids(cut, " the")) > 1 and "the" not in codec.single_pieces()
    counter = bpe.Counter(codec, codec.single_pieces())
    for text in ["see the end", "the the theq", "no such word", "them there"]:
        assert codec.encode(text) == ids(cut, text)
        assert counter.count(text) == len(ids(cut, text))


def test_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    counter = bpe.Counter(bpe.load(PATH), ["the"])
    for t in mixtures(100):
        assert counter.count(t) == len(ids(library, t))
    assert len(counter) < 30


def test_packing_round_trip(spark, library):
    all_texts = texts()
    pieces = packing.pack(frame(spark, rows(all_texts)), PATH, 1, length=64).collect()
    parts: dict[int, list] = {}
    sequences: dict[int, list] = {}
    for p in pieces:
        got = np.frombuffer(p.ids, "<u4").tolist()
        assert len(got) == p.length > 0
        parts.setdefault(p.doc_id, []).append((p.start, got, p.doc_tokens))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for k, t in enumerate(all_texts):
        want = [*ids(library, t), 1]
        at = 0
        for start, got, n in sorted(parts[k]):
            assert start == at and n == len(want)
            assert got == want[at : at + len(got)]
            at += len(got)
        assert at == len(want)
    assert sorted(sequences) == list(range(len(sequences)))
    for k, spans in sequences.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 64 or k == max(sequences)


def test_checksum_is_of_unsigned_32_bit_ids(spark, library):
    from pyspark.sql import functions as F

    piece = packing.pack(frame(spark, rows(["hello world"])), PATH, 1).select(F.crc32("ids").alias("c")).first()
    assert piece.c == zlib.crc32(np.asarray([*ids(library, "hello world"), 1], "<u4").tobytes())


def test_empty_table(spark):
    assert tokens.count_tokens(empty(spark), PATH).count() == 0
    assert packing.pack(empty(spark), PATH, 1).count() == 0
