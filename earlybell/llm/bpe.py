"""Byte-level BPE shared by the token counter and the packer.

``Codec`` gives the ids that the ``tokenizers`` library gives for the same file. The
vocabulary of a byte-level BPE file lists its merges in rank order, so the same ids
come from ``tiktoken``'s merge loop, which is several times faster; texts that hold
one of the file's special strings, texts its pattern engine gives up on, and texts
with an id whose string the merge list doesn't reach, go to the ``tokenizers``
library itself.
"""

from __future__ import annotations

import os

import numpy as np

# The pre-tokeniser pattern of byte-level BPE files without own pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE_PIECES = 300_000
_LOADED: dict[str, Codec] = {}


def load(path: str) -> Codec:
    """The codec of a file, once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        of_char = _byte_chars()
        self.vocabulary = {
            bytes(of_char[c] for c in word): i
            for word, i in self.library.get_vocab(with_added_tokens=False).items()
            if word not in self.special
        }
        self.merger = tiktoken.Encoding(
            "file", pat_str=PATTERN, mergeable_ranks=self.vocabulary, special_tokens={}
        )
        self.unproven = self._unproven()

    def _unproven(self) -> frozenset[int]:
        """Ids whose strings the merge list gives otherwise: ``tiktoken`` looks a whole piece up
        without merging. Bytes that are no text are no whole piece."""
        known = []
        for word, i in self.vocabulary.items():
            try:
                known.append((word.decode(), i))
            except UnicodeDecodeError:
                continue
        encoded = self.library.encode_batch([w for w, _ in known], add_special_tokens=False)
        return frozenset(i for (_, i), e in zip(known, encoded, strict=True) if e.ids != [i])

    def encode(self, text: str) -> list[int]:
        if not any(s in text for s in self.special):
            try:
                ids = self.merger.encode_ordinary(text)
                if self.unproven.isdisjoint(ids):
                    return ids
            except (KeyboardInterrupt, SystemExit):
                raise
            except BaseException:  # noqa: BLE001  the pattern engine's panic is no Exception
                pass
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 16-bit numbers."""
        return np.asarray(self.encode(text), "<u2").tobytes()

    def single_pieces(self) -> list[str]:
        """Pieces proven to be one token behind a space, by the library's merge list.

        A vocabulary string need not encode as itself when merges of lower rank take its
        parts elsewhere, so every string is put to the proof.
        """
        words = (w.decode("utf-8", "ignore") for w in self.vocabulary if w[:1] == b" ")
        pieces = sorted({w[1:] for w in words if safe(w[1:])})
        encoded = self.library.encode_batch([" " + p for p in pieces], add_special_tokens=False)
        return [p for p, e in zip(pieces, encoded, strict=True) if len(e.ids) == 1]


def safe(piece: str) -> bool:
    """A piece between two single spaces that is tokenised alike alone and in its text.

    The pattern attaches exactly one space to what follows it, and its only look-ahead
    concerns runs of white space; so the piece must not be empty nor start or end with
    white space.
    """
    return bool(piece) and not piece[0].isspace() and not piece[-1].isspace()


class _Whole(Exception):
    """A piece that only its whole text can tokenise."""


class Counter(dict):
    """Token counts of whole texts; as a dict, the counts of pieces behind a space.

    Proven pieces are in it from the start and count one; any other piece is merged
    once and kept, until the cache is full and starts anew.
    """

    def __init__(self, codec: Codec, single: list[str]) -> None:
        super().__init__(dict.fromkeys(single, 1))
        self.codec, self.single = codec, single

    def __missing__(self, piece: str) -> int:
        if not safe(piece):
            raise _Whole
        if len(self) > CACHE_PIECES + len(self.single):
            self.clear()
            self.update(dict.fromkeys(self.single, 1))
        n = self[piece] = len(self.codec.encode(" " + piece))
        return n

    def count(self, text: str) -> int:
        first, *rest = text.split(" ")
        if not first[-1:].isspace():
            try:
                return len(self.codec.encode(first)) + sum(map(self.__getitem__, rest))
            except _Whole:
                pass
        return len(self.codec.encode(text))
