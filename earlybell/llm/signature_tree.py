"""Signature tree over shingle sets, and its dual traversal.

Leaves are sets, each with a bitmap of its hashed shingles; a node holds the OR of its
children's bitmaps, the range of their sizes and the largest number of shingles that a
bitmap of theirs hides behind another (its slack). For any two sets below two nodes,
the common bits of the nodes plus the smaller slack bound the overlap; a pair of nodes
is followed only while that bound and the size ranges allow a link.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: Pairs looked at together: 16 MB of bitmap words at 256 words each.
CHUNK = 8_192
#: A link needs PERCENT of the union in common.
PERCENT = 80


def _next_power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


class Level:
    def __init__(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> None:
        self.bits, self.low, self.high, self.slack = bits, low, high, slack

    def parents(self) -> Level:
        at = np.arange(0, len(self.low), FANOUT)
        return Level(
            np.bitwise_or.reduceat(self.bits, at, axis=0),
            np.minimum.reduceat(self.low, at),
            np.maximum.reduceat(self.high, at),
            np.maximum.reduceat(self.slack, at),
        )

    def possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs may hold a link, by sizes and by the largest possible overlap."""
        ok = (100 * self.high[i] >= PERCENT * self.low[j]) & (100 * self.high[j] >= PERCENT * self.low[i])
        for at in range(0, len(i), CHUNK):
            part = np.flatnonzero(ok[at : at + CHUNK]) + at
            a, b = i[part], j[part]
            common = np.bitwise_count(self.bits[a] & self.bits[b]).sum(axis=1, dtype=np.int64)
            overlap = common + np.minimum(self.slack[a], self.slack[b])
            ok[part] = (100 + PERCENT) * overlap >= PERCENT * (self.low[a] + self.low[b])
        return ok


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    out = np.empty((len(sets), width // 64), np.uint64)
    for at in range(0, len(sets), 256):
        part = sets[at : at + 256]
        flat = np.zeros((len(part), width), bool)
        for k, s in enumerate(part):
            flat[k, (s & np.uint64(width - 1)).astype(np.int64)] = True
        out[at : at + 256] = np.packbits(flat, axis=1).view(np.uint64)
    return out


def _descend(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of node pairs (i <= j), each once; n children in all."""
    step = np.arange(FANOUT)
    a = np.broadcast_to((i[:, None] * FANOUT + step)[:, :, None], (len(i), FANOUT, FANOUT)).reshape(-1)
    b = np.broadcast_to((j[:, None] * FANOUT + step)[:, None, :], (len(i), FANOUT, FANOUT)).reshape(-1)
    keep = (a < n) & (b < n) & (a <= b)
    return a[keep], b[keep]


def candidate_pairs(sizes: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves (a < b) that the traversal can't rule out. ``sizes`` may exceed the
    sets' lengths: shingles that no other set has need not be in them."""
    width = min(1 << 15, max(256, _next_power(2 * max(map(len, sets)))))
    bits = bitmaps(sets, width)
    hidden = np.asarray([len(s) for s in sets]) - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    levels = [Level(bits, sizes, sizes, hidden)]
    while len(levels[-1].low) > FANOUT:
        levels.append(levels[-1].parents())
    i, j = np.triu_indices(len(levels[-1].low))
    for depth in range(len(levels) - 1, 0, -1):
        ok = levels[depth].possible(i, j)
        i, j = _descend(i[ok], j[ok], len(levels[depth - 1].low))
    apart = i < j
    i, j = i[apart], j[apart]
    ok = levels[0].possible(i, j)
    return i[ok], j[ok]


def links(
    keys: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], groups: np.ndarray, sides: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Verified links between sets of different groups, as many as it takes to connect what
    is linked: a pair that earlier links connect already is not looked at again.

    ``sides``: only pairs of different sides count. Overlaps are counted exactly.
    """
    if len(keys) < 2:
        return []
    order = np.lexsort((sizes, [int(s[0]) if len(s) else 0 for s in sets]))
    keys, sizes, groups = keys[order], sizes[order], groups[order]
    sets = [sets[k] for k in order]
    sides = sides[order] if sides is not None else None
    _, group = np.unique(groups, return_inverse=True)
    if group.max() == 0:
        return []
    first, second = candidate_pairs(sizes, sets)
    out = []
    by_first = np.argsort(first, kind="stable")
    first, second = first[by_first], second[by_first]
    starts = np.searchsorted(first, np.arange(len(keys) + 1))
    for a in range(len(keys)):
        others = second[starts[a] : starts[a + 1]]
        others = others[group[others] != group[a]]
        if sides is not None:
            others = others[sides[others] != sides[a]]
        for at in range(0, len(others), 256):
            part = others[at : at + 256]
            part = part[group[part] != group[a]]
            if not len(part):
                continue
            for b in part[_linked(sets[a], sizes[a], [sets[k] for k in part], sizes[part])]:
                if group[b] != group[a]:
                    out.append((int(keys[a]), int(keys[b])))
                    group[group == group[b]] = group[a]
    return out


def _linked(one: np.ndarray, size: int, others: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Which of the sets share PERCENT of the union with ``one``."""
    lengths = np.asarray([len(s) for s in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    common = np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum(lengths) - lengths)
    return 100 * common >= PERCENT * (size + sizes - common)
