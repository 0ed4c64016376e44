"""Signature trees over sets of tokens, and their dual traversal for a Jaccard self-join or join.

A leaf holds a few sets with their bitmaps (a token sets the bit that its hash names); an inner node holds the OR of its
children's bitmaps and the range of their set sizes. Common tokens of a set under X and a set under Y set common bits, so the overlap is at
most the number of bits common to both nodes plus the collisions within a set, and at most the smaller of the largest
sizes. Where that stays below what the threshold asks of the smallest sizes, the pair of nodes is dropped.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
FANOUT = 8
BITS_PER_TOKEN = 8
MOST_WORDS = 4096  # 64-bit words of a bitmap; wider sets only share more bits


class Components:
    """Union-find over the sets of both trees; linked sets need no further comparison."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def root(self, at: int) -> int:
        while self.parent[at] != at:
            self.parent[at] = at = self.parent[self.parent[at]]
        return at

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))], dtype=np.int64)


def bitmap_words(largest: int) -> int:
    """Words for the bitmaps of trees whose largest set has so many tokens."""
    words = 1
    while words * 64 < BITS_PER_TOKEN * largest and words < MOST_WORDS:
        words *= 2
    return words


class SignatureTree:
    """Bulk-loaded over sets (sorted arrays of unsigned 64-bit hashes) numbered ``first``, ``first`` + 1, ..."""

    def __init__(self, sets: list[np.ndarray], words: int, first: int = 0):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        least = np.array([s[0] if len(s) else 0 for s in sets], dtype=np.uint64)
        order = np.lexsort((least, sizes))  # neighbours: of like size, then of like smallest hash
        self.sets = [sets[i] for i in order]
        self.numbers = order + first
        sizes = sizes[order]
        bitmaps = np.zeros((len(sets), words), dtype=np.uint64)
        for row, tokens in enumerate(self.sets):
            set_bits = np.zeros(64 * words, dtype=bool)
            set_bits[(tokens & np.uint64(64 * words - 1)).astype(np.int64)] = True
            bitmaps[row] = np.packbits(set_bits).view(np.uint64)
        collisions = sizes - np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        #: Levels from the sets up to the root: (bitmaps, least size, largest size, most collisions).
        self.levels = [(bitmaps, sizes, sizes, collisions)]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            bits, low, high, extra = self.levels[-1]
            starts = np.arange(0, len(low), width)
            self.levels.append(
                (np.bitwise_or.reduceat(bits, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(extra, starts))
            )
            width = FANOUT

    def width(self, level: int) -> int:
        """Children of a node at this level."""
        return LEAF if level == 1 else FANOUT


def _may_link(x, i: np.ndarray, y, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes, i of level x and j of level y, can hold two sets that link."""
    (bits_x, low_x, high_x, extra_x), (bits_y, low_y, high_y, extra_y) = x, y
    good = (high_x[i] * 100 >= percent * low_y[j]) & (high_y[j] * 100 >= percent * low_x[i])
    at = np.flatnonzero(good)
    for start in range(0, len(at), 4096):
        some = at[start : start + 4096]
        a, b = i[some], j[some]
        common = np.bitwise_count(bits_x[a] & bits_y[b]).sum(axis=1).astype(np.int64) + np.minimum(extra_x[a], extra_y[b])
        overlap = np.minimum(common, np.minimum(high_x[a], high_y[b]))
        good[some] = (100 + percent) * overlap >= percent * (low_x[a] + low_y[b])
    return good


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted arrays without repeats; sets without tokens never link."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def join(x: SignatureTree, y: SignatureTree, percent: int, components: Components) -> int:
    """Join all linked sets of the two trees (or of one tree with itself) in ``components``; returns pairs compared.

    Both trees are gone down together, level by level, with all surviving pairs of nodes at once; sets that the components already
    hold together are not compared again.
    """
    own = x is y
    up_x, up_y = len(x.levels) - 1, len(y.levels) - 1
    if up_x < 0 or up_y < 0 or not len(x.sets) or not len(y.sets):
        return 0
    i, j = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    compared = 0
    stack = [(up_x, up_y, i, j)]
    while stack:
        up_x, up_y, i, j = stack.pop()
        keep = _may_link(x.levels[up_x], i, y.levels[up_y], j, percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if up_x == 0 and up_y == 0:
            for a, b in zip(i.tolist(), j.tolist()):
                m, n = int(x.numbers[a]), int(y.numbers[b])
                if components.root(m) != components.root(n):
                    compared += 1
                    if links(x.sets[a], y.sets[b], percent):
                        components.join(m, n)
            continue
        down_x, down_y = up_x >= up_y, up_y >= up_x
        if down_x:
            i, j = _children(x, up_x, i, j)
        if down_y:
            j, i = _children(y, up_y, j, i)
        up_x, up_y = up_x - down_x, up_y - down_y
        if own:
            once = i < j if up_x == 0 else i <= j
            i, j = i[once], j[once]
        for start in range(0, len(i), 65536):  # bounded work lists
            stack.append((up_x, up_y, i[start : start + 65536], j[start : start + 65536]))
    return compared


def _children(tree: SignatureTree, level: int, nodes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width, below = tree.width(level), len(tree.levels[level - 1][0])
    child = (nodes[:, None] * width + np.arange(width)[None, :]).ravel()
    other = np.repeat(others, width)
    there = child < below
    return child[there], other[there]
