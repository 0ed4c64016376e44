"""Counting phrases of word ids in a HAT-trie: hash containers under a shallow trie that burst when they grow.

The root leads from a phrase's first word to a subtree. A subtree starts as one container, a hash table from the
other words, packed into one integer, to the count. A container beyond ``burst`` entries turns into a branch with a container for each
next word, and so on down to the last word. When the whole trie passes ``most`` entries, its largest subtrees are
taken out until half of the entries are gone, and come out as one run in the order of ids.
"""

from __future__ import annotations

import numpy as np

ID_BITS = 21  # three ids in one integer
MOST_IDS = 1 << ID_BITS
BURST_ENTRIES = 4096
MOST_ENTRIES = 1_000_000


class Branch:
    """A burst container: next word to container or branch. ``shift`` is how many bits follow the next word."""

    __slots__ = ("children", "shift", "entries")

    def __init__(self, shift: int):
        self.children: dict[int, dict[int, int] | Branch] = {}
        self.shift, self.entries = shift, 0


class HatTrie:
    """Counts of phrases of ``words`` ids each, 1 to 4."""

    def __init__(self, words: int, burst: int = BURST_ENTRIES, most: int = MOST_ENTRIES):
        if not 1 <= words <= 4:
            raise ValueError("phrases of one to four words")
        self.words, self.burst, self.most = words, burst, most
        self.root: dict[int, dict[int, int] | Branch] = {}
        self.entries = 0

    def add(self, columns: list[np.ndarray], times: np.ndarray | None = None) -> None:
        """Count phrases, given as one array of ids for each of their words."""
        if not len(columns[0]):
            return
        if self.words == 1:  # single words share one container
            columns = [np.zeros_like(columns[0]), *columns]
        first = columns[0].astype(np.int64)
        rest = np.zeros(len(first), dtype=np.int64)
        for column in columns[1:]:
            rest = rest << ID_BITS | column.astype(np.int64)
        order = np.lexsort((rest, first)) if self.words == 4 else np.argsort(first << (ID_BITS * (len(columns) - 1)) | rest, kind="stable")
        first, rest = first[order], rest[order]
        new = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])))
        ends = np.append(new[1:], len(first))
        if times is None:
            counts = ends - new
        else:
            counts = np.add.reduceat(times[order], new)
        first, rest, counts = first[new], rest[new].tolist(), counts.tolist()
        heads = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(first)]):
            self._subtree(int(first[a]), rest[a:b], counts[a:b])

    def _subtree(self, word: int, rest: list[int], counts: list[int]) -> None:
        node = self.root.get(word)
        if node is None:
            node = self.root[word] = {}
        had = _entries(node)
        self.root[word] = node = self._insert(node, rest, counts, ID_BITS * (self.words - 2))
        self.entries += _entries(node) - had

    def _insert(self, node, rest: list[int], counts: list[int], shift: int):
        """``node`` with the entries counted in, burst if it has grown too large."""
        if isinstance(node, Branch):
            at, mask = 0, (1 << node.shift) - 1
            while at < len(rest):  # entries come in order, so those of one next word lie together
                word, stop = rest[at] >> node.shift, at + 1
                while stop < len(rest) and rest[stop] >> node.shift == word:
                    stop += 1
                child = node.children.get(word)
                if child is None:
                    child = {}
                had = _entries(child)
                child = self._insert(child, [x & mask for x in rest[at:stop]], counts[at:stop], node.shift - ID_BITS)
                node.children[word] = child
                node.entries += _entries(child) - had
                at = stop
            return node
        seen = node.get
        for key, count in zip(rest, counts):
            node[key] = seen(key, 0) + count
        if len(node) > self.burst and shift > 0:
            keys = sorted(node)
            return self._insert(Branch(shift), keys, [node[k] for k in keys], shift)
        return node

    @property
    def full(self) -> bool:
        return self.entries > self.most

    def spill(self, everything: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """A run (ids, one row a phrase in order; counts) of whole subtrees that leave the trie: all, or the largest until half is gone."""
        left, taken = self.entries // 2, list(self.root)
        if not everything:
            by_size = sorted(taken, key=lambda w: -_entries(self.root[w]))
            gone = np.cumsum([_entries(self.root[w]) for w in by_size])
            taken = by_size[: int(np.searchsorted(gone, self.entries - left)) + 1]
        sizes, rest, counts = [], [], []
        for word in taken:
            node = self.root.pop(word)
            sizes.append(_entries(node))
            _collect(node, 0, rest, counts)
        self.entries -= sum(sizes)
        first, packed = np.repeat(np.array(taken, dtype=np.int64), sizes), np.array(rest, dtype=np.int64)
        order = np.lexsort((packed, first))
        packed = packed[order]
        if self.words == 1:
            return packed[:, None], np.array(counts, dtype=np.int64)[order]
        ids = [first[order]] + [packed >> (ID_BITS * k) & (MOST_IDS - 1) for k in reversed(range(self.words - 1))]
        return np.stack(ids, axis=1), np.array(counts, dtype=np.int64)[order]


def _entries(node) -> int:
    return node.entries if isinstance(node, Branch) else len(node)


def _collect(node, above: int, rest: list[int], counts: list[int]) -> None:
    if isinstance(node, Branch):
        for word, child in node.children.items():
            _collect(child, above | word << node.shift, rest, counts)
    else:
        rest.extend(above | key for key in node) if above else rest.extend(node)
        counts.extend(node.values())
