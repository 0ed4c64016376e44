"""Signature trees and the n-gram Jaccard join against all pairs compared."""

import random
import re

import numpy as np
import pytest

from tallyloom.llm import ngram_join, signature_tree
from tallyloom.llm.queries import QUERIES, table


def plain_shingles(text, words):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return frozenset()
    k = min(words, len(found))
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def plain_classes(docs, words, percent):
    """{(id, shingles, component)}; ids name one text."""
    sets = {i: plain_shingles(t, words) for i, t in docs if i is not None}
    by_set = {}
    for i, s in sets.items():
        by_set.setdefault(s, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def unite(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    distinct = sorted((s for s in by_set if s), key=len)
    for n, a in enumerate(distinct):
        for i in by_set[a][1:]:
            unite(by_set[a][0], i)
        for b in distinct[n + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                unite(by_set[a][0], by_set[b][0])
    smallest = {}
    for i in sets:
        smallest[root(i)] = min(i, smallest.get(root(i), i))
    return sorted((i, len(sets[i]), smallest[root(i)]) for i, _ in docs if i is not None)


def near_texts(seed, groups=12, loose=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5)))
    passage = " ".join(word() for _ in range(55))
    out = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 8, 40, 150, 400]))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    out += [passage + " " + " ".join(word() for _ in range(rng.randint(0, 80))) for _ in range(loose)]
    return out


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    found = QUERIES["op9_ngram_jaccard"](spark, sf_dir).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == plain_classes(docs, 4, 85)


@pytest.mark.parametrize(("seed", "words", "percent", "block"), [(1, 4, 85, 256), (2, 5, 80, 4), (3, 2, 60, 3)])
def test_near_copies(documents, seed, words, percent, block):
    texts = near_texts(seed)
    docs = [(7 * n - 50, t) for n, t in enumerate(texts)]
    docs += [(9000 + n, texts[0]) for n in range(30)]  # copies
    docs += [(9100, None), (9101, ""), (9102, " \n\t"), (9103, "One"), (9104, "one"), (9105, "Été a b"), (9106, "été a b"), (9107, "a b c"), (9108, "x " * 9000)]
    rows = [*docs, (None, "no id"), (None, texts[0]), (9000, texts[0])]
    found = ngram_join.jaccard_classes(documents(rows), words, percent, block_docs=block, block_shingles=2000)
    got = sorted(tuple(r) for r in found.collect() if r[0] is not None)
    assert got == sorted([*plain_classes(docs, words, percent), next(r for r in plain_classes(docs, words, percent) if r[0] == 9000)])
    assert [r["component_id"] for r in found.collect() if r["doc_id"] is None] == [None, None]


def test_no_documents(documents):
    assert ngram_join.jaccard_classes(documents([])).count() == 0
    assert ngram_join.jaccard_classes(documents([(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_trees_find_what_all_pairs_find(seed):
    sets = [ngram_join.shingle_set(t, 3) for t in near_texts(seed)]
    for percent in (60, 85, 100):
        words = signature_tree.bitmap_words(max(map(len, sets)) // (1 + seed))
        expected = signature_tree.Components(len(sets))
        for a in range(len(sets)):
            for b in range(a):
                if signature_tree.links(sets[a], sets[b], percent):
                    expected.join(a, b)
        found, half = signature_tree.Components(len(sets)), len(sets) // 2
        x, y = signature_tree.SignatureTree(sets[:half], words), signature_tree.SignatureTree(sets[half:], words, half)
        compared = sum(signature_tree.join(a, b, percent, found) for a, b in ((x, x), (y, y), (x, y)))
        assert found.roots().tolist() == expected.roots().tolist()
        assert compared < len(sets) * (len(sets) - 1) / 8


def test_links_at_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert signature_tree.links(a, a[:85], 85) and not signature_tree.links(a, a[:84], 85)
    assert not signature_tree.links(a[:0], a[:0], 85)


def test_band_count():
    assert (1 - 0.85**3) ** ngram_join.bands(85) < ngram_join.MISS < (1 - 0.85**3) ** (ngram_join.bands(85) - 1)
