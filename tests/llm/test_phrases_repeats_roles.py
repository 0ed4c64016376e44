"""Collocations, repeated passages and conversation repair against plain restatements."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from tallyloom.llm import block_anchors, conversations, phrases
from tallyloom.llm.hat_trie import HatTrie
from tallyloom.llm.queries import QUERIES, table
from tallyloom.llm.role_glr import Repair


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_collocations(rows, least=30, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        within = defaultdict(int)
        for p, a in found.items():
            for size, start in product(range(2, len(p)), range(3)):
                if start + size <= len(p):
                    within[p[start : start + size]] = max(within[p[start : start + size]], a)
        scored = []
        for p, a in found.items():
            if 100 * within[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        scored.sort()
        out += [(lang, n, p.decode(), -a, l, r, total[lang], -s) for n, (s, a, p, l, r) in enumerate(scored[:top], 1)]
    return sorted(out)


def plain_repeats(rows, window=35):
    found = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in found for k in range(len(w) - window + 1))
    out = []
    for i, w in found:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def plain_repair(rows):
    """(cost, audit, repaired rows) by a table over (rows read, state) with whole edit strings; states by the words of the pattern."""
    start, after_s, after_u, after_a = range(4)
    step = {(start, "s"): after_s, (start, "u"): after_u, (after_s, "u"): after_u, (after_u, "a"): after_a, (after_a, "u"): after_u}
    names = {"u": "user", "a": "assistant"}
    best = {start: (0, "", ())}

    def put_in(best):
        while True:
            new = dict(best)
            for state, (cost, audit, out) in best.items():
                for sign in "ua":
                    to = step.get((state, sign))
                    if to is not None:
                        new[to] = min(new.get(to, (10**9,)), (cost + 2, audit + "I", (*out, names[sign] + ":")))
            if new == best:
                return best
            best = new

    for role, text, must_go, cut in rows:
        found = {}
        for state, (cost, audit, out) in put_in(best).items():
            options = [(state, cost + 3, "D", out)]
            if not must_go:
                options += [(step.get((state, role[:1])), cost + cut, "K", (*out, f"{role}:{text}"))]
                options += [(step.get((state, s)), cost + cut + 2, "R", (*out, f"{names[s]}:{text}")) for s in "ua"]
            for to, c, letter, o in options:
                if to is not None:
                    found[to] = min(found.get(to, (10**9,)), (c, audit + letter, o))
        best = found
    return min(w for state, w in put_in(best).items() if state in (start, after_a))


def plain_conversations(rows):
    by_id = defaultdict(list)
    for name, turn, role, text in rows:
        mine = by_id[name]
        kind = zlib.crc32(f"{' ' if name is None else name}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for name, mine in by_id.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, counts, repair, illegal = set(), Counter(), [], 0
        for (_, role, text), before in zip(mine, [None, *mine]):
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            repair.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
            illegal += before is not None and before[1][:1] + role[:1] not in ("su", "ua", "au")
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, kept = plain_repair(repair)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((name, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("words", [1, 2, 3, 4])
def test_hat_trie_counts_through_bursts_and_spills(words):
    rng = np.random.default_rng(words)
    plain, spilled = Counter(), Counter()
    trie = HatTrie(words, burst=4, most=60)
    for _ in range(20):
        ids = (rng.zipf(1.4, size=(200, words)) % 40).astype(np.int64)
        plain.update(map(tuple, ids.tolist()))
        trie.add(list(ids.T))
        while trie.full:
            had = trie.entries
            run, counts = trie.spill()
            assert trie.entries <= had // 2 or len(trie.root) == 0
            assert run.tolist() == sorted(run.tolist())
            for row, n in zip(run.tolist(), counts.tolist()):
                spilled[tuple(row)] += n
    run, counts = trie.spill(everything=True)
    for row, n in zip(run.tolist(), counts.tolist()):
        spilled[tuple(row)] += n
    assert spilled == plain and trie.entries == 0


def test_collocations_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = QUERIES["op11_phrase_collocations"](spark, sf_dir)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations([tuple(r) for r in docs.select("lang", "text").collect()])


def test_collocations_of_awkward_texts(spark):
    rng = random.Random(3)
    words = ["New", "york", "CITY", "the", "of", "Été", "x y", "a\tb", "end."]
    rows = [(rng.choice(["en", None, "de"]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for _ in range(300)]
    rows += [(None, None), ("fr", ""), ("fr", " \t "), ("en", "new york city " * 3000), ("en", "new york, city\nnew york")]
    docs = spark.createDataFrame([(lang, text, 1, "p") for lang, text in rows], "lang string, text string, n long, phrase string")
    for least, options in ((5, {}), (30, {"burst": 4, "most": 50})):
        got = sorted(map(tuple, phrases.collocations(docs.repartition(7), least=least, **options).collect()))
        assert got == plain_collocations(rows, least)
    few = sorted(map(tuple, phrases.collocations(docs, top=3).collect()))
    assert few == plain_collocations(rows, 30, 3)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_repeats_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = QUERIES["op12_substring_dedup"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert collected(got) == plain_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])


def passages(seed, window):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é", "cc", "D"]) + rng.choice("xyz")
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.choice([window - 1, window, window + 1, 3 * window])) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 2 * window)) for _ in range(3)] + rng.sample(shared, rng.randint(0, 2)) * rng.choice([1, 1, 2])
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    rows += [(100 + i, rows[5][1]) for i in range(25)] + [(3, rows[3][1]), (3, text(50)), (None, rows[7][1]), (None, None)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "same " * (window + 1)), (204, "once " * window), (205, text(20000))]
    return rows + [(206, "Case " * window), (207, "x" * 100_000 + " " + shared[3])]


@pytest.mark.parametrize("window", [1, 2, 7, 35])
def test_repeats_of_awkward_texts(spark, documents, window):
    rows = passages(window, window)
    got = block_anchors.remove_repeats(documents(rows).repartition(5), window=window)
    assert collected(got) == plain_repeats(rows, window)


def test_repeats_edges(spark, documents, monkeypatch):
    assert block_anchors.remove_repeats(documents([]), window=3).collect() == []
    assert block_anchors.remove_repeats(documents([])).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    with pytest.raises(ValueError):
        block_anchors.remove_repeats(documents([]), window=0)


def test_windows_are_equal_only_within_texts_and_in_order():
    words = np.random.default_rng(0).integers(0, 1 << 62, 70_000).astype(np.uint64)
    words[40_000:40_100] = words[100:200]
    hashes = block_anchors.rolling(words, 50, block_anchors._FACTORS[0])
    assert (hashes[40_000:40_051] == hashes[100:151]).all() and len(np.unique(hashes)) == len(hashes) - 51


def random_rows(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "u", None, "agent", "User"]
    texts = ["Yes.", "No!", "cut off", "", "  ", None, "Why? ", "done.\n", "a. ", "x\u0085", "...", "?"]
    rows = []
    for name in range(400):
        for turn in range(rng.randint(0, 9)):
            likely = ["user", "assistant"][turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((name, rng.choice([turn, turn, turn, turn + 3, None]), likely, rng.choice(texts) if rng.random() < 0.5 else f"text {turn}."))
    rows += [(None, t, r, "Null id.") for t, r in ((0, "user"), (1, "assistant"), (None, "user"))]
    return rows


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert collected(got) == plain_conversations(rows)


def test_repair_of_awkward_rows(spark):
    rows = random_rows(5)
    rows += rows[:40] + [(900, t, "user", f"t{t}.") for t in range(300)] + [(901, t, "tool", f"t{t}.") for t in range(40)]
    schema = "conv_id long, turn long, role string, text string, id string, fault int, there string, copy int"
    frame = spark.createDataFrame([(*r, "x", 9, "y", 7) for r in rows], schema)
    got = conversations.repair_structure(conversations.damage(frame.repartition(6)))
    assert collected(got) == plain_conversations(rows)
    assert conversations.repair_structure(conversations.damage(frame.limit(0))).collect() == []


def test_rows_that_are_all_dropped_leave_their_conversation(spark):
    name = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(name, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    got = conversations.repair_structure(conversations.damage(frame)).collect()
    assert [tuple(r) for r in got] == [(name, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversations_hold_few_open_edits():
    repair, letters, most = Repair(), [], 0
    for n in range(5000):
        letters.append(repair.row("uasux"[n % 5], n % 97 == 0, n % 3 == 0))
        most = max(most, max(len(audit) for _, audit in repair.tops.values()))
    assert most < 40 and len("".join(letters)) > 4900
