"""BPE, the token store and packing against the tokenizers library and plain restatements."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tallyloom.llm import bpe, encoder, packing, token_store
from tallyloom.llm.queries import QUERIES, table

ODD = [
    None, "", " ", "  ", "\n", "a", "a  b", "a \n b ", "it's <|endoftext|> x", "a  <|endoftext|>", "<|endoftext|>", "don't  'll",
    "日本 語", "x　y", "a\x1c b\x85c", "é" * 50, "-" * 700, "ab" * 4000, "word " * 3000, "\r\n\t x", "😀👩‍👩‍👧 ok", "1234 5 ²",
]


@pytest.fixture(scope="module")
def library():
    return encoder.load_tokenizer(encoder.vocabulary_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=5):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "'s", "9", ".", "!!", "<|endoftext|>", "\x1c", "\x85", "日本", "😀", "%%%", "-" * 30]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_both_encoders_equal_the_library(library):
    texts = [t or "" for t in ODD] + random_texts(4000)
    expected = [ids_of(library, t) for t in texts]
    memo = encoder.MemoEncoder(encoder.vocabulary_path(), memo_pieces=50)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in memo.encode(texts)] == expected
    own = bpe.ForcedBoundaryBpe(encoder.vocabulary_path())
    assert [own.encode(t) for t in texts] == expected
    assert [own.decode(i) for i in expected] == [library.decode(i, skip_special_tokens=False) for i in expected]


def test_forced_boundaries_are_used():
    own = bpe.codec()
    assert own.cut_at_spaces
    assert b"".join(own.fragments("Ωé\x00q日".encode())) == "Ωé\x00q日".encode()
    assert any(len(own.fragments(p.encode())) > 1 for p in ("Ω日", "\x00q", "日é"))


def test_round_trip_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op3_bpe_round_trip"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_encode_and_decode_rows(spark, documents):
    docs = documents([*enumerate(ODD), (None, "no id"), (3, "again"), (3, "again")])
    ids = bpe.encode_texts(docs)
    back = sorted(map(tuple, bpe.decode_ids(ids).collect()), key=str)
    assert back == sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=str)
    assert bpe.round_trip_digests(docs).count() == len(ODD) + 3
    assert bpe.encode_texts(docs.limit(0)).count() == 0


def test_minimal_perfect_hash():
    keys = np.arange(-500, 1500, dtype=np.int64) * 977
    nulls, occurrences = np.zeros(2000, np.uint8), np.zeros(2000, np.int32)
    occurrences[:10] = 0
    seed, displacements, slots = token_store.build_index(keys, nulls, occurrences)
    assert sorted(slots.tolist()) == list(range(2000))
    shard = token_store.Shard(
        token_store.pack_shard(0, keys.tolist(), occurrences.tolist(), [np.arange(i % 7, dtype="<u4").tobytes() for i in range(2000)], 2)
        + token_store.TRAILER
    )
    assert shard.find(keys, nulls, occurrences).tolist() == list(range(2000))
    assert (shard.find(keys + 1, nulls, occurrences) < 0).all()
    assert shard.ids_at(13).tolist() == list(range(6))
    with pytest.raises(ValueError):
        token_store.Shard(b"cut off")


def check_store(rows, docs, library):
    expected = {}
    for doc_id, text in docs:
        ids = [*ids_of(library, text), 0]
        expected.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got, at = {}, 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda k: (k is not None, k))


def test_token_store_query(spark, sf_dir, library):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    check_store(QUERIES["op10_token_store"](spark, sf_dir).collect(), docs, library)


def test_token_store_edges(spark, documents, library, tmp_path):
    rows = [*((i * 5 - 20, t) for i, t in enumerate(ODD)), (None, "no id"), (None, "no id"), (10, "again"), (10, "again")]
    folder = f"file://{tmp_path}/store"
    token_store.write_tokens(documents(rows), folder, partitions=3, shard_ids=500)
    check_store(token_store.read_documents(spark, folder).collect(), rows, library)
    wanted = spark.createDataFrame([(-20,), (5,), (10,), (11,), (None,)], "doc_id long")
    found = {r["doc_id"]: r["ids"] for r in token_store.lookup(spark, folder, wanted).collect()}
    assert set(found) == {-20, 5, 10}
    assert found[5] == [*ids_of(library, "a"), 0]


def test_token_store_of_nothing(spark, documents, tmp_path):
    folder = f"file://{tmp_path}/none"
    token_store.write_tokens(documents([]), folder)
    assert token_store.read_documents(spark, folder).count() == 0


def plain_best_fit(lengths, capacity):
    """Number of sequences of best-fit decreasing, one piece at a time."""
    room = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in range(len(room)) if room[r] >= length]
        if fitting:
            room[min(fitting, key=lambda r: room[r])] -= length
        else:
            room.append(capacity - length)
    return sorted(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))] + [3] * rng.randint(0, 50)
    counts = {n: lengths.count(n) for n in set(lengths)}
    used, ranks = {}, {n: set() for n in counts}
    for length, first, number, sequence, offset in packing.plan_packing(counts, capacity):
        ranks[length] |= set(range(first, first + number))
        for s in range(sequence, sequence + number):
            assert used.get(s, 0) == offset
            used[s] = offset + length
    assert {n: len(r) for n, r in ranks.items()} == counts
    assert sorted(capacity - u for u in used.values()) == plain_best_fit(lengths, capacity)


@pytest.mark.parametrize("seed", range(40))
def test_plan_of_few_lengths_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([100, 2048])
    counts = {rng.randint(1, capacity // rng.choice([1, 3, 9])): rng.randint(1, 90) for _ in range(rng.randint(1, 6))}
    if not seed:
        capacity, counts = 100, {51: 2, 24: 2, 16: 3}
    used, ranks = {}, {n: [] for n in counts}
    for length, first, number, sequence, offset in packing.plan_packing(counts, capacity):
        ranks[length] += range(first, first + number)
        for s in range(sequence, sequence + number):
            assert used.get(s, 0) == offset
            used[s] = offset + length
    assert all(sorted(r) == list(range(counts[n])) for n, r in ranks.items())
    assert sorted(capacity - u for u in used.values()) == plain_best_fit([n for n, c in counts.items() for _ in range(c)], capacity)
    assert seed or len(used) == 2


def check_packing(rows, docs, library, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    expected = [packing.cut_points(len(ids_of(library, t)) + 1, capacity) for _, t in docs]
    assert len(rows) == sum(map(len, expected))
    for doc_id, text in docs:
        ids = [*ids_of(library, text), 0]
        own = [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc_id]]
        for piece, (start, length) in enumerate(packing.cut_points(len(ids), capacity)):
            assert (piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())) in own
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    assert len(by_sequence) == len(plain_best_fit([n for cuts in expected for _, n in cuts], capacity))


def test_packing_query(spark, sf_dir, library):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    check_packing(QUERIES["op1_best_fit_packing"](spark, sf_dir).collect(), docs, library, 2048)


def test_packing_edges(documents, library):
    rows = [*enumerate(ODD), (None, "no id"), (3, "again"), (3, "again")]
    packed = packing.pack_documents(documents(rows), capacity=16)
    check_packing(packed.collect(), rows, library, 16)
    assert packing.pack_documents(documents([])).count() == 0
    assert packing.cut_points(4097, 2048) == [(0, 1), (1, 2048), (2049, 2048)]
    assert packing.cut_points(4096, 2048) == [(0, 2048), (2048, 2048)]
