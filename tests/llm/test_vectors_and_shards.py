"""Top-k, near-duplicate embeddings and shards against brute force."""

import contextlib
import math
import os
import threading
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import near_embeddings, sharding, topk
from tallyloom.llm.components import connected_components
from tallyloom.llm.queries import QUERIES, table
from tallyloom.session import scratch_root

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1.0, 2) for r in rows], SCHEMA)


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_top_k(rows, k, step):
    ints = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows if i is not None and good(v)}
    out = set()
    for q, v in ints.items():
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints.items() if i != q and len(w) == len(v))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k_query(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect()]
    found = QUERIES["op2_exact_top_k"](spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()
    assert set(map(tuple, found)) == plain_top_k(rows, 5, 50)


def test_top_k_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist(), 0) for i in range(120)]
    rows += [(200 + i, [0.5] * 6, 1) for i in range(60)]  # ties
    rows += [(300, None, 1), (301, [None] * 6, 1), (302, [NAN] * 6, 1), (303, [INF] * 6, 1), (None, [1.0] * 6, 1)]
    rows += [(310, [1.0, 2.0], 1), (320, [3.0, 4.0], 1), (330, [], None), (340, [1e6] * 6, 1)]
    found = topk.top_k(vectors(spark, rows), k=5, query_step=10, block_rows=16, tile_rows=48).collect()
    assert set(map(tuple, found)) == plain_top_k(rows, 5, 10)
    assert topk.top_k(vectors(spark, [])).count() == 0


def test_pruning_skips_blocks():
    seen = []
    blocks = [topk.Block(np.arange(4) + 4 * b, np.full((4, 3), b)) for b in range(50)]
    real, topk.scores = topk.scores, lambda q, r: (seen.append(r.shape), real(q, r))[1]
    try:
        topk.search_tile(np.array([-1]), np.array([[5, 5, 5]]), np.array([topk._NONE]), blocks, 5)
    finally:
        topk.scores = real
    assert sum(shape == (4, 3) for shape in seen) == 2


def plain_near(rows, threshold):
    linked = {i: set() for i, _, _ in rows}
    usable = [(i, np.array(v, np.float64), g) for i, v, g in rows if i is not None and good(v) and g is not None and any(v)]
    for a, (i, v, g) in enumerate(usable):
        for j, w, h in usable[a + 1 :]:
            if g == h and len(v) == len(w) and v @ w / (math.sqrt(v @ v) * math.sqrt(w @ w)) >= threshold:
                linked[i].add(j)
                linked[j].add(i)
    smallest = {}
    for i in linked:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        smallest[i] = None if i is None else min(seen)
    return {(i, len(linked[i]), smallest[i], i is not None and i == smallest[i]) for i in linked}


def test_near_query(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect()]
    assert set(map(tuple, QUERIES["op5_near_embeddings"](spark, sf_dir).collect())) == plain_near(rows, 0.93)


@pytest.mark.parametrize("threshold", [0.93, 0.6])
def test_near_edges(spark, threshold):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 20))
    rows = [(i, (base[i % 6] + rng.normal(size=20) * rng.choice([0.1, 0.4])).astype(np.float32).tolist(), i % 3) for i in range(150)]
    rows += [(500 + i, rows[0][1], 0) for i in range(40)]  # copies
    rows += [(600, None, 0), (601, [None] * 20, 0), (602, [NAN] * 20, 0), (603, [0.0] * 20, 0), (604, rows[0][1], None)]
    rows += [(605, [1.0, 2.0], 0), (606, [2.0, 4.0], 0), (607, [], 0), (608, [1e38] * 20, 1), (609, [1e30] * 20, 1), (None, rows[0][1], 0)]
    found = near_embeddings.near_duplicates(vectors(spark, rows), threshold, tile_rows=16).select("vec_id", "n_links", "component_id", "kept")
    assert set(map(tuple, found.collect())) == plain_near(rows, threshold)
    assert near_embeddings.near_duplicates(vectors(spark, [])).count() == 0


def test_early_stop_loses_no_pair():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(200, 64))
    unit[100:] = unit[:100] + rng.normal(size=(100, 64)) * rng.uniform(0.1, 0.6, size=(100, 1))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    i, j, _ = near_embeddings.linked_pairs(unit, unit, 0.93)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(unit @ unit.T >= 0.93))))


def most_stored(spark, work):
    """The most bytes that files made while ``work`` runs take in Spark's local folders and the scratch folder, looked at now and again."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    tops = [scratch_root(spark), *(f.getPath() for f in local)]

    def sizes():
        found = {}
        for d, _, names in (x for top in tops for x in os.walk(top)):
            for path in (os.path.join(d, n) for n in names):
                with contextlib.suppress(OSError):  # it may be gone
                    found[path] = os.path.getsize(path)
        return found

    before, seen, over = sizes(), [0], threading.Event()

    def look():
        while not over.wait(0.1):
            seen.append(sum(size for path, size in sizes().items() if path not in before))

    looker = threading.Thread(target=look)
    looker.start()
    try:
        work()
    finally:
        over.set()
        looker.join()
    return max(seen)


def test_near_disk_follows_the_rows(spark):
    rng = np.random.default_rng(4)
    rows = vectors(spark, [(i, rng.normal(size=16).tolist(), 0) for i in range(1500)])  # one label, all tiles meet all others
    assert most_stored(spark, lambda: near_embeddings.near_duplicates(rows, tile_rows=16).collect()) < 3_000_000


@pytest.mark.parametrize("span_bytes", [1, 4000])
def test_near_spans(spark, span_bytes):
    rng = np.random.default_rng(6)
    line = np.cumsum(rng.normal(size=(120, 12)) * 0.35, axis=0)  # neighbours link, far ones do not
    cluster = rng.normal(size=12) + rng.normal(size=(90, 12)) * 0.05  # all link
    rows = [(1000 - i, v.tolist(), 0) for i, v in enumerate(line)] + [(2000 + i, v.tolist(), i % 2) for i, v in enumerate(cluster)]
    rows += [(3000 + i, rows[150][1], 0) for i in range(40)] + [(3100 + i, rng.normal(size=5).tolist(), 0) for i in range(30)]
    rows += [(3200 + i, None if i % 2 else [0.0] * 12, 0) for i in range(20)] + [(3300, rows[0][1], None), (None, rows[0][1], 0)]
    rows += [(3400 + i, rng.normal(size=12).tolist(), 10 + i // 2) for i in range(60)]
    rows = [(i, v and np.float32(v).tolist(), g) for i, v, g in rows]
    order = rng.permutation(len(rows))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(batch)
    spark.conf.set(batch, "7")  # copies come in several batches
    try:
        found = near_embeddings.near_duplicates(vectors(spark, [rows[n] for n in order]), tile_rows=8, span_bytes=span_bytes)
        found = list(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect()))
    finally:
        spark.conf.set(batch, old)
    assert len(found) == len(rows) and set(found) == plain_near(rows, 0.93)
    doubles = vectors(spark, rows).selectExpr("vec_id", "cast(embedding as array<double>) embedding", "label")
    found = near_embeddings.near_duplicates(doubles, tile_rows=8, span_bytes=span_bytes)
    assert set(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect())) == plain_near(rows, 0.93)


def test_near_rows_in_any_order():
    """A span meets its own rows by their places, in whatever order they are read."""
    rng = np.random.default_rng(9)
    plain = (rng.normal(size=(12, 10))[np.arange(70) % 12] + rng.normal(size=(70, 10)) * 0.2).astype(np.float32)
    rows = [(5 * n, 1 + n // 50, 10, 1 + n % 3, 900 - n, plain[n].tobytes()) for n in range(70)]
    names = ["place", "label", "dim", "copies", "id", "v"]
    batch = lambda some: pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some])
    shuffled = [rows[n] for n in rng.permutation(70)]
    span = near_embeddings.Span.of(pa.Table.from_batches([batch(r for r in shuffled if r[0] < 300)]))
    meeting = near_embeddings.Meeting(span, {}, 0.93, 8, np.float32)
    found = [*meeting.meet(batch(shuffled[:40])).to_pylist(), *meeting.meet(batch(shuffled[40:])).to_pylist(), *meeting.rest().to_pylist()]
    unit = plain / np.linalg.norm(plain, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (np.arange(70)[:, None] // 50 == np.arange(70) // 50) & ~np.eye(70, dtype=bool)
    linked &= np.minimum.outer(np.arange(70), np.arange(70)) < 60  # places below 300 are the span's
    expected = {900 - n: int(sum(1 + m % 3 for m in np.flatnonzero(linked[n]))) for n in range(70) if linked[n].any()}
    assert len(found) == len(expected) and {r["rep"]: r["links"] for r in found} == expected


@pytest.mark.parametrize("noise", [0.01, 0.1, 0.2])
def test_dense_tiles_lose_no_pair(noise):
    rng = np.random.default_rng(7)
    unit = rng.normal(size=48) + rng.normal(size=(150, 48)) * noise * 3
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    i, j, cosine = near_embeddings.linked_pairs(unit[:100], unit, 0.93)
    there = unit[:100] @ unit.T
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(there >= 0.93))))
    assert np.allclose(cosine, there[i, j])


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (None, 3), (60, 59), (59, 60)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {n: 100 for n in [100, *range(200, 230)]} | {59: 59, 60: 59}
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def check_shards(rows, docs, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in rows if r["doc_id"] is not None) == sorted(
        (False, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs if i is not None
    )
    assert len(rows) == len(docs)
    slots = {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    rows = QUERIES["op4_vector_sharding"](spark, sf_dir).collect()
    check_shards(rows, docs, 8)
    text, by_text, totals = dict(docs), {}, [0] * 8
    for r in rows:
        by_text.setdefault(text[r["doc_id"]], set()).add(r["shard"])
        totals[r["shard"]] += r["size"]
    assert max(totals) - min(totals) <= max(0.02 * sum(totals), max(r["size"] for r in rows))
    assert all(len(s) == 1 for s in by_text.values())


def test_shard_edges(spark, documents):
    rows = [(i, "hot group") for i in range(300)] + [(300 + i, f"text {i} " * (i % 9)) for i in range(600)]
    rows += [(2000, None), (2001, ""), (None, "x"), (5, "hot group"), (5, "hot group")]
    found = sharding.shard_documents(documents(rows), 4).collect()
    check_shards(found, rows, 4)
    counts, sizes = [0] * 4, [0] * 4
    for r in found:
        counts[r["shard"]] += 1
        sizes[r["shard"]] += r["size"]
    assert max(sizes) - min(sizes) <= 0.05 * sum(sizes)
    assert len({r["shard"] for r in found if r["doc_id"] in (2000, 2001)}) == 1
    assert sharding.shard_documents(documents([])).count() == 0


def test_vectors_go_where_the_dot_product_is_highest():
    rng = np.random.default_rng(4)
    items = rng.uniform(1, 5, size=(400, 3))
    placed = sharding.place_vectors(items, 8)
    loads = np.array([items[placed == s].sum(axis=0) for s in range(8)])
    assert (loads.max(axis=0) / loads.mean(axis=0)).max() < 1.03
