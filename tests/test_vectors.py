import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import vectors as v

DIM = 16


@pytest.fixture(scope="module")
def corpus():
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(400, DIM)).astype(np.float32)
    vectors[100:235] = vectors[7]
    return vectors


@pytest.fixture(scope="module")
def emb(spark, corpus):
    data = [
        (f"c{i:03}", "f", "spec" if i % 3 else "discount", f"text {i}", "u", x.tolist())
        for i, x in enumerate(corpus)
    ]
    odd = [
        ("blank", "f", "spec", "", "u", []),
        ("none", "f", "spec", None, "u", None),
        ("zero", "f", "spec", "z", "u", [0.0] * DIM),
        ("short", "f", "spec", "s", "u", [1.0]),
    ]
    schema = (
        "chunk_id string, file_name string, doc_type string, chunk_text string,"
        "source_url string, embedding array<float>"
    )
    return spark.createDataFrame(data + odd, schema).repartition(6).cache()


@pytest.fixture(scope="module")
def questions(spark, corpus):
    data = [(i, corpus[i * 30].astype(float).tolist(), [None, "all", "discount"][i % 3]) for i in range(9)]
    return spark.createDataFrame(data, "query_id int, qvec array<double>, doc_filter string")


def brute_force(corpus, questions, k):
    unit = corpus.astype(float) / np.linalg.norm(corpus.astype(float), axis=1, keepdims=True)
    found = set()
    for row in questions.collect():
        q = np.asarray(row.qvec)
        scores = np.round(unit @ (q / np.linalg.norm(q)), 6)
        wanted = None if row.doc_filter in (None, "all") else row.doc_filter
        ids = [
            i for i in range(len(corpus))
            if wanted is None or ("spec" if i % 3 else "discount") == wanted
        ]
        best = sorted(ids, key=lambda i: (-scores[i], i))[:k]
        found |= {(row.query_id, rank + 1, f"c{i:03}") for rank, i in enumerate(best)}
    return found


def test_batch_equals_brute_force_with_ties_and_filters(emb, corpus, questions, monkeypatch):
    for per_tile in (2048, 2):
        monkeypatch.setattr(v, "QUESTIONS_PER_TILE", per_tile)
        hits = v.similarity_topk_batch(emb, questions, 6)
        got = {(r.query_id, r["rank"], r.chunk_id) for r in hits.collect()}
        assert got == brute_force(corpus, questions, 6)


def test_a_question_of_another_length_costs_only_its_own_hits(spark, emb, corpus):
    data = [(i, corpus[i].astype(float).tolist(), k) for i, k in enumerate([None, 0, 3, 7])]
    data += [(8, [1.0] * (2 * DIM), 5), (9, [1.0], 5), (10, [], 5), (11, None, 5), (12, [0.0] * DIM, 5)]
    for kind in ("smallint", "decimal(9,0)", "string"):
        asked = spark.createDataFrame(data, "query_id int, qvec array<double>, top_k int")
        asked = asked.withColumn("query_id", F.col("query_id").cast(kind))
        counts = v.similarity_topk_batch(emb, asked).groupBy("query_id").count().collect()
        assert {int(r.query_id): r["count"] for r in counts} == {0: 5, 1: 5, 2: 3, 3: 7, 9: 1}


def test_single_vector_and_default_k(emb, corpus):
    hits = v.similarity_topk(emb, corpus[7], None).orderBy("rank").collect()
    assert [h.chunk_id for h in hits] == ["c007", "c100", "c101", "c102", "c103"]
    assert v.similarity_topk(emb, [0.0] * DIM).count() == 0
    assert v.similarity_topk(emb, corpus[7], 500).count() == 400


def test_cell_index_with_all_cells_is_exact(emb, corpus, questions):
    index = v.cell_index(emb, DIM, cells=8, probed=8)
    assert index.rows.count() == len(corpus)  # each chunk once
    got = {(r.query_id, r["rank"], r.chunk_id) for r in v.search_cells(index, questions, 6).collect()}
    assert got == brute_force(corpus, questions, 6)


def test_cell_index_looks_on_until_it_has_enough(spark, emb, questions):
    index = v.cell_index(emb, DIM, cells=16, probed=1)
    near = v.search_cells(index, questions, 60)
    assert {r["count"] for r in near.groupBy("query_id").count().collect()} == {60}
    assert v.search_cells(index, spark.createDataFrame([(1, [1.0]), (2, None)], "query_id int, qvec array<double>")).count() == 0
    assert v.search_cells(v.cell_index(emb.limit(0), DIM), questions).count() == 0


def test_cell_index_recall(emb, questions):
    asked = questions.drop("doc_filter")
    near = v.search_cells(v.cell_index(emb, DIM), asked, 6).select("query_id", "chunk_id")
    exact = v.similarity_topk_batch(emb, asked, 6).select("query_id", "chunk_id")
    assert near.intersect(exact).count() >= 0.9 * exact.count()


def test_cell_search_scores_tiles_and_returns_repeated_rows_each(spark, emb, corpus, questions, monkeypatch):
    twice = emb.unionByName(emb.where("chunk_id = 'c030'"))
    for per_tile in (8192, 20):
        monkeypatch.setattr(v, "QUESTIONS_PER_TILE", per_tile)
        monkeypatch.setattr(v, "CHUNKS_PER_TILE", per_tile)
        near = v.search_cells(v.cell_index(twice, DIM, cells=8, probed=8), questions.drop("doc_filter"), 2)
        plan = near._jdf.queryExecution().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "zip_with" not in plan  # no row for each pair
        found = sorted((r["rank"], r.chunk_id, r.chunk_text) for r in near.where("query_id = 1").collect())
        assert found == [(1, "c030", "text 30"), (2, "c030", "text 30")]


def test_tiles_of_chunks_do_not_multiply_with_tiles_of_questions(spark, emb, corpus, monkeypatch):
    monkeypatch.setattr(v, "QUESTIONS_PER_TILE", 40)
    data = [(i, x.astype(float).tolist()) for i, x in enumerate(corpus)]
    hits = v.similarity_topk_batch(emb, spark.createDataFrame(data, "query_id int, qvec array<double>"), 3)
    plan = hits._jdf.queryExecution().analyzed().toString()
    # eleven tiles of questions on eight tasks: each question meets one tile of chunks
    assert "explode(sequence(0, (1 - 1)" in plan or "explode(sequence(0, 0" in plan
    assert hits.count() == 3 * len(corpus)


def test_pairs_ruled_out_in_single_precision_change_no_hit():
    rnd = np.random.default_rng(5)
    vectors = rnd.normal(size=(300, 8))
    vectors[100:200] = vectors[0] + rnd.normal(size=(100, 8)) * 3e-7  # apart by less than single precision
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    asked, top_k = vectors[:20], np.array([0, 1, 5, 300, 400] * 4)
    rows, columns, scores = v._best_of_block(asked, vectors, vectors.astype(np.float32), top_k)
    for q in range(20):
        full = np.round(np.einsum("ij,ij->i", np.broadcast_to(asked[q], vectors.shape), vectors), 6)
        best = np.lexsort((np.arange(300), -full))[: top_k[q]]
        assert columns[rows == q].tolist() == best.tolist() and scores[rows == q].tolist() == full[best].tolist()


def test_embedding_is_unit_length_and_blank_is_empty(spark):
    df = spark.createDataFrame(
        [(1, "Laptop battery battery"), (2, "  \n"), (3, None), (4, "laptop warranty")],
        "id int, t string",
    )
    model = v.fit_embedder(df, "t", 32)
    out = v.embed(df, "t", model)
    assert dict(out.dtypes)["embedding"] == "array<float>" and out.columns == ["id", "t", "embedding"]
    found = {r.id: r.embedding for r in out.collect()}
    assert found[2] == found[3] == []
    assert len(found[1]) == 32 and abs(np.linalg.norm(found[1]) - 1) < 1e-6


def test_texts_are_embedded_without_a_frame_of_them(spark):
    df = spark.createDataFrame([(1, "laptop"), (2, " "), (3, "drill laptop"), (4, None), (5, "...")], "id int, t string")
    out = v.embed(df.repartition(1), "t", v.fit_embedder(df, "t", 8))
    assert ", 204" not in out._jdf.queryExecution().executedPlan().toString()  # texts as frames of strings
    found = {r.id: r.embedding for r in out.collect()}
    assert [len(found[i]) for i in (1, 2, 3, 4, 5)] == [8, 0, 8, 0, 8] and found[5] == [0.0] * 8


def test_hit_lists_survive_json(emb, questions):
    hits = v.similarity_topk_batch(emb, questions, 3)
    lists = v.hits_to_json(hits)
    assert lists.count() == 9
    back = v.json_to_hits(lists)
    columns = ["query_id", "chunk_id", "chunk_text", "source_url"]
    assert set(back.select(columns).collect()) == set(hits.select(columns).collect())


def test_null_fields_stay_in_the_hit_list(spark):
    hits = spark.createDataFrame(
        [(1, 1, "c", "f", "t", None, "u")],
        "query_id int, rank int, chunk_id string, file_name string, doc_type string,"
        "chunk_text string, source_url string",
    )
    text = v.hits_to_json(hits).first().raw_json
    assert text == (
        '[{"chunk_id":"c","file_name":"f","doc_type":"t","chunk_text":null,"source_url":"u"}]'
    )


def test_expand_query(spark):
    df = spark.createDataFrame([("Laptop 14",)], "p string")
    text = df.select(v.expand_query("warranty", F.col("p"))).first()[0]
    assert text == "warranty support guarantee return policy Laptop 14"
