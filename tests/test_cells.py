import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import cells, vectors

DIM = 24
SCHEMA = "chunk_id string, doc_type string, chunk_text string, cell int, embedding array<float>"


@pytest.fixture(scope="module")
def corpus():
    """60 clusters of 30 vectors; another third of the rows are copies of one vector."""
    rnd = np.random.default_rng(5)
    heads = rnd.normal(size=(60, DIM))
    spread = np.repeat(heads, 30, axis=0) + rnd.normal(scale=0.25, size=(1800, DIM))
    return np.concatenate([spread, np.repeat(spread[:1], 900, axis=0)]).astype(np.float32)


def kind(i):
    return "rare" if i % 300 == 7 else None if i % 11 == 0 else "spec"


@pytest.fixture(scope="module")
def emb(spark, corpus):
    data = [(f"c{i:04}", kind(i), f"text {i}", 5, x.tolist()) for i, x in enumerate(corpus)]
    odd = [
        ("blank", "spec", "", 1, []),
        ("none", "spec", None, 1, None),
        ("zero", "spec", "z", 1, [0.0] * DIM),
        ("short", "spec", "s", 1, [1.0]),
        ("nan", "spec", "n", 1, [float("nan")] * DIM),
        ("hole", "spec", "h", 1, [None] + [1.0] * (DIM - 1)),
    ]
    return spark.createDataFrame(data + odd, SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def index(emb, tmp_path_factory):
    return cells.train_cells(emb, DIM, str(tmp_path_factory.mktemp("cells") / "index"), 8, 8)


@pytest.fixture(scope="module")
def questions(spark, corpus):
    data = [(i, corpus[i * 53].astype(float).tolist(), [None, "all", "rare", "nothing"][i % 4], [0, None, 12][i % 3]) for i in range(48)]
    data += [(90, [0.0] * DIM, None, 3), (91, None, None, 3), (92, [1.0], None, 3), (93, [float("nan")] * DIM, None, 3)]
    return spark.createDataFrame(data, "query_id int, qvec array<double>, doc_filter string, top_k int")


def brute_force(corpus, questions):
    unit = corpus.astype(float) / np.linalg.norm(corpus.astype(float), axis=1, keepdims=True)
    found = []
    for row in questions.where("query_id < 90").collect():
        q = np.asarray(row.qvec)
        scores = np.round(unit @ (q / np.linalg.norm(q)), 6)
        ids = [i for i in range(len(corpus)) if row.doc_filter in (None, "all") or kind(i) == row.doc_filter]
        best = sorted(ids, key=lambda i: (-scores[i], i))[: row.top_k or 5]
        found += [(row.query_id, rank + 1, f"c{i:04}") for rank, i in enumerate(best)]
    return sorted(found, key=str)


@pytest.mark.parametrize("probed, tile", [(1, 4096), (3, 64), (64, 4096)])
def test_exact_search_equals_comparing_all(index, corpus, questions, rows, monkeypatch, probed, tile):
    monkeypatch.setattr(cells, "TILE_ROWS", tile)
    hits = index.search(questions, None, probed, exact=True)
    assert sorted(rows(hits, "query_id", "rank", "chunk_id"), key=str) == brute_force(corpus, questions)
    assert hits.columns == ["query_id", "rank", "score", "chunk_id", "doc_type", "chunk_text"]


def test_every_usable_chunk_is_stored_once(index, emb, corpus):
    stored = index.rows.groupBy().agg(F.count("*"), F.countDistinct("chunk_id"), F.countDistinct("lot")).first()
    assert tuple(stored) == (len(corpus),) * 3
    assert index.sizes.sum() == len(corpus)


def test_nine_in_ten_hits_from_a_fifth_of_the_rows(index, corpus, spark):
    asked = spark.createDataFrame([(i, corpus[i].tolist()) for i in range(30, 1800, 20)], "query_id int, qvec array<double>")
    read = index.choose(asked, 10, 6).agg(F.avg("rows_read")).first()[0]
    assert read <= len(corpus) / 5
    near = {(r.query_id, r.chunk_id) for r in index.search(asked, 10, 6).collect()}
    true = {(r.query_id, r.chunk_id) for r in index.search(asked, 10, 6, exact=True).collect()}
    assert len(true) == 10 * asked.count() and len(near & true) >= 0.9 * len(true)


def test_exact_search_passes_over_cells(index, corpus, spark):
    asked = spark.createDataFrame([(i, corpus[i].tolist()) for i in range(30, 1800, 20)], "query_id int, qvec array<double>")
    first = index.choose(asked, 10, 6)
    second = index._within_reach(first, index.search(asked, 10, 6).withColumn("top_k", F.lit(10)))
    met = first.agg(F.sum(F.size("cells"))).first()[0] + second.agg(F.sum(F.size("cells"))).first()[0]
    assert met < 0.7 * asked.count() * (index.sizes > 0).sum()


def test_only_folders_of_probed_cells_are_read(index, corpus, spark, capsys):
    asked = spark.createDataFrame([(1, corpus[40].tolist())], "query_id int, qvec array<double>")
    index._meet(index.choose(asked, 3, 2)).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [cell" in plan and "ReadSchema: struct<chunk_id:string,doc_type:string,embedding:array<float>,lot:bigint>" in plan


def test_reopened_index_answers_alike(index, questions, spark, rows):
    path = index.rows.inputFiles()[0].split("/rows/")[0]
    again = cells.open_cells(spark, path)
    assert rows(again.search(questions, 4)) == rows(index.search(questions, 4))


def test_repeated_ids_are_hits_of_their_own(spark, tmp_path):
    emb = spark.createDataFrame([("a", "t", f"{i}", 0, [1.0, float(i % 2)]) for i in range(6)], SCHEMA)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, qvec array<double>")
    hits = cells.train_cells(emb, 2, str(tmp_path / "i"), 2, 2).search(asked, 5, 1, exact=True).collect()
    assert sorted(h["rank"] for h in hits) == [1, 2, 3, 4, 5] and sorted(h["score"] for h in hits)[2:] == [1.0] * 3


def test_empty_table_and_no_questions(spark, emb, questions, index, tmp_path):
    empty = cells.train_cells(emb.where("false"), DIM, str(tmp_path / "none"))
    assert empty.search(questions, 3, exact=True).count() == 0
    assert index.search(questions.where("false"), 3, exact=True).count() == 0


def test_too_many_cells_are_refused(emb, tmp_path):
    with pytest.raises(ValueError):
        cells.train_cells(emb, DIM, str(tmp_path / "x"), 100, 100)


def test_nearest_chunks_takes_the_index(index, questions, rows):
    assert rows(vectors.nearest_chunks(index, questions, 4)) == rows(index.search(questions, 4))
