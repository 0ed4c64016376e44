"""The answer functions called from SQL give what their DataFrame forms give, on the hand-made corpus and its awkward questions."""

import pytest
from tests.test_answers import CORPUS, DISCOUNT, SPEC

from tallyloom.operators import vectors as v
from tallyloom.plans import answers
from tallyloom.plans.sql_answers import postings, register_answers, store_answer_index

CHUNK = "chunk_id string, file_name string, doc_type string, chunk_text string, source_url string"
CALLS = [
    ("get_warranty", answers.get_warranty, ("product_keyword",), ["Laptop 14", "'Laptop 14'", "Power Drill", "Toaster", "", None]),
    ("get_tech_specs", answers.get_tech_specs, ("product_keyword",), ["5G Smartphone", "Power Drill", "x' OR \"y\" \\"]),
    ("get_certifications", answers.get_certifications, ("product_keyword",), ["Power Drill", "Kitchen Set", "Laptop 14"]),
    ("get_product_policy", answers.get_product_profile, ("product_keyword",), ["Kitchen Set", "Laptop 14", "Hand Tool Set"]),
    ("search_product_docs", answers.search_docs, ("query_text",), ["which products are water resistant", "zzz", "", " \t", None, "warranty"]),
    (
        "search_by_doc_type", answers.search_by_doc_type, ("query_text", "doc_type"),
        [("bulk order minimum quantity", "discount_policy"), ("warranty", "ALL"), ("warranty", None), ("warranty", ""), ("drill", "nothing"), (None, None)],
    ),
    (
        "get_discount_by_category", answers.get_discount, ("category_name", "region_name"),
        [("Electronics", "APAC"), ("Tools", "EMEA"), (None, "EMEA")],
    ),
]


def stored(spark, tmp_path_factory, rows, dim):
    chunks = spark.createDataFrame(rows, CHUNK)
    model = v.fit_embedder(chunks, "chunk_text", dim)
    emb = v.embed(chunks, "chunk_text", model).cache()
    folder = str(tmp_path_factory.mktemp("answers"))
    store_answer_index(emb, model, folder)
    return emb, model, folder


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    # equal texts tie; more chunks without a word of the question than an answer retrieves
    more = [(SPEC, "same words of a longer line\nFCC Certified for all"), (DISCOUNT, "x"), (None, "a chunk of no type"), (SPEC, " ")] * 4
    rows = [(f"c{i:02}", f"file{i}", kind, text, "u") for i, (kind, text) in enumerate([*CORPUS, *more])]
    return stored(spark, tmp_path_factory, rows, 1024)


def in_sql(value):
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@pytest.mark.parametrize("name, function, columns, asked", CALLS, ids=[c[0] for c in CALLS])
def test_calls_give_the_frame_forms_answers(spark, index, name, function, columns, asked):
    emb, model, folder = index
    register_answers(spark, folder)
    arguments = [a if isinstance(a, tuple) else (a,) for a in asked]
    schema = "query_id int, " + ", ".join(f"{c} string" for c in columns)
    questions = spark.createDataFrame([(i, *a) for i, a in enumerate(arguments)], schema)
    expected = {r.query_id: r.result for r in function(emb, questions, answers.embed_with(model)).collect()}
    called = spark.sql(f"SELECT query_id, rag_{name}_raw({', '.join(columns)}) AS result FROM {{asked}}", asked=questions)
    assert {r.query_id: r.result for r in called.collect()} == expected
    literal = spark.sql(f"SELECT rag_{name}_raw({', '.join(map(in_sql, arguments[0]))})").head()[0]
    assert literal == expected[0]
    assert any(r is not None and "\n" in r for r in expected.values())


def test_a_question_reads_the_folders_of_its_words(spark, index):
    register_answers(spark, index[2])
    plan = spark.sql("SELECT rag_get_warranty_raw('Laptop 14')")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "CartesianProduct" not in plan


def test_without_chunks(spark, tmp_path_factory):
    _, _, folder = stored(spark, tmp_path_factory, [], 16)
    register_answers(spark, folder, "empty_{}", "empty_index")
    row = spark.sql("SELECT empty_get_warranty('Laptop 14') AS w, empty_search_product_docs('drill') AS s").head()
    assert row.w == "No warranty information found for 'Laptop 14'."
    assert row.s == "No matching product documentation found."


def test_postings_hold_unit_vectors_without_zeros(spark):
    schema = "chunk_id string, doc_type string, embedding array<float>"
    emb = spark.createDataFrame([("a", SPEC, [3.0, 0.0, 4.0]), ("b", SPEC, [0.0, 0.0, 0.0]), ("c", SPEC, []), ("d", SPEC, None)], schema)
    assert sorted((r.chunk_id, r.bucket, round(r.weight, 9)) for r in postings(emb).collect()) == [("a", 0, 0.6), ("a", 2, 0.8)]
