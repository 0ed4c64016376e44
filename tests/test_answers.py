"""The seven product questions on a small hand-made corpus; chunk order is set by the vectors."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import vectors as v
from tallyloom.plans import answers

SPEC, DISCOUNT = "product_spec", "discount_policy"
CORPUS = [
    (SPEC, "Document Version: 2\n• L aptop 14: 2-Year War ranty\nD rillM aster hotline 1-800-DRIL\n"
           "2-year WARRANTY, Laptop 14\nsupport"),
    (SPEC, "Laptop 14\x00 Display: 14 Inch\nKitchen support line\nKitchen Knife: Stainless\n"
           "FCC and RoHS Certified\nhand tool support"),
    (DISCOUNT, "Effective Date: 1 May\nElectronics APAC: 10% Discount\n"
               "Minimum Order: 50 Units\nminimum order, 50 units!\nApproved by the board"),
    (SPEC, "Power Drill Motor 18V\nDrill: ANSI Listed\nRobust Carry Case Included\nBattery 5G"),
    (SPEC, "Water Resistant to IP67\nReturn Within 30 Days\nBrand: Acme"),
    (DISCOUNT, "Bulk Tier 2 Region EMEA\nplain words only"),
    (SPEC, None),
    (SPEC, "Far away chunk with Warranty"),
    (SPEC, "Ninth chunk Warranty"),
]


@pytest.fixture(scope="module")
def emb(spark):
    data = []
    for i, (kind, text) in enumerate(CORPUS):
        angle = i * math.pi / 40
        data.append((f"c{i}", f"file{i}", kind, text, "u", [math.cos(angle), math.sin(angle)]))
    return spark.createDataFrame(
        data,
        "chunk_id string, file_name string, doc_type string, chunk_text string,"
        "source_url string, embedding array<float>",
    ).cache()


def embedder(asked):
    return asked.withColumn("qvec", F.array(F.lit(1.0), F.lit(0.0)))


def ask(spark, emb, function, schema, *arguments):
    asked = spark.createDataFrame([(i, *row) for i, row in enumerate(arguments)], "query_id int, " + schema)
    return [r.result for r in function(emb, asked, embedder).orderBy("query_id").collect()]


def test_warranty(spark, emb):
    laptop, drill, unknown = ask(
        spark, emb, answers.get_warranty, "product_keyword string",
        ("'Laptop 14'",), ("Power Drill",), ("Toaster",),
    )
    # The chunk without text counts among the six retrieved; the eighth and ninth do not.
    assert laptop == (
        "Warranty & Support for 'Laptop 14':\n\n"
        "• Laptop 14: 2-Year Warranty\n"
        "• 2-year WARRANTY, Laptop 14\n"
        "• handtoolsupport\n"
        "• Return Within 30 Days\n"
        "• Farawaychunkwith Warranty"
    )
    assert "DrillMasterhotline 1-800-DRIL" in drill and "Laptop" not in drill
    assert "• Kitchensupportline" not in drill and "• Kitchensupportline" in unknown


def test_tech_specs_and_certifications(spark, emb):
    (specs,) = ask(spark, emb, answers.get_tech_specs, "product_keyword string", ("Laptop 14",))
    assert specs == (
        "Technical Specifications for Laptop 14:\n\n"
        "• Laptop 14 Display: 14 Inch\n"
        "• Power Drill Motor 18V\n"
        "• Battery 5G\n"
        "• Water Resistant to IP67"
    ).replace("Resistant to", "Resistantto")
    certs, nothing = ask(
        spark, emb, answers.get_certifications, "product_keyword string",
        ("Power Drill",), ("Laptop 14",),
    )
    assert certs == (
        "Certifications & Compliance for Power Drill:\n\n"
        "• FCCand RoHS Certified\n"
        "• Drill: ANSI Listed"
    )
    assert "ANSI" in nothing


def test_not_found(spark, emb):
    only_discounts = emb.where(F.col("doc_type") == DISCOUNT)
    asked = ("product_keyword string", ("Mug",))
    assert ask(spark, only_discounts, answers.get_warranty, *asked) == [
        "No warranty information found for 'Mug'."
    ]
    assert ask(spark, only_discounts, answers.get_tech_specs, *asked) == [
        "No technical specifications found for 'Mug'."
    ]
    assert ask(spark, only_discounts, answers.get_certifications, *asked) == [
        "No certification information found for 'Mug'."
    ]
    assert ask(spark, only_discounts, answers.get_product_profile, *asked) == [
        "No information found for Mug"
    ]
    nothing = emb.where("false")
    assert ask(spark, nothing, answers.search_docs, "query_text string", ("x",)) == [
        "No matching product documentation found."
    ]
    assert ask(
        spark, nothing, answers.search_by_doc_type, "query_text string, doc_type string",
        ("x", "faq"), ("x", None),
    ) == ["No faq documentation found for: 'x'.", "No None documentation found for: 'x'."]
    assert ask(
        spark, nothing, answers.get_discount, "category_name string, region_name string",
        ("Home", "East"),
    ) == ["No discount policy found for Home in East region."]


def test_profile(spark, emb):
    (profile,) = ask(spark, emb, answers.get_product_profile, "product_keyword string", ("Kitchen Set",))
    assert profile == (
        "Full Product Profile: Kitchen Set\n"
        "\nTECHNICAL SPECS:\n* Kitchen Knife: Stainless\n* Power Drill Motor 18V\n* Battery 5G"
        "\n* Water Resistantto IP67\n"
        "\nWARRANTY & SUPPORT:\n* Kitchensupportline\n* handtoolsupport\n* Return Within 30 Days"
        "\n* Farawaychunkwith Warranty\n"
        "\nCERTIFICATIONS:\n* FCCand RoHS Certified\n* Drill: ANSI Listed\n"
        "\nFEATURES:\n* Robust Carry Case Included"
    )


def test_profile_prints_a_heading_without_lines(spark):
    odd = spark.createDataFrame(
        [("c", "f", SPEC, "¿¿ USB ¿¿", "u", [1.0, 0.0])],
        "chunk_id string, file_name string, doc_type string, chunk_text string,"
        "source_url string, embedding array<float>",
    )
    (profile,) = ask(spark, odd, answers.get_product_profile, "product_keyword string", ("Mug",))
    assert profile == "Full Product Profile: Mug\n\nTECHNICAL SPECS:\n"


def test_search(spark, emb):
    (found,) = ask(
        spark, emb, answers.search_docs, "query_text string", ("which products are water resistant",)
    )
    assert found.startswith(
        "Search results for 'which products are water resistant':\n\n"
        "Laptop 14: 2-Year Warranty\nDrillMasterhotline 1-800-DRIL\n2-year WARRANTY, Laptop 14"
        "\n\n---\n\nLaptop 14 Display: 14 Inch"
    )
    assert found.count("---") == 4 and "Brand" not in found
    by_type = ask(
        spark, emb, answers.search_by_doc_type, "query_text string, doc_type string",
        ("bulk order minimum quantity", DISCOUNT), ("q", "ALL"), ("q", ""),
    )
    assert by_type[0] == (
        "Discount Policy results for 'bulk order minimum quantity':\n\n"
        "Electronics APAC: 10% Discount\nMinimum Order: 50 Units\nApprovedbytheboard\n\n---\n\n"
        "Bulk Tier 2 Region EMEA\nplainwordsonly"
    )
    assert by_type[1].startswith("Documentation results for 'q':\n\nLaptop 14")
    assert by_type[2] == by_type[1]


def test_lines_past_eight_count_as_seen(spark):
    many = "\n".join(f"Unique line number {i}" for i in range(10))
    chunks = spark.createDataFrame(
        [("a", "f", SPEC, many, "u", [1.0, 0.0]),
         ("b", "f", SPEC, "Unique line number 9\nUnique line number 10", "u", [1.0, 0.1])],
        "chunk_id string, file_name string, doc_type string, chunk_text string,"
        "source_url string, embedding array<float>",
    )
    (found,) = ask(spark, chunks, answers.search_docs, "query_text string", ("q",))
    first, second = found.split(":\n\n", 1)[1].split("\n\n---\n\n")
    assert first.split("\n") == [f"Uniquelinenumber {i}" for i in range(8)]
    assert second == "Uniquelinenumber 10"


def test_discount(spark, emb):
    (found,) = ask(
        spark, emb, answers.get_discount, "category_name string, region_name string",
        ("Electronics", "APAC"),
    )
    assert found == (
        "Discount Policy for Electronics - APAC region:\n\n"
        "* Electronics APAC: 10% Discount\n* Minimum Order: 50 Units\n* Bulk Tier 2 Region EMEA"
    )


def test_digests_and_tables(spark, emb):
    (three,) = ask(spark, emb, answers.source_digest, "query_text string", ("q",))
    assert three == "\n\n---\n\n".join(
        f"Source: file{i} ({kind})\n{text}" for i, (kind, text) in enumerate(CORPUS[:3])
    )
    (eight,) = ask(spark, emb, answers.product_documents, "product_keyword string", ("Mug",))
    assert eight == "Product documentation for 'Mug':\n\n" + "\n\n---\n\n".join(
        text for _, text in CORPUS[:8] if text
    )
    (typed,) = ask(
        spark, emb, answers.relevant_documents_by_type, "query_text string, doc_type string",
        ("q", DISCOUNT),
    )
    assert typed.startswith("Relevant discount policy documentation:\n\nEffective Date")
    (five,) = ask(spark, emb, answers.relevant_documents, "query_text string", ("q",))
    assert five.count("---") == 4
    (none,) = ask(
        spark, emb.where("false"), answers.discount_documents,
        "category_name string, region_name string", ("Home", "East"),
    )
    assert none == "Discount policy for Home in East region:\n\n"
    asked = spark.createDataFrame([(1, "Home", "East")], "query_id int, category_name string, region_name string")
    table = answers.discount_table(emb, asked, embedder)
    assert sorted(r.chunk_id for r in table.collect()) == ["c2", "c5"]
    assert table.columns == ["query_id", *v.HIT_COLUMNS]


def test_text_questions_find_their_chunk(spark):
    """From texts to answers with the library's own vectors."""
    texts = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota"]
    chunks = spark.createDataFrame(
        [(str(i), "f", SPEC, x, "u") for i, x in enumerate(texts)],
        "chunk_id string, file_name string, doc_type string, chunk_text string, source_url string",
    )
    model = v.fit_embedder(chunks, "chunk_text", 128)
    corpus = v.embed(chunks, "chunk_text", model)
    asked = spark.createDataFrame([(1, "zeta, delta?"), (2, "theta")], "query_id int, query_text string")
    hits = answers.retrieve(corpus, asked, answers.embed_with(model), F.col("query_text"), 1)
    assert {(h.query_id, h.chunk_id) for h in hits.collect()} == {(1, "1"), (2, "2")}


def test_index_and_exact_search_read_stored_vectors(spark, monkeypatch):
    from checks import document_checks as dc
    from checks.registry import QUERIES

    texts = [(i, f"file{i}", f"doc://{i}", "product_spec", f"about {i} and word{i % 7}") for i in range(60)]
    chunks = spark.createDataFrame(texts, "chunk_id long, file_name string, source_url string, doc_type string, chunk_text string")
    model = dc.v.fit_embedder(chunks, "chunk_text", dc._DIM)
    emb = dc.v.embed(chunks, "chunk_text", model)
    asked = spark.createDataFrame([(1, [1.0], "about 1", "All")], "query_id int, qvec array<double>, query_text string, doc_type string")
    seen, index = [], dc.v.cell_index
    monkeypatch.setattr(dc, "corpus", lambda *_: (emb, dc.answers.embed_with(model)))
    monkeypatch.setattr(dc, "questions", lambda *_: asked)
    monkeypatch.setattr(dc.v, "cell_index", lambda held, dim: seen.append(held) or index(held, dim))
    assert QUERIES["x5_search_docs_by_index"](spark, "").head()[0]
    assert "ArrowEvalPython" in emb._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in seen[0]._jdf.queryExecution().executedPlan().toString()
