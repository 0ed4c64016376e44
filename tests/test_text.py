import random
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as ft
from tallyloom.operators import text as t


def cleaned_in_python(line):
    line = re.sub(r"(?<=[A-Za-z])\s(?=[a-z])", "", line)
    return re.sub(r"\s{2,}", " ", line).replace("\x00", "").replace("•", "").strip()


def test_clean_line_matches_the_rule_on_random_text(spark):
    rnd = random.Random(5)
    spaces = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")
    alphabet = "abAB ,.5\x00•é\u200b" + "ab AB " * 6 + spaces
    lines = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 14))) for _ in range(6000)]
    lines += [f"a{c}b" for c in spaces] + [f"{c}a{c}{c}B{c}" for c in spaces]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    got = {r[0]: r[1] for r in df.select("x", ft.clean_line("x")).collect()}
    assert got == {x: cleaned_in_python(x) for x in lines}


def test_one_letter_words_tell_the_two_cleanings_apart(spark, rows):
    df = spark.createDataFrame([("a b c",), ("L aptop  14",), ("support for",)], "x string")
    cleaned = df.select("x", ft.clean_line("x"), ft.clean_line_consuming("x"))
    assert rows(cleaned) == [
        ("L aptop  14", "Laptop 14", "Laptop 14"),
        ("a b c", "abc", "ab c"),
        ("support for", "supportfor", "supportfor"),
    ]


def test_repair_touches_only_split_rows(spark, rows):
    df = spark.createDataFrame([("war ranty a b c",), ("A\x00B",), ("ok go\x00",)], "chunk_text string")
    assert rows(t.repair_chunks(df)) == [("A\x00B",), ("okgo",), ("warrantya bc",)]


@pytest.fixture(scope="module")
def docs(spark):
    long = "x" * 80
    text = f"  {long}y \n\n short \n \t \n{long}\nz\n\n{long}"
    return spark.createDataFrame(
        [("f.pdf", "url", "product_spec", text)],
        "file_name string, source_url string, doc_type string, raw_content string",
    )


def test_chunks_split_on_blank_lines_and_keep_long_ones(docs):
    chunks = t.chunk_documents(docs)
    found = chunks.collect()
    assert sorted(c.chunk_text for c in found) == ["x" * 80 + "\nz", "x" * 80 + "y"]
    assert all(c.section_title is None for c in found)
    again = {c.chunk_id for c in t.chunk_documents(docs.repartition(4)).collect()}
    assert {c.chunk_id for c in found} == again and len(again) == 2


CHUNKS = [
    ("1", "a.pdf", "discount_policy", "Bulk order Electronics APAC: 50%_off", "u"),
    ("2", "b.pdf", "product_spec", "Laptop 14 battery", "u"),
    ("3", "laptop.pdf", "product_spec", "nothing", "u"),
    ("4", "c.pdf", "discount_policy", "Electronics EMEA 50 pct off", "u"),
    ("5", "d.pdf", "discount_policy", None, "u"),
]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(
        CHUNKS, "chunk_id string, file_name string, doc_type string, chunk_text string, source_url string"
    ).cache()


def test_lookups(chunks, rows):
    assert rows(t.search_product_docs(chunks, "LAPTOP"), "chunk_id") == [("2",), ("3",)]
    assert rows(t.search_product_docs(chunks, "50%off"), "chunk_id") == [("1",), ("4",)]
    assert rows(t.search_product_docs(chunks, None)) == []
    assert rows(t.get_product_policy(chunks, "e", 2), "chunk_id") == [("1",), ("4",)]
    assert rows(t.get_discount_by_category(chunks, "electronics", "apac"), "chunk_id") == [("1",)]
    for everything in (None, "", "all", "ALL"):
        assert t.doc_type_filter(chunks, everything).count() == 5
    assert t.doc_type_filter(chunks, "product_spec").count() == 2


def test_lookups_as_sql_functions(spark, chunks, rows):
    chunks.createOrReplaceTempView("lookup_chunks")
    t.register_lookups(spark, "lookup_chunks", "lookup_chunks")
    assert rows(spark.sql("SELECT chunk_id FROM search_product_docs('laptop')")) == [("2",), ("3",)]
    assert rows(spark.sql("SELECT chunk_id FROM get_product_policy('battery')")) == [("2",)]
    found = spark.sql("SELECT chunk_id FROM get_discount_by_category('Electronics', 'EMEA')")
    assert rows(found) == [("4",)]


def test_extraction_and_foreign_lines(spark, rows):
    text = "Battery life 10 h\nBrand: Battery\nshort b\nSmartphone Battery\nno match at all"
    df = spark.createDataFrame(
        [(1, "'Laptop 14' ", text), (2, "Unknown", text)], "q int, product string, chunk_text string"
    )
    lines = t.extract_lines(
        df, ["brand:"], ["battery"], {"laptop 14": ["smartphone"], "x": ["life"]}, "product"
    )
    assert rows(lines, "q", "line_no", "line") == [
        (1, 0, "Batterylife 10 h"), (2, 0, "Batterylife 10 h"), (2, 3, "Smartphone Battery"),
    ]


def test_dedupe_keeps_the_first_even_if_one_line_is_everywhere(spark, rows):
    data = [("hot", i, 0, "Same, LINE!" if i % 2 else "same line") for i in range(500)]
    data += [("hot", 3, 1, "--5g--"), ("cold", 9, 0, "same line")]
    df = spark.createDataFrame(data, "s string, rank int, line_no int, line string")
    kept = t.dedupe_lines(df.repartition(8), ["s"], ["rank", "line_no"])
    assert rows(kept, "s", "rank", "line") == [("cold", 9, "same line"), ("hot", 0, "same line")]
    every = t.dedupe_lines(df, ["s"], ["rank", "line_no"], min_key_len=0)
    assert every.count() == 3


def test_assembled_documents(spark, rows):
    from tallyloom.sources.documents import assemble_documents

    pages = [("f", n, None if n == 3 else f"p{n}") for n in range(12)] + [("g", 0, None)]
    df = spark.createDataFrame(pages, "file_name string, page_no int, text string").repartition(5)
    docs = assemble_documents(df, pages_per_block=4)
    expected = "\n\n".join("" if n == 3 else f"p{n}" for n in range(12))
    assert rows(docs, "file_name", "raw_content") == [("f", expected), ("g", "")]
    assert "ingested_at" in docs.columns


def test_classify_order(spark, rows):
    from tallyloom.plans.answers import PROFILE_SECTIONS

    df = spark.createDataFrame(
        [(x, x.lower()) for x in (
            "Certified support", "ISO battery", "Battery", "A long enough line", "Too short",
        )],
        "line string, lowered string",
    )
    assert rows(df.select("line", t.classify("lowered", "line", PROFILE_SECTIONS))) == [
        ("A long enough line", "features"),
        ("Battery", "specs"),
        ("Certified support", "warranty"),
        ("ISO battery", "certifications"),
        ("Too short", None),
    ]
    assert df.select(F.max(ft.contains_any("lowered", []))).first()[0] is False


def test_lists_of_words_are_found_as_word_by_word(spark):
    from tallyloom.functions.text import contains_any, lists_found

    lists = {"marks": ["a.b", "c|d", "e & f", "½ µm"], "same": ["c|d"], "none": [], "5g phone": ["\\", "("]}
    texts = ["axb", "a.b", "cd c", "x c|d", "e & f (", "of ½ µm", "", "\\", None, "nothing"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    found = df.withColumn("found", lists_found("t", lists)).select("id", *(F.col("found")[name].alias(name) for name in lists))
    plain = df.select("id", *(contains_any("t", found).alias(name) for name, found in lists.items()))
    by_id = {r.id: r for r in plain.collect()}
    for row in found.collect():
        assert {k: v for k, v in row.asDict().items() if k != "none"} == {k: v for k, v in by_id[row.id].asDict().items() if k != "none"}
        assert not row["none"]


def test_ascii_texts_have_the_words_of_the_pattern():
    from tallyloom.operators.vectors import _WORD, _Buckets

    buckets = _Buckets(1 << 30)
    text = "".join(map(chr, range(128))) + " Ab_c-9 x\tY\n\x1cz"
    for asked in (text, text + " ß½é"):
        assert buckets.of_text(asked) == [buckets[w] for w in _WORD.findall(asked.lower())]


def test_a_condition_on_lines_does_not_scan_them_twice(spark):
    from tallyloom.plans.sql_answers import answer_lines

    chunks = spark.createDataFrame([("a", "warranty of two years\nFCC Certified")], "chunk_id string, chunk_text string")
    lines = answer_lines(chunks)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Contains" not in plan and "contains(" not in plan
    assert {r.line: sorted(r.uses) for r in lines.collect()}["FCC Certified"] == ["certifications", "profile", "search"]
