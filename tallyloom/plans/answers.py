"""Answers to batches of questions: retrieve, clean, select lines, drop repeats, write text.

``emb`` holds chunks with vectors, as a frame or as a cell index. ``questions`` holds ``query_id`` and the question's arguments.
``embedder`` adds ``qvec`` to a frame from its column ``question``; ``embed_with`` makes one from
a fitted model. Every function returns one row per question: its columns and ``result``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import wordlists as words
from tallyloom.functions.text import match_key
from tallyloom.operators.ranking import first_n_per
from tallyloom.operators.text import (
    chunk_lines,
    classify,
    contains_any,
    dedupe_lines,
    drop_foreign_lines,
    extract_lines,
    join_lines,
)
from tallyloom.operators.vectors import (
    TermModel,
    embed,
    expand_query,
    hits_to_json,
    json_to_hits,
    nearest_chunks,
)

Embedder = Callable[[DataFrame], DataFrame]

HIT_BREAK = "\n\n---\n\n"
_PLACE = ["rank", "line_no"]


def embed_with(model: TermModel) -> Embedder:
    """Vectors for question texts from the model the chunks were embedded with."""
    return lambda questions: embed(questions, "question", model, "qvec")


def retrieve(
    emb: DataFrame,
    questions: DataFrame,
    embedder: Embedder,
    question: Column,
    k: int,
    doc_type: Column | str | None = None,
) -> DataFrame:
    """The ``k`` best chunks per question: query_id, rank, score and the chunk's columns."""
    wanted = doc_type if isinstance(doc_type, Column) else F.lit(doc_type).cast("string")
    asked = embedder(questions.withColumn("question", question).withColumn("doc_filter", wanted))
    return nearest_chunks(emb, asked.select("query_id", "qvec", "doc_filter"), k)


def _quoted(name: str) -> Column:
    return F.concat(F.lit("'"), F.col(name), F.lit("'"))


def _finish(
    questions: DataFrame, body: DataFrame, title: Column, not_found: Column
) -> DataFrame:
    """Title and body per question, or the not-found sentence where there is no body.

    ``body`` has one row per question, so the join key is unique on both sides.
    """
    text = F.when(F.col("_body").isNotNull(), F.concat(title, F.col("_body"))).otherwise(not_found)
    return (
        questions.join(body, "query_id", "left").withColumn("result", text).drop("_body", "question")
    )


def _first_lines(lines: DataFrame, n: int | None) -> DataFrame:
    return lines if n is None else first_n_per(lines, ["query_id"], _PLACE, n)


@dataclass(frozen=True)
class ProductAnswer:
    """What one kind of product question retrieves, keeps and prints."""

    prefix: str
    keywords: Sequence[str]
    title: str
    nothing: str
    skip: Sequence[str] = field(default_factory=lambda: words.METADATA_WORDS)
    markers: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: words.OTHER_PRODUCT_MARKERS
    )
    limit: int | None = None


WARRANTY = ProductAnswer(
    "warranty",
    words.WARRANTY_WORDS,
    "Warranty & Support for ",
    "No warranty information found for ",
    markers=words.WARRANTY_OTHER_PRODUCT_MARKERS,
)
TECH_SPECS = ProductAnswer(
    "specs",
    words.SPEC_WORDS,
    "Technical Specifications for ",
    "No technical specifications found for ",
    skip=words.SPEC_METADATA_WORDS,
    limit=20,
)
CERTIFICATIONS = ProductAnswer(
    "certifications",
    words.CERTIFICATION_WORDS,
    "Certifications & Compliance for ",
    "No certification information found for ",
)


def product_answer(
    emb: DataFrame, questions: DataFrame, embedder: Embedder, kind: ProductAnswer, k: int = 6
) -> DataFrame:
    """Bulleted lines about ``product_keyword`` from product specifications."""
    question = expand_query(kind.prefix, F.col("product_keyword"))
    hits = retrieve(emb, questions, embedder, question, k, "product_spec")
    about = hits.select("query_id", "rank", "chunk_text").join(
        questions.select("query_id", "product_keyword"), "query_id"
    )
    lines = extract_lines(about, kind.skip, kind.keywords, kind.markers, "product_keyword")
    kept = _first_lines(
        dedupe_lines(lines.select("query_id", *_PLACE, "line"), ["query_id"], _PLACE), kind.limit
    )
    body = kept.groupBy("query_id").agg(join_lines("• ", "line", "\n", *_PLACE).alias("_body"))
    title = F.concat(F.lit(kind.title), F.col("product_keyword"), F.lit(":\n\n"))
    nothing = F.concat(F.lit(kind.nothing), _quoted("product_keyword"), F.lit("."))
    return _finish(questions, body, title, nothing)


def get_warranty(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    return product_answer(emb, questions, embedder, WARRANTY)


def get_tech_specs(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    return product_answer(emb, questions, embedder, TECH_SPECS)


def get_certifications(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    return product_answer(emb, questions, embedder, CERTIFICATIONS)


# Sections in the order they are tried.
PROFILE_SECTIONS = {
    "warranty": words.PROFILE_WARRANTY_WORDS,
    "certifications": words.PROFILE_CERTIFICATION_WORDS,
    "specs": words.PROFILE_SPEC_WORDS,
}
# Sections in the order they are printed, with heading and number of lines.
PROFILE_LAYOUT = [
    ("specs", "TECHNICAL SPECS", 15),
    ("warranty", "WARRANTY & SUPPORT", 15),
    ("certifications", "CERTIFICATIONS", 15),
    ("features", "FEATURES", 5),
]


def classify_lines(
    chunks: DataFrame, by: Sequence[str], product: str = "product_keyword"
) -> DataFrame:
    """Profile lines with their section; lines of no section are left out."""
    lines = chunk_lines(chunks).where(~contains_any("lowered", words.SPEC_METADATA_WORDS))
    sectioned = drop_foreign_lines(lines, words.OTHER_PRODUCT_MARKERS, product).withColumn(
        "section", classify("lowered", "line", PROFILE_SECTIONS)
    )
    return sectioned.where(F.col("section").isNotNull()).select(*by, *_PLACE, "section", "line")


def get_product_profile(
    emb: DataFrame, questions: DataFrame, embedder: Embedder, k: int = 6
) -> DataFrame:
    """Lines about a product under up to four headings.

    A heading is printed when a line was assigned to it, even if none is left to list.
    """
    question = expand_query("profile", F.col("product_keyword"))
    hits = retrieve(emb, questions, embedder, question, k, "product_spec")
    about = hits.select("query_id", "rank", "chunk_text").join(
        questions.select("query_id", "product_keyword"), "query_id"
    )
    by = ["query_id", "section"]
    unique = dedupe_lines(classify_lines(about, ["query_id"]), by, _PLACE, min_key_len=0)
    listable = F.length(match_key("line")) > 5
    so_far = Window.partitionBy(*by).orderBy(*_PLACE)
    placed = unique.withColumn("_listable", listable).withColumn(
        "_position", F.sum(F.col("_listable").cast("int")).over(so_far)
    )
    parts = []
    for name, heading, limit in PROFILE_LAYOUT:
        here = F.col("section") == name
        shown = here & F.col("_listable") & (F.col("_position") <= limit)
        listed = join_lines("* ", F.when(shown, F.col("line")), "\n", *_PLACE)
        parts.append(F.when(F.max(here), F.concat(F.lit(f"\n\n{heading}:\n"), listed)))
    body = placed.groupBy("query_id").agg(F.concat_ws("", *parts).alias("_body"))
    title = F.concat(F.lit("Full Product Profile: "), F.col("product_keyword"))
    nothing = F.concat(F.lit("No information found for "), F.col("product_keyword"))
    return _finish(questions, body, title, nothing)


def _search_body(hits: DataFrame, lines_per_chunk: int = 8) -> DataFrame:
    """Cleaned lines of each hit, each line once per question, at most eight per hit.

    Lines past a hit's eight still count as seen.
    """
    lines = extract_lines(hits.select("query_id", "rank", "chunk_text"), words.METADATA_WORDS)
    unseen = dedupe_lines(
        lines.select("query_id", *_PLACE, "line"), ["query_id"], _PLACE, min_key_len=0
    )
    kept = first_n_per(unseen, ["query_id", "rank"], ["line_no"], lines_per_chunk)
    per_hit = kept.groupBy("query_id", "rank").agg(
        join_lines("", "line", "\n", "line_no").alias("_text")
    )
    return per_hit.groupBy("query_id").agg(
        join_lines("", "_text", HIT_BREAK, "rank").alias("_body")
    )


def search_docs(emb: DataFrame, questions: DataFrame, embedder: Embedder, k: int = 5) -> DataFrame:
    """Lines of the chunks nearest to ``query_text``, of any document type."""
    hits = retrieve(emb, questions, embedder, F.col("query_text"), k)
    title = F.concat(F.lit("Search results for "), _quoted("query_text"), F.lit(":\n\n"))
    nothing = F.lit("No matching product documentation found.")
    return _finish(questions, _search_body(hits), title, nothing)


def search_by_doc_type(
    emb: DataFrame, questions: DataFrame, embedder: Embedder, k: int = 5
) -> DataFrame:
    """The same among documents of the question's ``doc_type``."""
    hits = retrieve(emb, questions, embedder, F.col("query_text"), k, F.col("doc_type"))
    label = (
        F.when(F.col("doc_type") == "product_spec", "Product Specification")
        .when(F.col("doc_type") == "discount_policy", "Discount Policy")
        .otherwise("Documentation")
    )
    title = F.concat(label, F.lit(" results for "), _quoted("query_text"), F.lit(":\n\n"))
    nothing = F.concat(
        F.lit("No "),
        F.coalesce(F.col("doc_type"), F.lit("None")),
        F.lit(" documentation found for: "),
        _quoted("query_text"),
        F.lit("."),
    )
    return _finish(questions, _search_body(hits), title, nothing)


def _discount_question(prefix: str) -> Column:
    return expand_query(prefix, F.col("category_name"), F.lit(" region "), F.col("region_name"))


def get_discount(emb: DataFrame, questions: DataFrame, embedder: Embedder, k: int = 5) -> DataFrame:
    """Discount lines for ``category_name`` and ``region_name``, at most twenty."""
    hits = retrieve(emb, questions, embedder, _discount_question("discount"), k, "discount_policy")
    lines = extract_lines(
        hits.select("query_id", "rank", "chunk_text"),
        words.DISCOUNT_METADATA_WORDS,
        words.DISCOUNT_WORDS,
    )
    unseen = dedupe_lines(
        lines.select("query_id", *_PLACE, "line"), ["query_id"], _PLACE, min_key_len=0
    )
    body = (
        _first_lines(unseen, 20)
        .groupBy("query_id")
        .agg(join_lines("* ", "line", "\n", *_PLACE).alias("_body"))
    )
    where = [F.col("category_name"), F.lit(" - "), F.col("region_name"), F.lit(" region:\n\n")]
    title = F.concat(F.lit("Discount Policy for "), *where)
    nothing = F.concat(
        F.lit("No discount policy found for "),
        F.col("category_name"),
        F.lit(" in "),
        F.col("region_name"),
        F.lit(" region."),
    )
    return _finish(questions, body, title, nothing)


def chunk_table(
    emb: DataFrame,
    questions: DataFrame,
    embedder: Embedder,
    question: Column,
    k: int = 5,
    doc_type: Column | str | None = None,
) -> DataFrame:
    """Retrieved chunks as rows, by way of the JSON hit list that callers exchange."""
    return json_to_hits(hits_to_json(retrieve(emb, questions, embedder, question, k, doc_type)))


def product_table(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Eight chunks of any type about a product."""
    return chunk_table(
        emb, questions, embedder, expand_query("product_table", F.col("product_keyword")), 8
    )


def discount_table(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Five discount chunks for a category and region."""
    question = _discount_question("discount_table")
    return chunk_table(emb, questions, embedder, question, 5, "discount_policy")


def search_table(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Five chunks of any type nearest to ``query_text``."""
    return chunk_table(emb, questions, embedder, F.col("query_text"))


def search_by_doc_type_table(
    emb: DataFrame, questions: DataFrame, embedder: Embedder
) -> DataFrame:
    return chunk_table(emb, questions, embedder, F.col("query_text"), 5, F.col("doc_type"))


def hits_digest(hits: DataFrame, with_source: bool = False) -> DataFrame:
    """Whole hit texts of each question in rank order; empty ones are left out.

    With ``with_source`` every text stays and is headed by its file and type.
    """
    if with_source:
        head = F.concat(
            F.lit("Source: "), F.col("file_name"), F.lit(" ("), F.col("doc_type"), F.lit(")\n")
        )
        texts = hits.withColumn("_text", F.concat(head, F.coalesce("chunk_text", F.lit(""))))
    else:
        texts = hits.where(F.length("chunk_text") > 0).withColumn("_text", F.col("chunk_text"))
    return texts.groupBy("query_id").agg(join_lines("", "_text", HIT_BREAK, "rank").alias("digest"))


def _digest_answer(questions: DataFrame, hits: DataFrame, title: Column) -> DataFrame:
    digests = hits_digest(hits).withColumnRenamed("digest", "_body")
    return _finish(questions, digests, title, title)


def source_digest(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Three whole chunks with their sources."""
    hits = retrieve(emb, questions, embedder, F.col("query_text"), 3)
    return _finish(
        questions,
        hits_digest(hits, with_source=True).withColumnRenamed("digest", "_body"),
        F.lit(""),
        F.lit(""),
    )


def product_documents(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Eight whole chunks of any type about a product."""
    question = expand_query("product_documents", F.col("product_keyword"))
    title = F.concat(
        F.lit("Product documentation for "), _quoted("product_keyword"), F.lit(":\n\n")
    )
    return _digest_answer(questions, retrieve(emb, questions, embedder, question, 8), title)


def relevant_documents(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Five whole chunks of any type."""
    hits = retrieve(emb, questions, embedder, F.col("query_text"), 5)
    return _digest_answer(questions, hits, F.lit("Relevant product documentation:\n\n"))


def relevant_documents_by_type(
    emb: DataFrame, questions: DataFrame, embedder: Embedder
) -> DataFrame:
    """Five whole chunks of one type; any type but product_spec is called a discount policy."""
    hits = retrieve(emb, questions, embedder, F.col("query_text"), 5, F.col("doc_type"))
    label = F.when(F.col("doc_type") == "product_spec", "product specification").otherwise(
        "discount policy"
    )
    return _digest_answer(
        questions, hits, F.concat(F.lit("Relevant "), label, F.lit(" documentation:\n\n"))
    )


def discount_documents(emb: DataFrame, questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Five whole discount chunks for a category and region."""
    hits = retrieve(emb, questions, embedder, _discount_question("discount"), 5, "discount_policy")
    title = F.concat(
        F.lit("Discount policy for "),
        F.col("category_name"),
        F.lit(" in "),
        F.col("region_name"),
        F.lit(" region:\n\n"),
    )
    return _digest_answer(questions, hits, title)
