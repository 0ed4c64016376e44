"""Chunking, cleaning, line extraction and keyword lookups over document text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import (
    chunk_key,
    clean_line,
    contains_any,
    like_anywhere,
    match_key,
    product_key,
)
from tallyloom.operators.ranking import top_n

BLANK_LINE = r"\n\s*\n"
HIT_COLUMNS = ["chunk_id", "file_name", "doc_type", "chunk_text", "source_url"]


def chunk_documents(
    docs: DataFrame,
    sep: str = BLANK_LINE,
    min_len: int = 80,
    identity: Sequence[str] = ("file_name", "source_url"),
) -> DataFrame:
    """Paragraphs of more than ``min_len`` characters, with ids that repeat across runs."""
    paragraphs = docs.select(
        *docs.columns, F.posexplode(F.split("raw_content", sep)).alias("_n", "_paragraph")
    )
    carried = [c for c in ("ingested_at",) if c in docs.columns]
    return (
        paragraphs.withColumn("chunk_text", F.trim("_paragraph"))
        .where(F.length("chunk_text") > min_len)
        .select(
            chunk_key(*identity, "_n").alias("chunk_id"),
            "file_name",
            "source_url",
            "doc_type",
            F.lit(None).cast("string").alias("section_title"),
            "chunk_text",
            *carried,
        )
    )


def repair_chunks(chunks: DataFrame, text: str = "chunk_text") -> DataFrame:
    """Stored chunks with split words rejoined, pairwise; only rows that show a split change."""
    split_word = "([A-Za-z]) ([a-z])"
    repaired = F.regexp_replace(F.regexp_replace(text, split_word, "$1$2"), r"\x00", "")
    return chunks.withColumn(text, F.when(F.col(text).rlike(split_word), repaired).otherwise(F.col(text)))


def chunk_lines(chunks: DataFrame, text: str = "chunk_text", min_len: int = 8) -> DataFrame:
    """Cleaned lines of each chunk with their place, short ones left out.

    The chunk's text gives way to ``line_no``, ``line`` and ``lowered``. Lines are cleaned before
    they become rows, so the many conditions on a line read its cleaned form and do not clean it
    again: a condition cannot move below the explode.
    """
    kept = [c for c in chunks.columns if c != text]
    cleaned = F.transform(F.split(text, "\n"), clean_line)
    forms = F.transform(cleaned, lambda x: F.struct(x.alias("line"), F.lower(x).alias("lowered")))
    lines = chunks.select(*kept, F.posexplode(forms).alias("line_no", "_forms"))
    return lines.select(*kept, "line_no", "_forms.*").where(F.length("line") >= min_len)


def drop_foreign_lines(
    lines: DataFrame, markers: Mapping[str, Sequence[str]], product: str, line: str = "lowered"
) -> DataFrame:
    """Leave out lines marked as being about another product than the one asked for.

    The marker lists become one predicate, so no join is needed. An unlisted product leaves
    nothing out.
    """
    asked = product_key(product)
    foreign = reduce(
        Column.__or__,
        ((asked == name) & contains_any(line, words) for name, words in markers.items()),
        F.lit(False),
    )
    return lines.where(~F.coalesce(foreign, F.lit(False)))


def extract_lines(
    chunks: DataFrame,
    skip: Sequence[str],
    keywords: Sequence[str] | None = None,
    markers: Mapping[str, Sequence[str]] | None = None,
    product: str | None = None,
    text: str = "chunk_text",
) -> DataFrame:
    """Lines that are no metadata, not about another product, and hold a keyword."""
    lines = chunk_lines(chunks, text).where(~contains_any("lowered", skip))
    if markers is not None and product is not None:
        lines = drop_foreign_lines(lines, markers, product)
    return lines if keywords is None else lines.where(contains_any("lowered", keywords))


def dedupe_lines(
    lines: DataFrame, by: Sequence[str], order: Sequence[str], min_key_len: int = 6
) -> DataFrame:
    """First line of each match key within ``by``; keys below ``min_key_len`` are left out.

    The first line is a minimum over (order, line), which is combined before the shuffle: a
    line repeated everywhere travels once per task.
    """
    others = [c for c in lines.columns if c not in (*by, *order)]
    keyed = lines.withColumn("_key", match_key("line")).where(F.length("_key") >= min_key_len)
    return (
        keyed.groupBy(*by, "_key")
        .agg(F.min(F.struct(*order, *others)).alias("_first"))
        .select(*by, "_first.*")
    )


def classify(lowered: str, line: str, sections: Mapping[str, Sequence[str]]) -> Column:
    """The first section with a matching word, else ``features`` for longer lines, else NULL."""
    chain = F
    for name, words in sections.items():
        chain = chain.when(contains_any(lowered, words), name)
    return chain.when(F.length(line) > 15, "features")


def join_lines(prefix: str, line: str | Column, sep: str, *order: str) -> Column:
    """Aggregate: lines in order, each behind ``prefix``, joined by ``sep``; NULL lines are left out.

    Meant for the lines of an answer, whose number is bounded by the retrieved chunks.
    """
    line = F.col(line) if isinstance(line, str) else line
    entry = F.when(line.isNotNull(), F.struct(*order, line.alias("_line")))
    sorted_lines = F.array_sort(F.collect_list(entry))
    return F.array_join(F.transform(sorted_lines, lambda s: F.concat(F.lit(prefix), s["_line"])), sep)


def search_product_docs(chunks: DataFrame, query: str | None, n: int = 5) -> DataFrame:
    """Chunks whose text or file name holds the query, first by chunk id."""
    found = like_anywhere("chunk_text", query) | like_anywhere("file_name", query)
    return top_n(chunks.where(found).select(*HIT_COLUMNS), ["chunk_id"], n)


def get_product_policy(chunks: DataFrame, keyword: str | None, n: int = 10) -> DataFrame:
    """Chunks naming a product, ordered by document type and id."""
    found = chunks.where(like_anywhere("chunk_text", keyword))
    columns = ["chunk_id", "file_name", "doc_type", "chunk_text"]
    return top_n(found.select(*columns), ["doc_type", "chunk_id"], n)


def get_discount_by_category(
    chunks: DataFrame, category: str | None, region: str | None, n: int = 5
) -> DataFrame:
    """Discount chunks naming both a category and a region."""
    found = chunks.where(
        (F.col("doc_type") == "discount_policy")
        & like_anywhere("chunk_text", category)
        & like_anywhere("chunk_text", region)
    )
    return top_n(found.select("chunk_id", "doc_type", "chunk_text"), ["chunk_id"], n)


def doc_type_filter(df: DataFrame, doc_type: str | None, column: str = "doc_type") -> DataFrame:
    """Rows of one document type; ``all`` in any case, empty or NULL keeps every row."""
    if not doc_type or doc_type.lower() == "all":
        return df
    return df.where(F.col(column) == doc_type)


def register_lookups(spark, chunks_view: str, gold_view: str) -> None:
    """The three keyword lookups as SQL table functions of the session."""
    hit = "chunk_id STRING, file_name STRING, doc_type STRING, chunk_text STRING"
    holds = "lower({0}) LIKE concat('%', lower({1}), '%')"
    in_text = holds.format("chunk_text", "query_text")
    in_name = holds.format("file_name", "query_text")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION search_product_docs(query_text STRING)"
        f" RETURNS TABLE ({hit}, source_url STRING) RETURN"
        f" SELECT chunk_id, file_name, doc_type, chunk_text, source_url FROM {chunks_view}"
        f" WHERE {in_text} OR {in_name} ORDER BY chunk_id LIMIT 5"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION get_product_policy(product_keyword STRING)"
        f" RETURNS TABLE ({hit}) RETURN"
        f" SELECT chunk_id, file_name, doc_type, chunk_text FROM {gold_view}"
        f" WHERE {holds.format('chunk_text', 'product_keyword')}"
        f" ORDER BY doc_type, chunk_id LIMIT 10"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION"
        f" get_discount_by_category(category_name STRING, region_name STRING)"
        f" RETURNS TABLE (chunk_id STRING, doc_type STRING, chunk_text STRING) RETURN"
        f" SELECT chunk_id, doc_type, chunk_text FROM {gold_view}"
        f" WHERE doc_type = 'discount_policy'"
        f" AND {holds.format('chunk_text', 'category_name')}"
        f" AND {holds.format('chunk_text', 'region_name')} ORDER BY chunk_id LIMIT 5"
    )
