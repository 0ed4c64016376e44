"""The answer functions as SQL functions over a stored index: ``SELECT rag_get_warranty_raw('Laptop 14')``.

The index holds each chunk's weighted terms as rows, its cleaned lines with what each answer would do with them, and the
chunks of smallest id. A question's few terms meet their rows by an equi-join, so neither a literal question nor a column of them
needs a cross join with the vectors: Spark turns the function's subquery into one join over the distinct questions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import wordlists as words
from tallyloom.functions.text import SPACES, lists_found, match_key
from tallyloom.operators.text import chunk_lines
from tallyloom.operators.vectors import SCORE_DECIMALS, TermModel
from tallyloom.plans import answers

# The most chunks a question retrieves. Fewer than that many share a term with it only where chunks that share none fill up; the
# first twice as many ids then hold enough of those.
MOST_HITS = 6
FIRST_IDS = 2 * MOST_HITS
ANY_TYPE = ""
WORD, QUOTES = r"[\p{L}\p{N}]+", "[\"']"

PRODUCT_KINDS = {"warranty": answers.WARRANTY, "specs": answers.TECH_SPECS, "certifications": answers.CERTIFICATIONS}


# The lists that a line is held against; a line's own words decide which answers may print it.
_WORD_LISTS = {
    **{f"{name} skip": kind.skip for name, kind in PRODUCT_KINDS.items()},
    **{f"{name} words": kind.keywords for name, kind in PRODUCT_KINDS.items()},
    "profile skip": words.SPEC_METADATA_WORDS,
    "search skip": words.METADATA_WORDS,
    "discount skip": words.DISCOUNT_METADATA_WORDS,
    "discount words": words.DISCOUNT_WORDS,
    **{f"section {name}": found for name, found in answers.PROFILE_SECTIONS.items()},
    **{f"warranty of {name}": found for name, found in words.WARRANTY_OTHER_PRODUCT_MARKERS.items()},
    **{f"other of {name}": found for name, found in words.OTHER_PRODUCT_MARKERS.items()},
}


def _named(conditions: Mapping[str, Column]) -> Column:
    """The names whose conditions hold."""
    return F.array_compact(F.array(*(F.when(condition, F.lit(name)) for name, condition in conditions.items())))


def answer_lines(chunks: DataFrame) -> DataFrame:
    """Every cleaned line of the chunks with its match key, the answers that may print it, its section and the products it excludes."""
    lines = chunk_lines(chunks.select("chunk_id", "chunk_text")).withColumn("_found", lists_found("lowered", _WORD_LISTS))
    has = lambda name: F.col("_found")[name]
    uses = {name: ~has(f"{name} skip") & has(f"{name} words") for name in (*PRODUCT_KINDS, "discount")}
    uses |= {name: ~has(f"{name} skip") for name in ("profile", "search")}
    section = F
    for name in answers.PROFILE_SECTIONS:
        section = section.when(has(f"section {name}"), name)
    return lines.select(
        "chunk_id", "line_no", "line",
        match_key("line").alias("key"),
        _named(uses).alias("uses"),
        section.when(F.length("line") > 15, "features").alias("section"),
        _named({name: has(f"warranty of {name}") for name in words.WARRANTY_OTHER_PRODUCT_MARKERS}).alias("foreign_warranty"),
        _named({name: has(f"other of {name}") for name in words.OTHER_PRODUCT_MARKERS}).alias("foreign_other"),
    ).where(F.size("uses") > 0)


def postings(emb: DataFrame) -> DataFrame:
    """bucket, chunk_id, doc_type, weight: the entries other than zero of each vector, at unit length."""
    entries = emb.select("chunk_id", "doc_type", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    exploded = entries.withColumn("length", length).select("chunk_id", "doc_type", "length", F.posexplode("v").alias("bucket", "x"))
    return exploded.where("x <> 0").select("bucket", "chunk_id", "doc_type", (F.col("x") / F.col("length")).alias("weight"))


def first_chunks(emb: DataFrame) -> DataFrame:
    """wanted, chunk_id: the ``FIRST_IDS`` smallest ids that have a vector, of each type and of any."""
    held = emb.where(F.exists("embedding", lambda x: x != 0)).select("doc_type", "chunk_id")
    each = held.select(F.explode(F.array("doc_type", F.lit(ANY_TYPE))).alias("wanted"), "chunk_id").where("wanted is not null")
    place = F.row_number().over(Window.partitionBy("wanted").orderBy("chunk_id"))
    return each.withColumn("place", place).where(F.col("place") <= FIRST_IDS).drop("place")


def store_answer_index(emb: DataFrame, model: TermModel, folder: str) -> None:
    """Write the index of ``emb``, chunks with vectors of ``model``, as Parquet tables under ``folder``.

    ``emb`` is read several times, so it should be a stored table. Term rows lie in one folder a bucket, and a question reads the folders of
    its own words only; the range sort splits a bucket that many chunks share.
    """
    spark = emb.sparkSession
    ordered = postings(emb).repartitionByRange("bucket", "chunk_id").sortWithinPartitions("bucket", "chunk_id")
    ordered.write.partitionBy("bucket").mode("overwrite").parquet(f"{folder}/postings")
    # Texts are dealt out before their lines are made, so that the many conditions on a line run once and in all tasks.
    lines = answer_lines(emb.select("chunk_id", "chunk_text").repartition("chunk_id"))
    lines.sortWithinPartitions("chunk_id", "line_no").write.mode("overwrite").parquet(f"{folder}/lines")
    first_chunks(emb).write.mode("overwrite").parquet(f"{folder}/first")
    weights = spark.createDataFrame([(b, w) for b, w in enumerate(model.idf)], "bucket int, weight double")
    weights.coalesce(1).write.mode("overwrite").parquet(f"{folder}/weights")


def _buckets(text: str, bucket: str) -> str:
    """The bucket of each word of a text."""
    return f"transform(regexp_extract_all(lower({text}), {_text(WORD)}, 0), w -> {bucket})"


def _counted(buckets: str, weights: str) -> str:
    """Each bucket of some with its count times its weight."""
    times = f"aggregate(all, 0, (n, x) -> n + CAST(x = b AS INT)) * element_at({weights}, b + 1)"
    structs = f"transform(array_distinct(all), b -> struct(b AS bucket, {times} AS u))"
    return f"filter(transform(array({buckets}), all -> {structs})[0], t -> t.u > 0)"


def _unit(terms: str) -> str:
    """Weighted buckets at unit length."""
    length = "sqrt(aggregate(all, 0.0D, (s, t) -> s + t.u * t.u))"
    return f"transform(array({terms}), all -> transform(all, t -> struct(t.bucket AS bucket, t.u / {length} AS u)))[0]"


def _single(terms: str) -> str:
    return f"transform({terms}, t -> struct(t.bucket AS bucket, CAST(CAST(t.u AS FLOAT) AS DOUBLE) AS u))"


def _text(value: str) -> str:
    """A SQL string literal; JSON's escapes are SQL's."""
    return json.dumps(value)


def _hits(view: str, terms: str, wanted: str, k: int, first: str | None) -> str:
    """chunk_id and rank of the ``k`` best chunks for a question's terms; ties go to smaller ids.

    ``first`` is an array of the first ids where the type asked for is known; else they are met by type.
    """
    asked = (
        f"SELECT {terms} AS terms,"
        f" CASE WHEN lower({wanted}) = 'all' THEN {_text(ANY_TYPE)} ELSE coalesce({wanted}, {_text(ANY_TYPE)}) END AS wanted"
    )
    some = f"(SELECT wanted FROM ({asked}) WHERE size(terms) > 0) a"
    fill = f"{some} LATERAL VIEW explode({first}) e AS chunk_id" if first else f"{some} JOIN {view}_first f ON f.wanted = a.wanted"
    found = f"""
SELECT p.chunk_id, round(sum(p.weight * t.u), {SCORE_DECIMALS}) AS score
FROM (SELECT wanted, term.bucket AS bucket, term.u AS u FROM ({asked}) LATERAL VIEW explode(terms) e AS term) t
JOIN {view}_postings p ON p.bucket = t.bucket AND (t.wanted = {_text(ANY_TYPE)} OR p.doc_type = t.wanted)
GROUP BY p.chunk_id
UNION ALL
SELECT chunk_id, 0.0D AS score FROM {fill}"""
    best = f"SELECT chunk_id, max(score) AS score FROM ({found}) GROUP BY chunk_id ORDER BY score DESC, chunk_id LIMIT {k}"
    return f"SELECT chunk_id, row_number() OVER (ORDER BY score DESC, chunk_id) AS rank FROM ({best})"


def _lines(view: str, hits: str, use: str, least_key: int, by: str = "", product: str = "", markers: str = "foreign_other") -> str:
    """key and the first (rank, line_no, line) of each match key of a question's lines, by ``by`` if that is given."""
    own = f"{by}, " if by else ""
    where = [f"array_contains(l.uses, {_text(use)})", f"length(l.key) >= {least_key}"]
    if by:
        where.append(f"l.{by} IS NOT NULL")
    if product:
        bare = f"regexp_replace(lower({product}), {_text(QUOTES)}, '')"
        where.append(f"coalesce(NOT array_contains(l.{markers}, trim(BOTH {_text(SPACES)} FROM {bare})), true)")
    return f"""
SELECT {own}l.key, min(struct(h.rank, l.line_no, l.line)) AS f
FROM ({hits}) h JOIN {view}_lines l ON l.chunk_id = h.chunk_id WHERE {" AND ".join(where)} GROUP BY {own}l.key"""


def _joined(prefix: str, struct: str, sep: str, last: str) -> str:
    """Aggregate: the last field of the structs in order, each behind ``prefix``; NULL structs are left out."""
    return f"array_join(transform(array_sort(collect_list({struct})), s -> concat({_text(prefix)}, s.{last})), {_text(sep)})"


def _listed(lines: str, prefix: str, limit: int | None) -> str:
    """The body of an answer that lists the first ``limit`` lines."""
    if limit is not None:
        lines = f"SELECT f FROM (SELECT f, row_number() OVER (ORDER BY f) AS place FROM ({lines})) WHERE place <= {limit}"
    return f"SELECT {_joined(prefix, 'f', chr(10), 'line')} AS body FROM ({lines})"


def _searched(lines: str, lines_per_chunk: int = 8) -> str:
    """The body of a search answer: the first lines of each hit, hits apart."""
    placed = f"SELECT f, row_number() OVER (PARTITION BY f.rank ORDER BY f) AS place FROM ({lines})"
    hits = f"SELECT f.rank AS rank, {_joined('', 'f', chr(10), 'line')} AS line FROM ({placed}) WHERE place <= {lines_per_chunk} GROUP BY f.rank"
    return f"SELECT {_joined('', 'struct(rank, line)', answers.HIT_BREAK, 'line')} AS body FROM ({hits})"


def _profile(lines: str) -> str:
    """The body of a product's profile: lines under the heading of their section."""
    placed = (
        "SELECT section, f, length(key) > 5 AS listable,"
        f" sum(CAST(length(key) > 5 AS INT)) OVER (PARTITION BY section ORDER BY f) AS place FROM ({lines})"
    )
    parts = []
    for name, heading, limit in answers.PROFILE_LAYOUT:
        here = f"section = {_text(name)}"
        shown = f"CASE WHEN {here} AND listable AND place <= {limit} THEN f END"
        parts.append(f"CASE WHEN max({here}) THEN concat({_text(chr(10) * 2 + heading + ':' + chr(10))}, {_joined('* ', shown, chr(10), 'line')}) END")
    return f"SELECT concat_ws('', {', '.join(parts)}) AS body FROM ({placed})"


def _function(spark: SparkSession, name: str, parameters: Sequence[str], title: str, body: str, nothing: str) -> None:
    taken = ", ".join(f"{p} STRING" for p in parameters)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({taken}) RETURNS STRING RETURN"
        f" coalesce(concat({title}, nullif(({body}), '')), {nothing})"
    )


def register_answers(spark: SparkSession, folder: str, name: str = "rag_{}_raw", view: str = "answer_index") -> None:
    """The seven answer functions of the session over the index in ``folder``, called by ``name`` with the answer's name in it.

    get_warranty, get_tech_specs, get_certifications and get_product_policy take a product, search_product_docs a text, search_by_doc_type
    a text and a document type (NULL, empty or "all" for any), get_discount_by_category a category and a region. Each gives the text that its counterpart
    in ``plans.answers`` gives; a NULL product or text gives NULL or the not-found sentence, as there. They work on literals and on columns.
    """
    tables = {table: spark.read.parquet(f"{folder}/{table}") for table in ("lines", "first")}
    chunk_id = tables["lines"].schema["chunk_id"].dataType.simpleString()
    # Without any row there are no folders to tell the columns from.
    tables["postings"] = spark.read.schema(f"chunk_id {chunk_id}, doc_type string, weight double, bucket int").parquet(f"{folder}/postings")
    for table, rows in tables.items():
        rows.createOrReplaceTempView(f"{view}_{table}")
    of_known = tables["first"].where(F.col("wanted").isin(ANY_TYPE, "product_spec", "discount_policy"))  # FIRST_IDS rows each
    first_ids: dict[str, list[str]] = {}
    for row in of_known.select("wanted", F.col("chunk_id").cast("string").alias("id")).collect():
        first_ids.setdefault(row.wanted, []).append(row.id)
    held = spark.read.parquet(f"{folder}/weights").orderBy("bucket").collect()
    weights = f"array({', '.join(f'{r.weight!r}D' for r in held)})"
    bucket = f"CAST(pmod(CAST(conv(substr(md5(w), 1, 8), 16, 10) AS BIGINT), {len(held)}) AS INT)"
    def hits(question: str, wanted: str, k: int) -> str:
        # The same steps as in embedding: counts times rarity at unit length, stored in single precision, then compared at unit length.
        terms = _unit(_single(_unit(_counted(_buckets(question, bucket), weights))))
        if wanted == "doc_type":
            return _hits(view, terms, wanted, k, None)
        first = ", ".join(f"CAST({_text(i)} AS {chunk_id})" for i in first_ids.get(wanted, ()))
        return _hits(view, terms, _text(wanted), k, f"CAST(array({first}) AS ARRAY<{chunk_id}>)")

    def asked(kind: str, arguments: str) -> str:
        return f"concat({_text(words.QUESTION_PREFIXES[kind])}, {arguments})"

    for kind, called in (("warranty", "get_warranty"), ("specs", "get_tech_specs"), ("certifications", "get_certifications")):
        answer = PRODUCT_KINDS[kind]
        markers = "foreign_warranty" if kind == "warranty" else "foreign_other"
        lines = _lines(view, hits(asked(kind, "product"), "product_spec", 6), kind, 6, "", "product", markers)
        _function(
            spark, name.format(called), ["product"], f"concat({_text(answer.title)}, product, {_text(':' + chr(10) * 2)})",
            _listed(lines, "• ", answer.limit), f"concat({_text(answer.nothing + chr(39))}, product, {_text(chr(39) + '.')})",
        )
    lines = _lines(view, hits(asked("profile", "product"), "product_spec", 6), "profile", 0, "section", "product")
    _function(
        spark, name.format("get_product_policy"), ["product"], "concat('Full Product Profile: ', product)", _profile(lines),
        "concat('No information found for ', product)",
    )
    quoted = """concat("'", query_text, "'")"""
    lines = _lines(view, hits("query_text", ANY_TYPE, 5), "search", 0)
    _function(
        spark, name.format("search_product_docs"), ["query_text"], f"concat('Search results for ', {quoted}, {_text(':' + chr(10) * 2)})",
        _searched(lines), "'No matching product documentation found.'",
    )
    label = "CASE doc_type WHEN 'product_spec' THEN 'Product Specification' WHEN 'discount_policy' THEN 'Discount Policy' ELSE 'Documentation' END"
    lines = _lines(view, hits("query_text", "doc_type", 5), "search", 0)
    _function(
        spark, name.format("search_by_doc_type"), ["query_text", "doc_type"], f"concat({label}, ' results for ', {quoted}, {_text(':' + chr(10) * 2)})",
        _searched(lines), f"concat('No ', coalesce(doc_type, 'None'), ' documentation found for: ', {quoted}, '.')",
    )
    lines = _lines(view, hits(asked("discount", "category_name, ' region ', region_name"), "discount_policy", 5), "discount", 0)
    _function(
        spark, name.format("get_discount_by_category"), ["category_name", "region_name"],
        f"concat('Discount Policy for ', category_name, ' - ', region_name, {_text(' region:' + chr(10) * 2)})", _listed(lines, "* ", 20),
        "concat('No discount policy found for ', category_name, ' in ', region_name, ' region.')",
    )
