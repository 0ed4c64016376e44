"""Document, retrieval and refresh operators against SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, cte
from tallyloom.functions import wordlists as words
from tallyloom.operators import cells
from tallyloom.operators import text as t
from tallyloom.operators import vectors as v
from tallyloom.operators.audits import embedding_audit
from tallyloom.operators.ranking import first_n_per, top_n
from tallyloom.plans import answers
from tallyloom.session import park, scratch_path
from tallyloom.sources import adapters
from tallyloom.sources.documents import assemble_documents
from tallyloom.sources.files import create_table_as, rewrite_table
from tallyloom.streaming import changes
from tallyloom.streaming.refresh import compact_index, current_index, freshness, refresh_index

# The test texts have line breaks but no blank lines.
LINE_BREAKS = "\n+"
TYPED = "CASE WHEN {0} % 2 = 0 THEN 'product_spec' ELSE 'discount_policy' END"

cte(
    "docs",
    f"""SELECT doc_id, source AS file_name, 'doc://' || doc_id AS source_url,
  {TYPED.format("doc_id")} AS doc_type, text AS raw_content FROM documents""",
)
cte(
    "paragraphs",
    """SELECT * EXCLUDE (raw_content), unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS n
FROM (SELECT *, regexp_split_to_array(raw_content, '\\n+') AS parts FROM docs)""",
)
cte(
    "doc_chunks",
    """SELECT sha256(concat_ws('|', file_name, source_url, n)) AS chunk_id, file_name, source_url,
  doc_type, cast(NULL AS varchar) AS section_title, trim(part, ' ') AS chunk_text FROM paragraphs
WHERE length(trim(part, ' ')) > 80""",
)

_SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _clean(line: str) -> str:
    """SQL for a cleaned line: without look-around, rejoining takes the same step twice."""
    for _ in range(2):
        line = f"regexp_replace({line}, '([A-Za-z]){_SPACE}([a-z])', '\\1\\2', 'g')"
    line = f"regexp_replace({line}, '{_SPACE}{{2,}}', ' ', 'g')"
    line = f"replace(replace({line}, '•', ''), chr(0), '')"
    return f"regexp_replace({line}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _has(column: str, listed) -> str:
    quoted = ("'" + word.replace("'", "''") + "'" for word in listed)
    return "(" + " OR ".join(f"contains({column}, {word})" for word in quoted) + ")"


_KEY = "regexp_replace(lower(line), '[^a-z0-9]', '', 'g')"


def _lines(source: str, text: str, kept: str) -> str:
    """SQL for cleaned lines of at least eight characters with their place and key."""
    return f"""SELECT *, lower(line) AS lowered, {_KEY} AS key FROM
  (SELECT {kept}, line_no - 1 AS line_no, {_clean("raw")} AS line FROM
    (SELECT {kept}, unnest(parts) AS raw, generate_subscripts(parts, 1) AS line_no FROM
      (SELECT {kept}, string_split({text}, chr(10)) AS parts FROM {source}
       WHERE {text} IS NOT NULL)))
  WHERE length(line) >= 8"""


cte("doc_lines", _lines("docs", "raw_content", "doc_id, file_name"))


def docs(spark, sf):
    return adapters.documents(spark, sf)


def chunks(spark, sf):
    return t.chunk_documents(docs(spark, sf), LINE_BREAKS)


def _doc_rows(spark, sf):
    return adapters.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("file_name"), "lang", F.col("text").alias("chunk_text")
    )


def _assembled(spark, sf):
    turns = adapters.table(spark, sf, "conversations")
    return assemble_documents(turns, "conv_id", "turn", "text", pages_per_block=4)


_ASSEMBLED = """SELECT conv_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)
  AS raw_content FROM conversations GROUP BY conv_id"""


@check("s7_assemble_documents", _ASSEMBLED)
def _(spark, sf):
    return _assembled(spark, sf).drop("ingested_at")


@check("t1_chunk_documents", "SELECT * FROM doc_chunks")
def _(spark, sf):
    return chunks(spark, sf).drop("ingested_at")


@check(
    "t1_chunk_blank_lines",
    f"""SELECT conv_id, n, trim(part, ' ') AS chunk_text FROM
  (SELECT conv_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS n FROM
    (SELECT conv_id, regexp_split_to_array(raw_content, '\\n\\s*\\n') AS parts FROM ({_ASSEMBLED})))
WHERE length(trim(part, ' ')) > 80""".replace("conv_id, n, trim", "conv_id, trim"),
)
def _(spark, sf):
    files = _assembled(spark, sf).select(
        F.col("conv_id").alias("file_name"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit("product_spec").alias("doc_type"),
        "raw_content",
    )
    return t.chunk_documents(files).select(F.col("file_name").alias("conv_id"), "chunk_text")


@check(
    "p12_null_column",
    "SELECT doc_type, section_title, count(*) AS n FROM doc_chunks GROUP BY ALL",
)
def _(spark, sf):
    return chunks(spark, sf).groupBy("doc_type", "section_title").agg(F.count(F.lit(1)).alias("n"))


@check(
    "t2_clean_line",
    "SELECT doc_id, line_no, line FROM doc_lines",
)
def _(spark, sf):
    return t.chunk_lines(_doc_rows(spark, sf)).select("doc_id", "line_no", "line")


_SPLIT = "([A-Za-z]) ([a-z])"


@check(
    "t3_repair_chunks",
    f"""SELECT doc_id, regexp_replace(text, '{_SPLIT}', '\\1\\2', 'g') AS chunk_text FROM documents
WHERE regexp_matches(text, '[A-Za-z] [a-z]')
UNION ALL SELECT doc_id, text FROM documents WHERE NOT regexp_matches(text, '[A-Za-z] [a-z]')""",
)
def _(spark, sf):
    return t.repair_chunks(_doc_rows(spark, sf)).select("doc_id", "chunk_text")


@check(
    "t3_repair_stored_table",
    f"""SELECT doc_id, CASE WHEN regexp_matches(text, '[A-Za-z] [a-z]')
  THEN regexp_replace(text, '{_SPLIT}', '\\1\\2', 'g') ELSE text END AS chunk_text FROM documents""",
)
def _(spark, sf):
    first, second = scratch_path(spark, "chunks"), scratch_path(spark, "chunks")
    name = "repaired_" + first.rsplit("-", 1)[1]
    create_table_as(spark, name, _doc_rows(spark, sf).select("doc_id", "chunk_text"), first)
    return rewrite_table(spark, name, t.repair_chunks, second)


@check(
    "p15_regex_predicate",
    "SELECT doc_id FROM documents WHERE regexp_matches(text, '[A-Za-z] [a-z]')",
)
def _(spark, sf):
    rows = _doc_rows(spark, sf)
    return rows.where(F.col("chunk_text").rlike("[A-Za-z] [a-z]")).select("doc_id")


# Words that occur in the test texts.
FOUND_WORDS = ["license", "iso", "@"]


@check(
    "t4_extract_lines",
    f"""SELECT doc_id, line_no, line FROM doc_lines WHERE {_has("lowered", FOUND_WORDS)}
  AND NOT {_has("lowered", words.METADATA_WORDS)}""",
)
def _(spark, sf):
    found = t.extract_lines(_doc_rows(spark, sf), words.METADATA_WORDS, FOUND_WORDS)
    return found.select("doc_id", "line_no", "line")


# Words that mark a line as another language's, by the language asked for.
FOREIGN = {"en": ["ement", "ich"], "fr": ["tion", "sch"], "de": ["eaux", "ing"]}


@check(
    "j10_drop_foreign_lines",
    f"""SELECT l.doc_id, line_no, line FROM doc_lines l JOIN documents d ON l.doc_id = d.doc_id
WHERE NOT ({" OR ".join(f"(lang = '{k}' AND {_has('lowered', w)})" for k, w in FOREIGN.items())})""",
)
def _(spark, sf):
    lines = t.chunk_lines(_doc_rows(spark, sf))
    return t.drop_foreign_lines(lines, FOREIGN, "lang").select("doc_id", "line_no", "line")


@check(
    "t5_dedupe_lines",
    """SELECT file_name, doc_id, line_no, line FROM doc_lines WHERE length(key) > 5
QUALIFY row_number() OVER (PARTITION BY file_name, key ORDER BY doc_id, line_no) = 1""",
)
def _(spark, sf):
    lines = t.chunk_lines(_doc_rows(spark, sf)).select("file_name", "doc_id", "line_no", "line")
    return t.dedupe_lines(lines, ["file_name"], ["doc_id", "line_no"]).select(
        "file_name", "doc_id", "line_no", "line"
    )


def _like(column: str, pattern: str) -> str:
    return f"lower({column}) LIKE '%{pattern.lower()}%'"


@check(
    "t6_search_product_docs",
    f"""SELECT chunk_id, file_name, doc_type, chunk_text, source_url FROM doc_chunks
WHERE {_like("chunk_text", "Eaux")} OR {_like("file_name", "Eaux")}
ORDER BY chunk_id LIMIT 5""",
)
def _(spark, sf):
    return t.search_product_docs(chunks(spark, sf), "Eaux")


def _lookup(spark, sf, call):
    """The rows of a lookup that is registered as a table function over the chunks."""
    view = "lookup_chunks"
    chunks(spark, sf).createOrReplaceTempView(view)
    t.register_lookups(spark, view, view)
    return spark.sql(f"SELECT * FROM {call}")


@check(
    "t6_search_by_sql_function",
    f"""SELECT chunk_id, file_name, doc_type, chunk_text, source_url FROM doc_chunks
WHERE {_like("chunk_text", "Eaux")} OR {_like("file_name", "Eaux")}
ORDER BY chunk_id LIMIT 5""",
)
def _(spark, sf):
    return _lookup(spark, sf, "search_product_docs('Eaux')")


@check(
    "t7_policy_by_sql_function",
    f"""SELECT chunk_id, file_name, doc_type, chunk_text FROM doc_chunks
WHERE {_like("chunk_text", "iso")} ORDER BY doc_type, chunk_id LIMIT 10""",
)
def _(spark, sf):
    return _lookup(spark, sf, "get_product_policy('iso')")


@check(
    "t8_discount_by_sql_function",
    f"""SELECT chunk_id, doc_type, chunk_text FROM doc_chunks WHERE doc_type = 'discount_policy'
  AND {_like("chunk_text", "tion")} AND {_like("chunk_text", "and")}
ORDER BY chunk_id LIMIT 5""",
)
def _(spark, sf):
    return _lookup(spark, sf, "get_discount_by_category('tion', 'and')")


@check(
    "p13_keyword_predicate",
    f"""SELECT chunk_id FROM doc_chunks
WHERE {_like("chunk_text", "src1_")} OR {_like("file_name", "src1_")}""",
)
def _(spark, sf):
    found = t.like_anywhere("chunk_text", "src1_") | t.like_anywhere("file_name", "src1_")
    return chunks(spark, sf).where(found).select("chunk_id")


@check(
    "t7_get_product_policy",
    f"""SELECT chunk_id, file_name, doc_type, chunk_text FROM doc_chunks
WHERE {_like("chunk_text", "iso")} ORDER BY doc_type, chunk_id LIMIT 10""",
)
def _(spark, sf):
    return t.get_product_policy(chunks(spark, sf), "iso")


@check(
    "o4_ordered_limit",
    """SELECT doc_type, chunk_id FROM doc_chunks ORDER BY doc_type, chunk_id LIMIT 10""",
)
def _(spark, sf):
    return top_n(chunks(spark, sf).select("doc_type", "chunk_id"), ["doc_type", "chunk_id"], 10)


@check(
    "t8_get_discount_by_category",
    f"""SELECT chunk_id, doc_type, chunk_text FROM doc_chunks WHERE doc_type = 'discount_policy'
  AND {_like("chunk_text", "tion")} AND {_like("chunk_text", "and")}
ORDER BY chunk_id LIMIT 5""",
)
def _(spark, sf):
    return t.get_discount_by_category(chunks(spark, sf), "tion", "and")


@check(
    "p14_conjunctive_predicate",
    f"""SELECT chunk_id FROM doc_chunks WHERE doc_type = 'discount_policy'
  AND {_like("chunk_text", "tion")} AND {_like("chunk_text", "and")}""",
)
def _(spark, sf):
    found = (
        (F.col("doc_type") == "discount_policy")
        & t.like_anywhere("chunk_text", "tion")
        & t.like_anywhere("chunk_text", "and")
    )
    return chunks(spark, sf).where(found).select("chunk_id")


@check("o5_limit_by_id", "SELECT chunk_id, file_name FROM doc_chunks ORDER BY chunk_id LIMIT 5")
def _(spark, sf):
    return top_n(chunks(spark, sf).select("chunk_id", "file_name"), ["chunk_id"], 5)


@check(
    "o7_first_n_per_group",
    """SELECT file_name, doc_id, line_no, line,
  row_number() OVER (PARTITION BY file_name ORDER BY doc_id, line_no) AS position
FROM doc_lines QUALIFY position <= 8""",
)
def _(spark, sf):
    lines = t.chunk_lines(_doc_rows(spark, sf)).select("file_name", "doc_id", "line_no", "line")
    return first_n_per(lines, ["file_name"], ["doc_id", "line_no"], 8)


@check(
    "p21_doc_type_filter",
    "SELECT chunk_id, doc_type FROM doc_chunks WHERE doc_type = 'product_spec'",
)
def _(spark, sf):
    unfiltered = t.doc_type_filter(chunks(spark, sf), "ALL")
    return t.doc_type_filter(unfiltered, "product_spec").select("chunk_id", "doc_type")


def _sectioned(lowered: str = "lowered") -> str:
    chain = " ".join(
        f"WHEN {_has(lowered, listed)} THEN '{name}'"
        for name, listed in answers.PROFILE_SECTIONS.items()
    )
    return f"CASE {chain} WHEN length(line) > 15 THEN 'features' END"


@check(
    "t9_classify_lines",
    f"""SELECT doc_id, line_no, section, line FROM
  (SELECT *, {_sectioned()} AS section FROM doc_lines
   WHERE NOT {_has("lowered", words.SPEC_METADATA_WORDS)}) WHERE section IS NOT NULL""",
)
def _(spark, sf):
    rows = _doc_rows(spark, sf).withColumns({"rank": F.lit(1), "product_keyword": F.lit("")})
    lines = answers.classify_lines(rows, ["doc_id"])
    return lines.select("doc_id", "line_no", "section", "line")


# --- vectors -----------------------------------------------------------------------------------

cte(
    "emb_chunks",
    f"""SELECT vec_id AS chunk_id, 'file' || label AS file_name, 'doc://' || vec_id AS source_url,
  {TYPED.format("label")} AS doc_type, 'entry ' || vec_id AS chunk_text, embedding FROM embeddings""",
)
_NAMES = ", ".join(f"'{name}'" for name in adapters.PRODUCTS)
cte(
    "label_questions",
    f"""SELECT label AS query_id, arg_min(embedding, vec_id) AS qvec,
  coalesce(list_extract([{_NAMES}], label + 1), 'Item ' || label) AS product_keyword,
  'about ' || label AS query_text,
  list_extract(['product_spec', 'discount_policy', 'All'], label % 3 + 1) AS doc_type,
  'Category ' || label AS category_name, 'Region ' || label AS region_name
FROM embeddings GROUP BY label""",
)
cte(
    "scored",
    """SELECT q.query_id, q.product_keyword, q.doc_type AS asked_type, c.* EXCLUDE (embedding),
  round(list_cosine_similarity(c.embedding::double[], q.qvec::double[]), 6) AS score
FROM label_questions q CROSS JOIN emb_chunks c""",
)


def _hits(k: int | str, condition: str = "true", source: str = "scored") -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)
  AS rank FROM {source} WHERE {condition} QUALIFY rank <= {k}"""


cte("hits_discount_5", _hits(5, "doc_type = 'discount_policy'"))
cte("hits_any_5", _hits(5))
cte("hits_any_8", _hits(8))


def emb(spark, sf):
    return adapters.embedded_chunks(spark, sf)


def questions(spark, sf):
    return adapters.label_questions(spark, sf)


def _first_vector(spark, sf):
    return questions(spark, sf).orderBy("query_id").select("qvec").first()[0]


_HIT = "rank, score, chunk_id, file_name, source_url, doc_type, chunk_text"
_FIRST = "query_id = (SELECT min(label) FROM embeddings)"


@check("v2_nearest_to_one_vector", f"SELECT {_HIT} FROM hits_any_5 WHERE {_FIRST}")
def _(spark, sf):
    return v.similarity_topk(emb(spark, sf), _first_vector(spark, sf))


@check("v3_nearest_of_one_type", f"SELECT {_HIT} FROM hits_discount_5 WHERE {_FIRST}")
def _(spark, sf):
    return v.similarity_topk(emb(spark, sf), _first_vector(spark, sf), 5, "discount_policy")


@check("v4_nearest_batch", f"SELECT query_id, {_HIT} FROM hits_any_8")
def _(spark, sf):
    return v.similarity_topk_batch(emb(spark, sf), questions(spark, sf), 8)


# Every other chunk is cut to 32 numbers, and every third question; top_k 0 and NULL mean five.
cte(
    "mixed_chunks",
    """SELECT * REPLACE (CASE WHEN chunk_id % 2 = 0 THEN embedding[:32] ELSE embedding END AS embedding)
FROM emb_chunks""",
)
cte(
    "mixed_questions",
    """SELECT query_id, CASE WHEN query_id % 3 = 0 THEN qvec[:32] ELSE qvec END AS qvec,
  list_extract([0, 3, NULL, 7], query_id % 4 + 1) AS top_k FROM label_questions""",
)
cte(
    "mixed_scored",
    """SELECT q.query_id, coalesce(nullif(top_k, 0), 5) AS top_k, c.* EXCLUDE (embedding),
  round(list_cosine_similarity(c.embedding::double[], q.qvec::double[]), 6) AS score
FROM mixed_questions q JOIN mixed_chunks c ON len(c.embedding) = len(q.qvec)""",
)


@check(
    "v4_mixed_lengths_and_limits",
    f"SELECT query_id, {_HIT} FROM ({_hits('top_k', source='mixed_scored')})",
)
def _(spark, sf):
    def cut(column, when):
        return F.expr(f"CASE WHEN {when} THEN slice({column}, 1, 32) ELSE {column} END")

    mixed = emb(spark, sf).withColumn("embedding", cut("embedding", "chunk_id % 2 = 0"))
    asked = questions(spark, sf).select(
        F.col("query_id").cast("smallint").alias("query_id"),
        cut("qvec", "query_id % 3 = 0").alias("qvec"),
        F.expr("element_at(array(0, 3, NULL, 7), query_id % 4 + 1)").alias("top_k"),
    )
    return v.similarity_topk_batch(mixed, asked)


@check(
    "o6_nearest_in_passes",
    """SELECT query_id, rank, score, chunk_id FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM
    (SELECT q.vec_id AS query_id, c.chunk_id,
       round(list_cosine_similarity(c.embedding::double[], q.embedding::double[]), 6) AS score
     FROM embeddings q CROSS JOIN emb_chunks c)) WHERE rank <= 5""",
)
def _(spark, sf):
    # every chunk asks for its nearest
    asked = adapters.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec")
    )
    hits = v.similarity_topk_batch(emb(spark, sf), asked, 5)
    return hits.select("query_id", "rank", "score", "chunk_id")


# The cell index: the 16 chunks of smallest id give the cells; the four nearest are looked into, and
# more until there are as many chunks of the type asked for as wanted.
_CELLS, _PROBED = 16, 4
cte(
    "centers",
    f"""SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cell, embedding AS center
FROM (FROM embeddings ORDER BY vec_id LIMIT {_CELLS})""",
)


def _to_center(vector: str) -> str:
    return f"round(list_cosine_similarity({vector}::double[], center::double[]), 6)"


cte(
    "celled",
    f"""SELECT c.*, cell FROM emb_chunks c CROSS JOIN centers
QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY {_to_center("embedding")} DESC, cell) = 1""",
)
cte("cell_sizes", "SELECT cell, doc_type AS held_type, count(*) AS held FROM celled GROUP BY ALL")
cte(
    "probes",
    f"""SELECT * FROM (SELECT *, coalesce(sum(fitting) OVER (PARTITION BY query_id ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM
  (SELECT query_id, qvec, asked_type, cell, place, coalesce(sum(held) FILTER
     (WHERE asked_type = 'All' OR held_type = asked_type), 0) AS fitting FROM
    (SELECT query_id, qvec, doc_type AS asked_type, cell, row_number() OVER
       (PARTITION BY query_id ORDER BY {_to_center("qvec")} DESC, cell) AS place
     FROM label_questions CROSS JOIN centers) LEFT JOIN cell_sizes USING (cell) GROUP BY ALL))
WHERE place <= {_PROBED} OR so_far < 7""",
)
cte(
    "cell_scored",
    """SELECT p.query_id, c.* EXCLUDE (embedding, cell),
  round(list_cosine_similarity(c.embedding::double[], p.qvec::double[]), 6) AS score
FROM probes p JOIN celled c USING (cell) WHERE asked_type = 'All' OR asked_type = doc_type""",
)


@check(
    "v5_nearest_approximate",
    f"SELECT query_id, {_HIT} FROM ({_hits(7, source='cell_scored')})",
)
def _(spark, sf):
    index = v.cell_index(emb(spark, sf), 64, _CELLS, _PROBED)
    asked = questions(spark, sf).select("query_id", "qvec", F.col("doc_type").alias("doc_filter"))
    return v.search_cells(index, asked, 7)


def _recall(exact, near, floor=0.9):
    """Whether ``near`` has at least that part of the exact hits."""
    ids = ["query_id", "chunk_id"]
    both = exact.select(*ids).join(near.select(*ids).withColumn("hit", F.lit(1)), ids, "left")
    return both.agg((F.count("hit") >= floor * F.count("*")).alias("enough"))


@check("v5_recall_floor", "SELECT true AS enough")
def _(spark, sf):
    # the default index against the exact search, every 20th chunk asking
    held = emb(spark, sf)
    asked = held.where("chunk_id % 20 = 0").select(
        F.col("chunk_id").alias("query_id"), F.col("embedding").alias("qvec")
    )
    near = v.search_cells(v.cell_index(held, 64), asked, 10)
    return _recall(v.similarity_topk_batch(held, asked, 10), near)


# The trained cells: the exact search from the two nearest of sixteen cells on, and how much of its hits the nearest twelve hold.
cte("hits_typed_7", _hits(7, "asked_type = 'All' OR asked_type = doc_type"))
cte(
    "hits_of_chunks",
    """SELECT q.chunk_id AS query_id, c.chunk_id AS hit_id FROM emb_chunks q CROSS JOIN emb_chunks c WHERE q.chunk_id % 20 = 0
QUALIFY row_number() OVER (PARTITION BY q.chunk_id
  ORDER BY round(list_cosine_similarity(c.embedding::double[], q.embedding::double[]), 6) DESC, c.chunk_id) <= 10""",
)


def _trained(spark, held):
    return cells.train_cells(held, 64, scratch_path(spark, "trained-cells"), 4, 4)


@check("v5_trained_cells_exact", f"SELECT query_id, {_HIT} FROM hits_typed_7")
def _(spark, sf):
    asked = questions(spark, sf).select("query_id", "qvec", F.col("doc_type").alias("doc_filter"))
    return _trained(spark, emb(spark, sf)).search(asked, 7, probed=2, exact=True)


@check(
    "v5_trained_cells_recall",
    "SELECT count(*) AS hits, sum(hit_id)::bigint AS id_sum, true AS enough FROM hits_of_chunks",
)
def _(spark, sf):
    held = emb(spark, sf)
    asked = held.where("chunk_id % 20 = 0").select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("qvec"))
    index, ids = _trained(spark, held), ["query_id", "chunk_id"]
    near = index.search(asked, 10, probed=12).select(*ids, F.lit(1).alias("found"))
    true = index.search(asked, 10, probed=2, exact=True).select(*ids)
    return true.join(near, ids, "left").agg(
        F.count("*").alias("hits"), F.sum("chunk_id").alias("id_sum"), (F.count("found") >= 0.9 * F.count("*")).alias("enough")
    )


# --- embedding and retrieval -------------------------------------------------------------------

_DIM = 128
cte(
    "corpus",
    f"""SELECT doc_id AS chunk_id, source AS file_name, 'doc://' || doc_id AS source_url,
  {TYPED.format("doc_id")} AS doc_type, text || chr(10) || {adapters.CORPUS_LINE} AS chunk_text
FROM documents""",
)


def _term_counts(key: str, text: str, source: str) -> str:
    return f"""SELECT {key}, ('0x' || substr(md5(word), 1, 8))::bigint % {_DIM} AS bucket,
  count(*) AS tf FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'))
    AS word FROM {source}) GROUP BY ALL"""


def _unit_terms(key: str, counts: str) -> str:
    """Weights at unit length, in single precision as they are stored."""
    return f"""SELECT {key}, bucket,
  cast(w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS float)::double AS u FROM
  (SELECT {key}, bucket, tf * coalesce(idf, ln(n + 1)) AS w
   FROM {counts} LEFT JOIN term_weights USING (bucket) CROSS JOIN corpus_size)
QUALIFY sum(w * w) OVER (PARTITION BY {key}) > 0"""


cte("corpus_terms", _term_counts("chunk_id", "chunk_text", "corpus"))
cte("corpus_size", "SELECT count(*) AS n FROM corpus")
cte(
    "term_weights",
    """SELECT bucket, ln((SELECT n + 1 FROM corpus_size) / (count(*) + 1)) AS idf
FROM corpus_terms GROUP BY bucket""",
)
cte("corpus_units", _unit_terms("chunk_id", "corpus_terms"))


def _retrieval(name: str, asked: str, question: str) -> None:
    """scored_<name>: every question of ``asked`` with every chunk that has a vector."""
    texts = f"(SELECT query_id, {question} AS question FROM {asked})"
    cte(f"terms_{name}", _term_counts("query_id", "question", texts))
    cte(f"units_{name}", _unit_terms("query_id", f"terms_{name}"))
    cte(
        f"scored_{name}",
        f"""SELECT a.* EXCLUDE (doc_type), a.doc_type AS asked_type, c.*,
  coalesce(round(dot / (qn * cn), 6), 0) AS score
FROM (SELECT query_id, sqrt(sum(u * u)) AS qn FROM units_{name} GROUP BY query_id)
CROSS JOIN (SELECT chunk_id, sqrt(sum(u * u)) AS cn FROM corpus_units GROUP BY chunk_id)
LEFT JOIN (SELECT q.query_id, c.chunk_id, sum(q.u * c.u) AS dot
  FROM units_{name} q JOIN corpus_units c USING (bucket) GROUP BY ALL) USING (query_id, chunk_id)
JOIN {asked} a USING (query_id) JOIN corpus c USING (chunk_id)""",
    )


def _prefixed(kind: str, arguments: str) -> str:
    return f"'{words.QUESTION_PREFIXES[kind]}' || {arguments}"


for _kind in (
    "warranty", "specs", "certifications", "profile", "product_documents", "product_table",
):
    _retrieval(_kind, "label_questions", _prefixed(_kind, "product_keyword"))
for _kind in ("discount", "discount_table"):
    _about = "category_name || ' region ' || region_name"
    _retrieval(_kind, "label_questions", _prefixed(_kind, _about))
_retrieval("search", "label_questions", "query_text")
cte(
    "benchmark_questions",
    """SELECT item_id AS query_id, text AS query_text, NULL AS product_keyword, NULL AS doc_type
FROM benchmark""",
)
_retrieval("benchmark", "benchmark_questions", "query_text")

_SPEC, _DISCOUNT = "doc_type = 'product_spec'", "doc_type = 'discount_policy'"
_TYPED = "lower(asked_type) = 'all' OR asked_type = doc_type"
_HIT_LINE = "query_id, rank, product_keyword, asked_type, chunk_text"
for _name, _k, _condition in (
    ("warranty", 6, _SPEC), ("specs", 6, _SPEC), ("certifications", 6, _SPEC),
    ("profile", 6, _SPEC), ("product_documents", 8, "true"), ("product_table", 8, "true"),
    ("discount", 5, _DISCOUNT), ("discount_table", 5, _DISCOUNT), ("search", 5, "true"),
    ("benchmark", 5, "true"),
):
    cte(f"hits_{_name}", _hits(_k, _condition, f"scored_{_name}"))
    cte(f"lines_{_name}", _lines(f"hits_{_name}", "chunk_text", _HIT_LINE))
cte("hits_typed", _hits(5, _TYPED, "scored_search"))
cte("lines_typed", _lines("hits_typed", "chunk_text", _HIT_LINE))
cte("hits_digest", _hits(3, "true", "scored_search"))


def corpus_model(spark, sf):
    """The answers' corpus with vectors, and their model."""
    rows = adapters.answer_corpus(spark, sf)
    model = v.fit_embedder(rows, "chunk_text", _DIM)
    return v.embed(rows, "chunk_text", model), model


def corpus(spark, sf):
    """The answers' corpus with vectors, and the embedder of its questions."""
    held, model = corpus_model(spark, sf)
    return held, answers.embed_with(model)


def _answered(ask, spark, sf, **options):
    """The answers to the test questions, their texts embedded as the corpus is."""
    held, embedder = corpus(spark, sf)
    return ask(held, questions(spark, sf).drop("qvec"), embedder, **options)


_BLANK = "coalesce(trim(chunk_text), '') = ''"


@check(
    "v1_embed_documents",
    f"""SELECT chunk_id, list(round(coalesce(u, 0), 5) ORDER BY bucket) AS embedding FROM corpus
CROSS JOIN (SELECT unnest(range({_DIM})) AS bucket) LEFT JOIN corpus_units USING (chunk_id, bucket)
WHERE NOT {_BLANK} GROUP BY chunk_id UNION ALL SELECT chunk_id, [] FROM corpus WHERE {_BLANK}""",
)
def _(spark, sf):
    rounded = F.transform("embedding", lambda x: F.round(x.cast("double"), 5))
    return corpus(spark, sf)[0].select("chunk_id", rounded.alias("embedding"))


@check(
    "v1_embedding_sizes",
    f"SELECT CASE WHEN {_BLANK} THEN 0 ELSE {_DIM} END AS dim, count(*) AS n FROM corpus GROUP BY ALL",
)
def _(spark, sf):
    return embedding_audit(corpus(spark, sf)[0])


@check(
    "v6_hit_list_round_trip",
    """SELECT query_id, cast(chunk_id AS varchar) AS chunk_id, file_name, doc_type, chunk_text,
  source_url FROM hits_any_5""",
)
def _(spark, sf):
    hits = v.similarity_topk_batch(emb(spark, sf), questions(spark, sf), 5)
    return v.json_to_hits(v.hits_to_json(hits))


@check(
    "v7_expand_query",
    f"""SELECT p_partkey, '{words.QUESTION_PREFIXES["warranty"]}' || p_name AS warranty,
  '{words.QUESTION_PREFIXES["discount"]}' || p_type || ' region ' || p_brand AS discount
FROM part""",
)
def _(spark, sf):
    return adapters.table(spark, sf, "part").select(
        "p_partkey",
        v.expand_query("warranty", F.col("p_name")).alias("warranty"),
        v.expand_query("discount", F.col("p_type"), F.lit(" region "), F.col("p_brand")).alias(
            "discount"
        ),
    )


@check(
    "d4_embedding_audit",
    "SELECT len(embedding) AS dim, count(*) AS n FROM embeddings GROUP BY ALL",
)
def _(spark, sf):
    return embedding_audit(adapters.table(spark, sf, "embeddings"))


# --- answers -----------------------------------------------------------------------------------

_NL = "chr(10)"


def _foreign(markers) -> str:
    asked = "lower(product_keyword)"
    return " OR ".join(f"({asked} = '{p}' AND {_has('lowered', w)})" for p, w in markers.items())


def _product_sql(kind: answers.ProductAnswer) -> str:
    limit = f"WHERE position <= {kind.limit}" if kind.limit else ""
    return f"""SELECT query_id, product_keyword, coalesce('{kind.title}' || product_keyword || ':'
    || {_NL} || {_NL} || body, '{kind.nothing}''' || product_keyword || '''.') AS result
FROM label_questions LEFT JOIN
  (SELECT query_id, string_agg('• ' || line, {_NL} ORDER BY rank, line_no) AS body FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, line_no) AS position FROM
      (SELECT * FROM lines_{kind.prefix} WHERE length(key) > 5
         AND NOT {_has("lowered", kind.skip)} AND NOT ({_foreign(kind.markers)})
         AND {_has("lowered", kind.keywords)}
       QUALIFY row_number() OVER (PARTITION BY query_id, key ORDER BY rank, line_no) = 1))
   {limit} GROUP BY query_id) USING (query_id)"""


def _product_check(key, ask, kind):
    @check(key, _product_sql(kind))
    def _(spark, sf):
        return _answered(ask, spark, sf).select("query_id", "product_keyword", "result")


_product_check("x1_get_warranty", answers.get_warranty, answers.WARRANTY)
_product_check("x2_get_tech_specs", answers.get_tech_specs, answers.TECH_SPECS)
_product_check("x3_get_certifications", answers.get_certifications, answers.CERTIFICATIONS)


# A warranty-style answer with words that occur in the test texts.
FOUND_ANSWER = answers.ProductAnswer(
    "warranty", ["tion", "eau", "ung", "ment"], "Lines for ", "Nothing found for ", limit=12
)


@check("t10_render_answer", _product_sql(FOUND_ANSWER))
def _(spark, sf):
    rows = _answered(answers.product_answer, spark, sf, kind=FOUND_ANSWER)
    return rows.select("query_id", "product_keyword", "result")


def _profile_sql() -> str:
    parts = " || ".join(
        f"""CASE WHEN max(CASE WHEN section = '{name}' THEN 1 ELSE 0 END) = 1
          THEN {_NL} || {_NL} || '{heading}:' || {_NL} || coalesce(string_agg('* ' || line, {_NL}
            ORDER BY rank, line_no) FILTER (WHERE section = '{name}' AND position <= {limit}), '')
          ELSE '' END"""
        for name, heading, limit in answers.PROFILE_LAYOUT
    )
    return f"""SELECT query_id, product_keyword, coalesce('Full Product Profile: ' || product_keyword
    || body, 'No information found for ' || product_keyword) AS result
FROM label_questions LEFT JOIN
  (SELECT query_id, {parts} AS body FROM
    (SELECT *, CASE WHEN fresh THEN sum(CASE WHEN fresh THEN 1 ELSE 0 END)
        OVER (PARTITION BY query_id, section ORDER BY rank, line_no) END AS position FROM
      (SELECT *, length(key) > 5 AND row_number()
          OVER (PARTITION BY query_id, section, key ORDER BY rank, line_no) = 1 AS fresh FROM
        (SELECT *, {_sectioned()} AS section FROM lines_profile
         WHERE NOT {_has("lowered", words.SPEC_METADATA_WORDS)}
           AND NOT ({_foreign(words.OTHER_PRODUCT_MARKERS)}))
       WHERE section IS NOT NULL))
   GROUP BY query_id) USING (query_id)"""


@check("x4_get_product_profile", _profile_sql())
def _(spark, sf):
    rows = _answered(answers.get_product_profile, spark, sf)
    return rows.select("query_id", "product_keyword", "result")


def _search_body_sql(source: str) -> str:
    return f"""SELECT query_id, string_agg(part, {_NL} || {_NL} || '---' || {_NL} || {_NL}
    ORDER BY rank) AS body FROM
  (SELECT query_id, rank, string_agg(line, {_NL} ORDER BY line_no) AS part FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id, rank ORDER BY line_no) AS position FROM
      (SELECT * FROM {source} WHERE NOT {_has("lowered", words.METADATA_WORDS)}
       QUALIFY row_number() OVER (PARTITION BY query_id, key ORDER BY rank, line_no) = 1))
   WHERE position <= 8 GROUP BY query_id, rank) GROUP BY query_id"""


@check(
    "x5_search_docs",
    f"""SELECT query_id, coalesce('Search results for ''' || query_text || ''':' || {_NL} || {_NL}
    || body, 'No matching product documentation found.') AS result
FROM label_questions LEFT JOIN ({_search_body_sql("lines_search")}) USING (query_id)""",
)
def _(spark, sf):
    rows = _answered(answers.search_docs, spark, sf)
    return rows.select("query_id", "result")


@check(
    "v1_text_search",
    f"""SELECT query_id, query_text, coalesce('Search results for ''' || query_text || ''':' || {_NL}
    || {_NL} || body, 'No matching product documentation found.') AS result
FROM benchmark_questions LEFT JOIN ({_search_body_sql("lines_benchmark")}) USING (query_id)""",
)
def _(spark, sf):
    held, embedder = corpus(spark, sf)
    asked = adapters.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text")
    )
    return answers.search_docs(held, asked, embedder).select("query_id", "query_text", "result")


@check("x5_search_docs_by_index", "SELECT true AS enough")
def _(spark, sf):
    # the answers' retrieval over a cell index against the exact search
    held, embedder = corpus(spark, sf)
    held = park(held, "corpus-vectors")  # read by the exact search, twice by the index and by both for texts
    asked = questions(spark, sf).drop("qvec")
    index = v.cell_index(held, _DIM)
    exact, near = (
        answers.retrieve(c, asked, embedder, F.col("query_text"), 5, F.col("doc_type"))
        for c in (held, index)
    )
    return _recall(exact, near)


@check(
    "x6_search_by_doc_type",
    f"""SELECT query_id, coalesce(CASE doc_type WHEN 'product_spec' THEN 'Product Specification'
    WHEN 'discount_policy' THEN 'Discount Policy' ELSE 'Documentation' END || ' results for '''
    || query_text || ''':' || {_NL} || {_NL} || body,
    'No ' || doc_type || ' documentation found for: ''' || query_text || '''.') AS result
FROM label_questions LEFT JOIN ({_search_body_sql("lines_typed")}) USING (query_id)""",
)
def _(spark, sf):
    rows = _answered(answers.search_by_doc_type, spark, sf)
    return rows.select("query_id", "result")


_ABOUT = "category_name || {0} || region_name || "


@check(
    "x7_get_discount",
    f"""SELECT query_id, coalesce('Discount Policy for ' || {_ABOUT.format("' - '")} ' region:'
    || {_NL} || {_NL} || body,
    'No discount policy found for ' || {_ABOUT.format("' in '")} ' region.') AS result
FROM label_questions LEFT JOIN
  (SELECT query_id, string_agg('* ' || line, {_NL} ORDER BY rank, line_no) AS body FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, line_no) AS position FROM
      (SELECT * FROM lines_discount
       WHERE NOT {_has("lowered", words.DISCOUNT_METADATA_WORDS)}
         AND {_has("lowered", words.DISCOUNT_WORDS)}
       QUALIFY row_number() OVER (PARTITION BY query_id, key ORDER BY rank, line_no) = 1))
   WHERE position <= 20 GROUP BY query_id) USING (query_id)""",
)
def _(spark, sf):
    rows = _answered(answers.get_discount, spark, sf)
    return rows.select("query_id", "result")


_CHUNK_ROW = (
    "query_id, cast(chunk_id AS varchar) AS chunk_id, file_name, doc_type, chunk_text, source_url"
)


def _table_check(key, ask, source):
    @check(key, f"SELECT {_CHUNK_ROW} FROM {source}")
    def _(spark, sf):
        return _answered(ask, spark, sf)


_table_check("x8_search_table", answers.search_table, "hits_search")
_table_check("x8_search_by_doc_type_table", answers.search_by_doc_type_table, "hits_typed")
_table_check("x8_product_table", answers.product_table, "hits_product_table")
_table_check("x8_discount_table", answers.discount_table, "hits_discount_table")


def _digest_sql(source: str, title: str, text: str = "chunk_text") -> str:
    return f"""SELECT query_id, {title} || coalesce(body, '') AS result FROM label_questions LEFT JOIN
  (SELECT query_id, string_agg({text}, {_NL} || {_NL} || '---' || {_NL} || {_NL} ORDER BY rank)
     AS body FROM {source} WHERE length({text}) > 0 GROUP BY query_id) USING (query_id)"""


def _digest_check(key, ask, sql):
    @check(key, sql)
    def _(spark, sf):
        return _answered(ask, spark, sf).select("query_id", "result")


_digest_check(
    "t11_source_digest",
    answers.source_digest,
    _digest_sql(
        "hits_digest",
        "''",
        f"('Source: ' || file_name || ' (' || doc_type || ')' || {_NL} || coalesce(chunk_text, ''))",
    ),
)
_digest_check(
    "t11_product_documents",
    answers.product_documents,
    _digest_sql(
        "hits_product_documents",
        f"'Product documentation for ''' || product_keyword || ''':' || {_NL} || {_NL}",
    ),
)
_digest_check(
    "t11_relevant_documents",
    answers.relevant_documents,
    _digest_sql("hits_search", f"'Relevant product documentation:' || {_NL} || {_NL}"),
)
_digest_check(
    "t11_relevant_documents_by_type",
    answers.relevant_documents_by_type,
    _digest_sql(
        "hits_typed",
        "'Relevant ' || CASE WHEN doc_type = 'product_spec' THEN 'product specification'"
        f" ELSE 'discount policy' END || ' documentation:' || {_NL} || {_NL}",
    ),
)
_digest_check(
    "t11_discount_documents",
    answers.discount_documents,
    _digest_sql(
        "hits_discount",
        "'Discount policy for ' || category_name || ' in ' || region_name || ' region:'"
        f" || {_NL} || {_NL}",
    ),
)


# --- refresh -----------------------------------------------------------------------------------


def _refreshed(spark, sf):
    """What the source holds now, and an index fed by two streams.

    The first stream delivers the vectors of even labels, then higher versions of those that changed,
    then deletions; the second, with a checkpoint of its own, the vectors of odd labels.
    """
    rows = adapters.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("chunk_id"),
        "label",
        F.lit(1).alias("version"),
        F.lit(False).alias("deleted"),
        "embedding",
    )
    changed = F.element_at("embedding", 1) > 0
    gone = F.col("chunk_id") % 7 == 0
    even, odd = rows.where("label % 2 = 0"), rows.where("label % 2 = 1")
    second = even.where(changed).withColumn("version", F.lit(2))
    third = even.where(gone).withColumn("version", F.lit(3)).withColumn("deleted", F.lit(True))
    index = scratch_path(spark, "index")
    for deliveries in ([even, second, third], [odd]):
        source, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "progress")
        for delivery in deliveries:
            delivery.write.mode("append").parquet(source)
            refresh_index(spark, source, index, checkpoint, rows.schema)
        refresh_index(spark, source, index, checkpoint, rows.schema)
    now = rows.withColumn("version", F.when(changed & (F.col("label") % 2 == 0), 2).otherwise(1))
    return now.where(~(gone & (F.col("label") % 2 == 0))), index


_EXPECTED_INDEX = """SELECT vec_id AS chunk_id, label,
  CASE WHEN embedding[1] > 0 AND label % 2 = 0 THEN 2 ELSE 1 END AS version
FROM embeddings WHERE NOT (vec_id % 7 = 0 AND label % 2 = 0)"""


@check("r1_incremental_refresh", _EXPECTED_INDEX)
def _(spark, sf):
    now, index = _refreshed(spark, sf)
    return current_index(spark, index, now.schema).select("chunk_id", "label", "version")


@check("r1_compacted", _EXPECTED_INDEX)
def _(spark, sf):
    now, index = _refreshed(spark, sf)
    compact_index(spark, index, now.schema)
    return current_index(spark, index, now.schema).select("chunk_id", "label", "version")


@check(
    "r2_freshness",
    f"""SELECT count(*) AS source_rows, count(*) AS indexed_rows, 0 AS missing_rows,
  0 AS stale_rows, 0 AS extra_rows, 0 AS lag FROM ({_EXPECTED_INDEX})""",
)
def _(spark, sf):
    now, index = _refreshed(spark, sf)
    return freshness(now, current_index(spark, index, now.schema))


@check(
    "r2_freshness_behind",
    f"""SELECT count(*) AS source_rows, (SELECT count(*) FROM ({_EXPECTED_INDEX})) AS indexed_rows,
  count(*) FILTER (WHERE gone) AS missing_rows, count(*) FILTER (WHERE NOT gone AND newer)
  AS stale_rows, 0 AS extra_rows, count(*) FILTER (WHERE gone OR newer) AS lag FROM
  (SELECT vec_id % 7 = 0 AND label % 2 = 0 AS gone, embedding[1] > 0 AND label % 2 = 0 AS newer
   FROM embeddings)""",
)
def _(spark, sf):
    # the source as it was first delivered: what was deleted is missing, what changed is at another version
    now, index = _refreshed(spark, sf)
    first = adapters.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.lit(1).alias("version")
    )
    return freshness(first, current_index(spark, index, now.schema))


def _overwritten(spark, sf):
    """The vectors as a table that is overwritten twice, and the feed and index that follow it.

    The second state lacks every seventh row, has other labels on some and holds new ones; the third brings some of the lost ones back.
    """
    first = adapters.table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label", "embedding")
    second = first.where("chunk_id % 7 <> 0").withColumn(
        "label", F.when(F.element_at("embedding", 1) > 0, F.col("label") + 100).otherwise(F.col("label"))
    )
    added = first.where("chunk_id % 11 = 0").withColumn("chunk_id", F.col("chunk_id") + 1_000_000)
    second = second.unionByName(added)
    third = second.unionByName(first.where("chunk_id % 21 = 0"))
    source, state, index, checkpoint = (scratch_path(spark, p) for p in ("feed", "state", "index", "progress"))
    for table in (first, second, third, third):
        changes.deliver_changes(table, source, state)
        refresh_index(spark, source, index, checkpoint, changes.feed_schema(table))
    return first, second, third, source, index


_LABEL_NOW = "CASE WHEN embedding[1] > 0 THEN label + 100 ELSE label END"


@check(
    "r1_change_feed",
    f"""SELECT version, deleted, vec_id AS chunk_id, label FROM (
  SELECT 1 AS version, false AS deleted, vec_id, label FROM embeddings
  UNION ALL SELECT 2, true, vec_id, NULL FROM embeddings WHERE vec_id % 7 = 0
  UNION ALL SELECT 2, false, vec_id, label + 100 FROM embeddings WHERE vec_id % 7 <> 0 AND embedding[1] > 0
  UNION ALL SELECT 2, false, vec_id + 1000000, label FROM embeddings WHERE vec_id % 11 = 0
  UNION ALL SELECT 3, false, vec_id, label FROM embeddings WHERE vec_id % 21 = 0)""",
)
def _(spark, sf):
    first, _, _, source, _ = _overwritten(spark, sf)
    return spark.read.schema(changes.feed_schema(first)).parquet(source).select("version", "deleted", "chunk_id", "label")


@check(
    "r1_change_feed_index",
    f"""SELECT vec_id AS chunk_id, {_LABEL_NOW} AS label FROM embeddings WHERE vec_id % 7 <> 0
UNION ALL SELECT vec_id + 1000000, label FROM embeddings WHERE vec_id % 11 = 0
UNION ALL SELECT vec_id, label FROM embeddings WHERE vec_id % 21 = 0""",
)
def _(spark, sf):
    first, _, _, _, index = _overwritten(spark, sf)
    return current_index(spark, index, changes.feed_schema(first)).select("chunk_id", "label")


@check(
    "r1_snapshot_changes",
    f"""SELECT change, count(*) AS n, sum(vec_id) AS ids FROM (
  SELECT CASE WHEN vec_id % 7 = 0 THEN 'delete' ELSE 'update' END AS change, vec_id FROM embeddings
  WHERE vec_id % 7 = 0 OR embedding[1] > 0
  UNION ALL SELECT 'insert', vec_id + 1000000 FROM embeddings WHERE vec_id % 11 = 0) GROUP BY ALL""",
)
def _(spark, sf):
    first, second, *_ = _overwritten(spark, sf)
    found = changes.snapshot_changes(first, second, "chunk_id")
    return found.groupBy("change").agg(F.count("*").alias("n"), F.sum("chunk_id").alias("ids"))
