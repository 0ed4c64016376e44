"""DuckDB SQL for the queries whose results SQL can express, by plain joins and counts over the whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORD = r"[^\x20\x09-\x0D]+"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _components(nodes: str, links: str) -> str:
    """CTEs that end in ``component(id, component_id)``, from ``nodes(id)`` and ``links(a, b)`` in both directions."""
    return f"""
reach(id, seen) AS (
  SELECT id, id FROM {nodes}
  UNION
  SELECT reach.id, links.b FROM reach JOIN {links} AS links ON links.a = reach.seen
),
component AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)"""


def top_k_sql(k: int = 5, every: int = 50) -> str:
    """Each ``every``-th row's ``k`` highest integer inner products, ties to smaller ids."""
    return f"""
WITH coded AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM coded q JOIN coded c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % {every} = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= {k}"""


def near_embeddings_sql(least: float = 0.93) -> str:
    """Links of equal label and cosine of at least ``least``, and what they connect."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
), whole AS (
  SELECT * FROM v WHERE len(e) > 0 AND list_inner_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM whole x JOIN whole y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_inner_product(x.e, y.e) / sqrt(list_inner_product(x.e, x.e) * list_inner_product(y.e, y.e)) >= {least}
), nodes AS (SELECT vec_id AS id FROM embeddings),{_components("nodes", "links")}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON component.id = vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id"""


def ngram_jaccard_sql(words: int = 4, percent: int = 85) -> str:
    """Shingle sets met on their shingles; links by exact set sizes, and what they connect."""
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes n ON n.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, m.n, n.n HAVING 100 * count(*) >= {percent} * (m.n + n.n - count(*))
), nodes AS (SELECT doc_id AS id FROM documents),{_components("nodes", "links")}
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN component ON component.id = documents.doc_id LEFT JOIN sizes ON sizes.doc_id = documents.doc_id"""


def collocations_sql(least: int = 30, within_percent: int = 80, top: int = 2000) -> str:
    """All phrases of one to four words counted, then candidates, cuts and the first of each language."""
    return rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM pieces, range(1, 5) AS sizes(k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase
), candidates AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= {least}
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:k], ' ') AS rest
  FROM candidates, range(1, 4) AS places(cut) WHERE cut < k
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.n AS l, y.n AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.n + y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, range(2, 4) AS sizes(size), range(1, 4) AS places(i) WHERE size < k AND i + size - 1 <= k
  GROUP BY ALL
), kept AS (
  SELECT scored.* FROM scored LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {within_percent} * a
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang)
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= {top}"""


def substring_dedup_sql(window: int = 35) -> str:
    """Every window of words counted; words under a repeated one go."""
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(w) - {window - 2})) AS i,
    unnest(list_transform(range(1, len(w) - {window - 2}), lambda i: array_to_string(w[i:i + {window - 1}], ' '))) AS s
  FROM split WHERE len(w) >= {window}
), repeated AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {window})) AS i FROM repeated
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM split) ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)"""
