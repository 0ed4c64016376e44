"""Text embedding, exact and cell-indexed nearest chunks, and hit lists."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tallyloom.functions.wordlists import QUESTION_PREFIXES
from tallyloom.operators.text import HIT_COLUMNS
from tallyloom.session import park

EMBEDDING_DIM = 1024
DEFAULT_K = 5
# A tile of questions and a tile of chunks hold about so many; each tile meets every tile of chunks.
QUESTIONS_PER_TILE = 8192
CHUNKS_PER_TILE = 8192
# Within a tile so many questions are compared at once, and so many pairs are scored in double precision.
QUESTIONS_AT_ONCE = 256
PAIRS_AT_ONCE = 16_384
# Similarities are compared at this many decimals; equal ones are ordered by id.
SCORE_DECIMALS = 6
# A task remembers the buckets of at most so many words.
REMEMBERED_WORDS = 200_000
# The cell index: cells, and how many of the nearest are looked into. Nearly isotropic vectors need
# three quarters of the cells for nine in ten of the true hits; clustered ones need fewer.
CELLS = 32
PROBED_CELLS = 24

_WORD = regex.compile(r"[\p{L}\p{N}]+")
# What is no part of a word becomes a space: ASCII texts are cut several times faster so.
_ASCII_WORDS = {c: chr(c) if _WORD.fullmatch(chr(c)) else " " for c in range(128)}


@dataclass(frozen=True)
class TermModel:
    """Weights by rarity of hashed terms: ``idf[b]`` for the terms whose md5 falls into bucket ``b``."""

    dim: int
    idf: tuple[float, ...]


class _Buckets(dict):
    """The bucket of a word: the first 32 bits of its md5, modulo ``dim``; a word is hashed once while it is remembered."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        bucket = self[word] = int.from_bytes(hashlib.md5(word.encode()).digest()[:4]) % self.dim
        return bucket

    def of_text(self, text: str) -> list[int]:
        lowered = text.lower()
        words = lowered.translate(_ASCII_WORDS).split() if lowered.isascii() else _WORD.findall(lowered)
        return list(map(self.__getitem__, words))


def fit_embedder(df: DataFrame, text: str, dim: int = EMBEDDING_DIM) -> TermModel:
    """Count in how many texts each bucket occurs; ``dim`` counts come to the driver."""

    def seen(batches):
        counts, rows, buckets = np.zeros(dim, dtype=np.int64), 0, _Buckets(dim)
        for batch in batches:
            for value in batch.column(0):
                counts[list(set(buckets.of_text(value.as_py() or "")))] += 1
                rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(dim), dim]), pa.array([*counts.tolist(), rows], pa.int64())], ["bucket", "n"]
        )

    parts = df.select(F.col(text).cast("string").alias("text")).mapInArrow(seen, "bucket long, n long")
    totals = {r["bucket"]: r["n"] for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    rows = totals.get(dim, 0)
    return TermModel(dim, tuple(math.log((rows + 1) / (totals.get(b, 0) + 1)) for b in range(dim)))


def embed(df: DataFrame, text: str, model: TermModel, out: str = "embedding") -> DataFrame:
    """Add the text's vector as ``array<float>``: term counts times rarity, at unit length.

    NULL or blank text has an empty vector, a text without weighted words the zero vector.
    """
    dim, idf = model.dim, np.array(model.idf)

    def vector(value: str, buckets: _Buckets) -> np.ndarray:
        weights = np.bincount(np.array(buckets.of_text(value), dtype=np.int64), minlength=dim) * idf
        norm = math.sqrt(weights @ weights)
        return (weights / norm if norm else weights).astype(np.float32)

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # One text at a time leaves Arrow's memory, and its vector goes straight into the batch's.
        buckets = _Buckets(dim)
        for texts in batches:
            ends, at = np.zeros(len(texts) + 1, dtype=np.int32), 0
            flat = np.empty((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                value = text.as_py()
                if value is not None and value.strip():
                    flat[at] = vector(value, buckets)
                    at += 1
                ends[row + 1] = at * dim
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[:at].reshape(-1)))

    return df.withColumn(out, vectors(F.col(text).cast("string")))


def expand_query(kind: str, *arguments: Column) -> Column:
    """The text embedded for a question: a fixed prefix, then the arguments."""
    return F.concat(F.lit(QUESTION_PREFIXES[kind]), *arguments)


def _wanted(column: Column) -> Column:
    """The document type asked for; NULL, empty and "all" ask for any."""
    return F.when(column.isNull() | (column == "") | (F.lower(column) == "all"), None).otherwise(column)


def _asked(questions: DataFrame, k: int | None) -> DataFrame:
    """query_id, qvec, wanted, top_k: a question's own ``top_k`` counts before ``k``; NULL or 0 means five."""
    kinds = dict(questions.dtypes)
    wanted = _wanted(F.col("doc_filter")) if "doc_filter" in kinds else F.lit(None)
    own = F.nullif(F.col("top_k"), F.lit(0)) if "top_k" in kinds else F.lit(None)
    return questions.select(
        "query_id",
        F.col("qvec").cast("array<double>").alias("qvec"),
        wanted.cast("string").alias("wanted"),
        F.coalesce(own, F.lit(k or DEFAULT_K)).cast("int").alias("top_k"),
    )


def _unit_matrix(column: pa.ChunkedArray, rows: np.ndarray, dim: int) -> np.ndarray:
    flat = column.take(pa.array(rows)).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = np.asarray(flat, dtype=float).reshape(len(rows), dim)
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def _widths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)


def _best_of_block(asked: np.ndarray, vectors: np.ndarray, single: np.ndarray, top_k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, vector, score) of the ``top_k`` best of some vectors for each of some questions; all are of unit length and finite.

    Single precision rules out what stays below the k-th score by more than its error and the rounding; the others are scored in double.
    """
    rough = asked.astype(np.float32) @ single.T
    most = int(top_k.max(initial=0))
    if most < 1:
        rows = columns = np.zeros(0, dtype=np.int64)
    elif most < len(vectors):
        error = (vectors.shape[1] + 8) * 2.0**-23
        floor = np.partition(rough, len(vectors) - most, axis=1)[:, len(vectors) - most]
        rows, columns = np.nonzero(rough >= (floor - np.float32(2 * error + 2 * 10.0**-SCORE_DECIMALS))[:, None])
    else:
        rows, columns = (x.ravel() for x in np.indices(rough.shape))
    scores = np.zeros(len(rows))
    for at in range(0, len(rows), PAIRS_AT_ONCE):
        some = slice(at, at + PAIRS_AT_ONCE)
        scores[some] = np.einsum("ij,ij->i", asked[rows[some]], vectors[columns[some]])
    scores = np.round(scores, SCORE_DECIMALS)
    order = np.lexsort((columns, -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < top_k[rows]
    return rows[kept], columns[kept], scores[kept]


def _best_pairs(asked: pa.Table, chunks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question row, chunk row, score) of the best chunks in a tile, by vector length; ties by chunk id."""
    place = pc.sort_indices(chunks, sort_keys=[("chunk_id", "ascending")]).to_numpy().astype(np.int64)
    asked_widths, widths = _widths(asked.column("qvec")), _widths(chunks.column("embedding"))[place]
    types = np.array(chunks.column("doc_type").to_pylist(), dtype=object)[place]
    wanted = np.array(asked.column("wanted").to_pylist(), dtype=object)
    top_k = asked.column("top_k").to_numpy().astype(np.int64)
    none = np.zeros(0, dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(none, none, np.zeros(0))]
    for dim in np.unique(asked_widths[asked_widths > 0]).tolist():
        ours, theirs = np.flatnonzero(asked_widths == dim), np.flatnonzero(widths == dim)
        if not len(theirs):
            continue
        vectors, questions = _unit_matrix(chunks.column("embedding"), place[theirs], dim), _unit_matrix(asked.column("qvec"), ours, dim)
        usable, asks = np.isfinite(vectors).all(axis=1), np.isfinite(questions).all(axis=1)
        theirs, vectors, ours, questions = theirs[usable], vectors[usable], ours[asks], questions[asks]
        for kind in {*wanted[ours].tolist()}:
            fits = slice(None) if kind is None else types[theirs] == kind
            mine = np.flatnonzero([w == kind for w in wanted[ours].tolist()])
            fitting = vectors[fits]
            single = fitting.astype(np.float32)
            for at in range(0, len(mine), QUESTIONS_AT_ONCE) if len(fitting) else ():
                some = mine[at : at + QUESTIONS_AT_ONCE]
                rows, columns, scores = _best_of_block(questions[some], fitting, single, top_k[ours[some]])
                found.append((ours[some][rows], place[theirs[fits][columns]], scores))
    return tuple(np.concatenate(part) for part in zip(*found))


def _ranked(found: DataFrame) -> DataFrame:
    """The ``top_k`` best of each question's (chunk_id, score), with their rank."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= F.col("top_k"))


def similarity_topk_batch(emb: DataFrame, questions: DataFrame, k: int | None = DEFAULT_K) -> DataFrame:
    """The most similar chunks of every question, by cosine, ties by chunk id.

    ``questions`` holds ``query_id`` and ``qvec``, and optionally ``doc_filter``, a document type
    applied before ranking, and ``top_k``. Ids may be of any type. Tiles of chunks meet tiles of
    questions, each dealt by a hash of its ids, and send back at most ``top_k`` ids per question. A question meets only vectors of
    its own length; empty vectors and vectors of length zero are never hits and have none.
    """
    spark = emb.sparkSession
    asked = _asked(questions, k)
    asked_tiles = asked.count() // QUESTIONS_PER_TILE + 1
    tiles = max(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // asked_tiles), emb.count() // CHUNKS_PER_TILE + 1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    hashed = lambda c, n: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(n)).cast("int")
    left = asked.withColumn("q_tile", hashed("query_id", asked_tiles)).withColumn("c_tile", every(tiles))
    right = (
        emb.select("chunk_id", "doc_type", "embedding")
        .withColumn("of_chunks", hashed("chunk_id", tiles))
        .withColumn("of_questions", every(asked_tiles))
    )

    def search(key, asked_rows, chunk_rows):
        q, c, scores = _best_pairs(asked_rows, chunk_rows)
        return pa.table(
            [asked_rows.column("query_id").take(pa.array(q)), asked_rows.column("top_k").take(pa.array(q)),
             chunk_rows.column("chunk_id").take(pa.array(c)), pa.array(scores, pa.float64())],
            names=["query_id", "top_k", "chunk_id", "score"],
        )

    schema = StructType(
        [asked.schema["query_id"], asked.schema["top_k"], emb.schema["chunk_id"], StructField("score", DoubleType())]
    )
    found = left.groupBy("q_tile", "c_tile").cogroup(right.groupBy("of_questions", "of_chunks")).applyInArrow(search, schema)
    kept = [c for c in emb.columns if c != "embedding"]
    hits = _ranked(found).select("query_id", "rank", "score", F.col("chunk_id").alias("hit_id"))
    texts = emb.select(*(F.col(c).alias(c) for c in kept))
    return texts.join(hits, F.col("chunk_id") == F.col("hit_id")).select("query_id", "rank", "score", *kept)


def similarity_topk(
    emb: DataFrame, qvec: Sequence[float], k: int | None = DEFAULT_K, doc_type: str | None = None
) -> DataFrame:
    """The most similar chunks of one vector; ``k`` of NULL or zero means five."""
    schema = "query_id int, qvec array<double>, doc_filter string"
    row = [(0, [float(x) for x in qvec], doc_type)]
    asked = emb.sparkSession.createDataFrame(row, schema)
    return similarity_topk_batch(emb, asked, k).drop("query_id")


@dataclass(frozen=True)
class CellIndex:
    """Chunks stored once each, in the folder of their nearest cell, and what is known of the cells.

    ``rows`` is the stored table with columns ``cell`` and ``_lot``, a number of the row; ``centers`` the cells' vectors, ``sizes`` the
    number of chunks by cell and type: both are bounded by the number of cells.
    """

    rows: DataFrame
    dim: int
    centers: tuple[tuple[float, ...], ...]
    sizes: DataFrame
    probed: int


def _nearest_cells(matrix: np.ndarray, centers: np.ndarray, most: int) -> np.ndarray:
    """Cells by falling cosine at six decimals, ties to the lower cell."""
    with np.errstate(invalid="ignore", divide="ignore"):
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    scores = np.round(unit @ (centers / np.linalg.norm(centers, axis=1, keepdims=True)).T, SCORE_DECIMALS)
    return np.argsort(-scores, axis=1, kind="stable")[:, :most]


def cell_index(emb: DataFrame, dim: int, cells: int = CELLS, probed: int = PROBED_CELLS, path: str | None = None) -> CellIndex:
    """Lay the chunks out by their nearest cell; the ``cells`` chunks of smallest id give the cells their vectors.

    Chunks of another vector length and of length zero are left out: they are never hits. Eager: the vectors are stored at ``path``,
    or in the scratch folder.
    """
    usable = (F.size("embedding") == dim) & F.exists("embedding", lambda x: x != 0)
    known = emb.where(F.coalesce(usable, F.lit(False)))
    first = known.select("chunk_id", "embedding").orderBy("chunk_id").limit(cells).collect()
    centers = np.array([r["embedding"] for r in first], dtype=float).reshape(len(first), dim)

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        if not len(vectors) or not len(centers):
            return pd.Series([0] * len(vectors), dtype="int32")
        return pd.Series(_nearest_cells(np.stack(vectors.to_list()).astype(float), centers, 1)[:, 0].astype("int32"))

    placed = known.withColumn("cell", nearest("embedding")).repartitionByRange("cell", "chunk_id")
    placed = placed.withColumn("_lot", F.monotonically_increasing_id())
    if path is None:
        rows = park(placed, "cells")
    else:
        placed.write.mode("overwrite").partitionBy("cell").parquet(path)
        rows = emb.sparkSession.read.schema(placed.schema).parquet(path)
    sizes = park(rows.groupBy("cell", "doc_type").agg(F.count("*").alias("n")), "cell-sizes")
    return CellIndex(rows, dim, tuple(map(tuple, centers.tolist())), sizes, probed)


def search_cells(index: CellIndex, questions: DataFrame, k: int | None = DEFAULT_K) -> DataFrame:
    """The most similar chunks within the cells nearest to each question, with all chunk columns; ties by chunk id.

    The ``index.probed`` nearest cells are looked into, and further ones until those together hold ``top_k`` chunks of the type asked
    for; these are ranked by exact cosine. A question without a usable vector of the index's length has no hits.
    """
    centers = np.array(index.centers, dtype=float).reshape(len(index.centers), index.dim)

    @F.pandas_udf("array<int>")
    def order(vectors: pd.Series) -> pd.Series:
        if not len(vectors) or not len(centers):
            return pd.Series([[] for _ in range(len(vectors))])
        return pd.Series(list(_nearest_cells(np.stack(vectors.to_list()).astype(float), centers, len(centers))))

    usable = (F.size("qvec") == index.dim) & F.exists("qvec", lambda x: x != 0)
    asked = _asked(questions, k).where(F.coalesce(usable, F.lit(False)))
    cells = asked.select("*", F.posexplode(order("qvec")).alias("place", "probe"))
    held = cells.join(F.broadcast(index.sizes.withColumnRenamed("doc_type", "held_type")), F.col("probe") == F.col("cell"), "left").groupBy(
        "query_id", "place", "probe"
    ).agg(
        F.sum(F.when(F.col("wanted").isNull() | (F.col("wanted") == F.col("held_type")), F.col("n")).otherwise(0)).alias("n"),
        F.any_value("top_k").alias("top_k"), F.any_value("qvec").alias("qvec"), F.any_value("wanted").alias("wanted"),
    )
    before = Window.partitionBy("query_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    probes = held.withColumn("so_far", F.coalesce(F.sum("n").over(before), F.lit(0))).where(
        (F.col("place") < index.probed) | (F.col("so_far") < F.col("top_k"))
    )
    # one row for each cell, and a frame for each side
    parts = (F.sum("n") / CHUNKS_PER_TILE).cast("int")
    ours, theirs = (F.broadcast(index.sizes.groupBy("cell").agg(parts.alias(name))) for name in ("parts", "lots"))
    asked_tiles = asked.count() // QUESTIONS_PER_TILE + 1
    every = lambda n: F.explode(F.sequence(F.lit(0), n))
    hashed = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    left = (
        probes.select("query_id", "top_k", "wanted", "qvec", F.col("probe").alias("cell"))
        .join(ours, "cell")
        .withColumn("q_tile", hashed(F.col("query_id").cast("string"), F.lit(asked_tiles)))
        .withColumn("part", every(F.col("parts")))
    )
    right = (
        index.rows.select("cell", "_lot", "chunk_id", "doc_type", "embedding")
        .join(theirs, "cell")
        .withColumn("part", hashed(F.col("_lot"), F.col("lots") + 1))
        .withColumn("q_tile", every(F.lit(asked_tiles - 1)))
    )

    def search(key, asked_rows, chunk_rows):
        q, c, scores = _best_pairs(asked_rows, chunk_rows)
        q, c = pa.array(q), pa.array(c)
        return pa.table(
            [asked_rows.column("query_id").take(q), asked_rows.column("top_k").take(q), chunk_rows.column("chunk_id").take(c),
             chunk_rows.column("_lot").take(c), pa.array(scores, pa.float64())],
            names=["query_id", "top_k", "chunk_id", "lot", "score"],
        )

    schema = StructType([
        asked.schema["query_id"], asked.schema["top_k"], index.rows.schema["chunk_id"], StructField("lot", LongType()),
        StructField("score", DoubleType()),
    ])
    key = ("cell", "part", "q_tile")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, schema)
    hits = _ranked(found).select("query_id", "rank", "score", "lot")
    kept = [c for c in index.rows.columns if c not in ("embedding", "cell", "_lot")]
    texts = index.rows.select(*kept, "_lot")
    return texts.join(hits, F.col("_lot") == F.col("lot")).select("query_id", "rank", "score", *kept)


def nearest_chunks(corpus, questions: DataFrame, k: int | None = DEFAULT_K) -> DataFrame:
    """Exact search over a frame of vectors, or search over an index of them: a ``CellIndex`` or ``cells.TrainedCells``."""
    if isinstance(corpus, DataFrame):
        return similarity_topk_batch(corpus, questions, k)
    return search_cells(corpus, questions, k) if isinstance(corpus, CellIndex) else corpus.search(questions, k)


_HIT_SCHEMA = "array<struct<" + ",".join(f"{c}:string" for c in HIT_COLUMNS) + ">>"


def hits_to_json(hits: DataFrame) -> DataFrame:
    """Each question's hits, best first, as one JSON array; a question has at most k hits."""
    hit = F.struct(*(F.col(c).cast("string").alias(c) for c in HIT_COLUMNS))
    ranked = F.array_sort(F.collect_list(F.struct("rank", hit.alias("hit"))))
    as_json = F.to_json(F.transform(ranked, lambda r: r["hit"]), {"ignoreNullFields": "false"})
    return hits.groupBy("query_id").agg(as_json.alias("raw_json"))


def json_to_hits(lists: DataFrame, column: str = "raw_json") -> DataFrame:
    """One row per hit of each JSON array."""
    others = [c for c in lists.columns if c != column]
    return lists.select(*others, F.explode(F.from_json(column, _HIT_SCHEMA)).alias("_hit")).select(
        *others, "_hit.*"
    )
