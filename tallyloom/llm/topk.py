"""Exact k highest inner products by block-at-a-time pruning.

Rows are ordered so that neighbours look alike (by the signs of a few projections, then by id) and cut into blocks.
A block keeps its rows as a matrix, its forward index, and per component the largest and smallest value. For a query the sum
over components of the larger product bounds every score in the block. Each query visits the blocks of a tile by falling
bound and stops when the bound falls below its k-th score so far; its own block gives it a first such score. Only exact integer scores decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.arrow_rows import by_width, finite_vector, matrix
from tallyloom.session import park

BLOCK_ROWS = 256
TILE_ROWS = 8192
SIGN_BITS = 12
_NONE = -(1 << 62)


def quantize(vectors: DataFrame, id_column: str, vector_column: str, scale: float = 256.0) -> DataFrame:
    """(id, v array<long>): floor(scale * component); rows with a null id or an unusable vector are left out."""
    floor = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    return vectors.where(finite_vector(vector_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.transform(vector_column, floor).alias("v")
    )


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through doubles where these hold every sum."""
    most = [int(np.abs(m).max(initial=0)) for m in (queries, rows)]
    if most[0] * most[1] * max(1, rows.shape[1]) < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def best(values: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, ties to the smaller id."""
    order = np.lexsort((ids, -values), axis=-1)[:, :k]
    return np.take_along_axis(values, order, 1), np.take_along_axis(ids, order, 1)


class Block:
    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.high, self.low = rows.max(axis=0), rows.min(axis=0)


def search_tile(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, blocks: list[Block], k: int):
    """(values, ids), k columns each, of every query over the blocks; unused places hold the value ``_NONE``."""
    values = np.full((len(queries), k), _NONE, dtype=np.int64)
    ids = np.full((len(queries), k), np.iinfo(np.int64).max, dtype=np.int64)
    high, low = np.stack([b.high for b in blocks]), np.stack([b.low for b in blocks])
    bounds = scores(np.maximum(queries, 0), high) + scores(np.minimum(queries, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    alive = np.arange(len(queries))
    for place in range(len(blocks)):
        block = order[alive, place]
        alive_too = bounds[alive, block] >= np.maximum(floors[alive], values[alive, -1])
        alive, block = alive[alive_too], block[alive_too]
        if not len(alive):
            break
        for b in np.unique(block):
            who = alive[block == b]
            found = scores(queries[who], blocks[b].rows)
            own = blocks[b].ids[None, :] == query_ids[who, None]
            found[own] = _NONE
            there = np.where(own, np.iinfo(np.int64).max, blocks[b].ids[None, :])
            values[who], ids[who] = best(np.hstack([values[who], found]), np.hstack([ids[who], there]), k)
    return values, ids


def _number(*parts: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(p, dtype="<i8").tobytes() for p in parts)


def _blocks(quantized: DataFrame, block_rows: int, tile_rows: int, partitions: int) -> DataFrame:
    """(tile, dim, n, ids, v), a row for each block, stored; a tile is a run of blocks of one vector length."""
    def code(batches):
        for batch in batches:
            signs = np.zeros(batch.num_rows, dtype=np.int64)
            for width, rows in by_width(batch.column(1)):
                planes = np.random.default_rng(width).standard_normal((width, SIGN_BITS))
                signs[rows] = ((matrix(batch.column(1), rows, width, np.float64) @ planes) > 0) @ (1 << np.arange(SIGN_BITS))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs)], ["id", "v", "code"])

    def cut(batches):
        task, tile, in_tile, width, ids, rows, held = TaskContext.get().partitionId(), 0, 0, None, [], [], 0

        def record():
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{task}.{tile}"]), pa.array([width], pa.int32()), pa.array([held], pa.int32()),
                 pa.array([_number(*ids)], pa.binary()), pa.array([_number(*rows)], pa.binary())],
                ["tile", "dim", "n", "ids", "v"],
            )

        for batch in batches:
            here = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            for new_width, at in by_width(batch.column(1)):  # rows come by width; within one their order stays
                values = matrix(batch.column(1), at, new_width, np.int64)
                start = 0
                while start < len(at):
                    if held and (width != new_width or held >= block_rows):
                        yield record()
                        in_tile += held
                        ids, rows, held = [], [], 0
                    if in_tile and (width != new_width or in_tile >= tile_rows):
                        tile, in_tile = tile + 1, 0
                    width = new_width
                    stop = min(len(at), start + block_rows - held)
                    ids.append(here[at[start:stop]])
                    rows.append(values[start:stop])
                    held += stop - start
                    start = stop
        if held:
            yield record()

    coded = quantized.mapInArrow(code, "id long, v array<long>, code long").withColumn("dim", F.size("v"))
    ordered = coded.repartitionByRange(partitions, "dim", "code", "id").sortWithinPartitions("dim", "code", "id").select("id", "v")
    return park(ordered.mapInArrow(cut, "tile string, dim int, n int, ids binary, v binary"), "blocks")


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["v"], "<i8").reshape(row["n"], row["dim"])


def _queries(blocks: DataFrame, query_step: int, k: int, tile_rows: int) -> DataFrame:
    """(query_tile, dim, n, ids, v, floors), stored: the rows whose id ``query_step`` divides.

    A query's floor is its k-th score within its own block.
    """
    def pick(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, rows = _unpack(row)
                who = np.flatnonzero(ids % query_step == 0)
                if len(who):
                    found = scores(rows[who], rows)
                    found[ids[who][:, None] == ids[None, :]] = _NONE
                    floors = np.sort(found, axis=1)[:, -k] if found.shape[1] >= k else np.full(len(who), _NONE)
                    out.append((row["dim"], ids[who], rows[who], floors))
            for dim in sorted({o[0] for o in out}):
                own = [o for o in out if o[0] == dim]
                ids, rows, floors = (np.concatenate([o[i] for o in own]) for i in (1, 2, 3))
                for at in range(0, len(ids), tile_rows):
                    cut = slice(at, at + tile_rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{task}.{number}"]), pa.array([dim], pa.int32()), pa.array([len(ids[cut])], pa.int32()),
                         *(pa.array([_number(x[cut])], pa.binary()) for x in (ids, rows, floors))],
                        ["query_tile", "dim", "n", "ids", "v", "floors"],
                    )
                    number += 1

    return park(blocks.select("dim", "n", "ids", "v").mapInArrow(pick, "query_tile string, dim int, n int, ids binary, v binary, floors binary"), "queries")


def top_k(vectors: DataFrame, k: int = 5, query_step: int = 50, id_column: str = "vec_id", vector_column: str = "embedding",
          scale: float = 256.0, block_rows: int = BLOCK_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, ties to the smaller id.

    Queries are the rows whose id ``query_step`` divides; candidates are the rows with another id and a vector of the same
    length. Fewer candidates than k: all. Null ids, null vectors and vectors with null or non-finite components take no part;
    repeated rows are candidates each. Every tile of rows meets every tile of queries, both of bounded size. Eager: blocks and queries are stored.
    """
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(quantize(vectors, id_column, vector_column, scale), block_rows, tile_rows, partitions)
    queries = _queries(blocks, query_step, k, tile_rows)

    def search(key, query_table, block_table):
        asked = query_table.to_pylist()
        ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in asked])
        rows = np.concatenate([_unpack(r)[1] for r in asked])
        floors = np.concatenate([np.frombuffer(r["floors"], "<i8") for r in asked])
        values, found = search_tile(ids, rows, floors, [Block(*_unpack(r)) for r in block_table.to_pylist()], k)
        real = values.ravel() > _NONE
        columns = [np.repeat(ids, k)[real], found.ravel()[real], values.ravel()[real]]
        return pa.table(dict(zip(["query_id", "vec_id", "score"], columns)))

    meetings = queries.select("query_tile", "dim").join(blocks.select("tile", "dim").distinct(), "dim")
    side = lambda s: meetings.select(F.col("tile").alias(f"{s}_tile"), F.col("query_tile").alias(f"{s}_query"))
    asked = queries.join(side("a"), F.col("query_tile") == F.col("a_query")).groupBy("a_tile", "a_query")
    held = blocks.join(side("b"), F.col("tile") == F.col("b_tile")).groupBy("b_tile", "b_query")
    found = asked.cogroup(held).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
