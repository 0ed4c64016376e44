"""Nearest chunks over trained cells: two levels of sampled k-means, a folder for each cell, only folders of probed cells read."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tallyloom.operators.vectors import DEFAULT_K, SCORE_DECIMALS, _asked, _best_pairs, _ranked
from tallyloom.session import park

# The cells are fitted on so many rows, those of smallest id hash; every row is then put into a cell.
SAMPLE_ROWS = 16_384
COARSE, FINE = 16, 16
# Centers are held by the driver and by each task.
MOST_CELLS = 4096
PROBED = 32
ROUNDS = 12
# A tile of chunks or questions holds about so many, and no more than fit these bytes as doubles.
TILE_ROWS, TILE_BYTES = 4096, 32 << 20
# Scores are compared rounded, so a cell is passed over only if it stays below the last hit by more than this.
_MARGIN = 2 * 10.0**-SCORE_DECIMALS
_ADDED = ("embedding", "cell", "near", "lot")


def _unit(vectors: pd.Series | list, dim: int) -> np.ndarray:
    matrix = np.asarray(list(vectors), dtype=float).reshape(len(vectors), dim)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _usable(column: str, dim: int):
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(column) == dim) & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``k`` unit centers; fewer if the points are fewer."""
    chosen = [0]
    best = points @ points[0]
    while len(chosen) < k:
        far = np.where(best < 1 - 1e-9, 1 - best, 0.0)
        if not far.any():
            break
        chosen.append(int(rng.choice(len(points), p=far / far.sum())))
        best = np.maximum(best, points @ points[chosen[-1]])
    centers = points[chosen].copy()
    for _ in range(ROUNDS):
        owner = np.argmax(points @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, points)
        norms = np.linalg.norm(sums, axis=1)
        moved = norms > 1e-9
        centers[moved] = sums[moved] / norms[moved, None]
    return centers


def _train(points: np.ndarray, coarse: int, fine: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centers of the first level, centers of the second, and the first-level cell that each of those lies in."""
    rng = np.random.default_rng(0)
    if not len(points):
        return points, points, np.zeros(0, dtype=int)
    first = _k_means(points, coarse, rng)
    owner = np.argmax(points @ first.T, axis=1)
    # a first-level cell without sampled rows keeps its own center, so that every row finds a cell
    second = [_k_means(points[owner == g], fine, rng) if (owner == g).any() else first[g : g + 1] for g in range(len(first))]
    return first, np.concatenate(second), np.repeat(np.arange(len(first)), [len(s) for s in second])


def _place(unit: np.ndarray, first: np.ndarray, second: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's cell, the nearest within its nearest first-level cell, and its cosine with that cell's center."""
    cell, near = np.zeros(len(unit), dtype=np.int32), np.zeros(len(unit))
    owner = np.argmax(np.round(unit @ first.T, SCORE_DECIMALS), axis=1)
    for g in np.unique(owner):
        rows, cells = np.flatnonzero(owner == g), np.flatnonzero(within == g)
        scores = unit[rows] @ second[cells].T
        best = np.argmax(np.round(scores, SCORE_DECIMALS), axis=1)
        cell[rows], near[rows] = cells[best], scores[np.arange(len(rows)), best]
    return cell, near


@dataclass(frozen=True)
class TrainedCells:
    """Chunks stored once each in the folder of their cell, with the cells' centers, sizes and reaches.

    ``reach`` is the lowest cosine of a cell's chunks with its center. ``held`` counts the chunks by cell and type. Centers, sizes and
    reaches have an entry for each of at most MOST_CELLS cells.
    """

    rows: DataFrame
    held: DataFrame
    centers: np.ndarray = field(repr=False)
    sizes: np.ndarray = field(repr=False)
    reach: np.ndarray = field(repr=False)

    @property
    def dim(self) -> int:
        return self.centers.shape[1]

    def _tile(self) -> int:
        return max(1, min(TILE_ROWS, TILE_BYTES // (8 * max(1, self.dim))))

    def _with_sizes(self, questions: DataFrame, k: int | None) -> DataFrame:
        """The usable questions, with the cells that hold the type asked for, and how many chunks of it."""
        asked = _asked(questions, k).where(_usable("qvec", self.dim))
        by_type = self.held.where("doc_type is not null").groupBy("doc_type").agg(F.collect_list(F.struct("cell", "n")).alias("of_type"))
        joined = asked.join(by_type, F.col("wanted") == F.col("doc_type"), "left")
        return joined.withColumn("of_cells", F.col("of_type.cell")).withColumn("of_sizes", F.col("of_type.n")).drop("doc_type", "of_type")

    def choose(self, questions: DataFrame, k: int | None = DEFAULT_K, probed: int = PROBED) -> DataFrame:
        """The questions with ``cells``: the ``probed`` nearest, and further ones until they hold ``top_k`` chunks of the type asked for.

        Cells without such chunks are left out. ``rows_read`` counts the chunks in those cells, of any type.
        """
        dim, centers, sizes = self.dim, self.centers, self.sizes

        @F.pandas_udf("cells array<int>, rows_read long")
        def nearest(vectors: pd.Series, tops: pd.Series, wanted: pd.Series, of_cells: pd.Series, of_sizes: pd.Series) -> pd.DataFrame:
            out = []
            places = np.argsort(-np.round(_unit(vectors, dim) @ centers.T, SCORE_DECIMALS), axis=1, kind="stable")
            for place, top, kind, cells, counts in zip(places, tops, wanted, of_cells, of_sizes):
                fitting = sizes if kind is None else _sizes_of(len(centers), cells, counts)
                place = place[fitting[place] > 0]
                before = np.cumsum(fitting[place]) - fitting[place]
                place = place[(np.arange(len(place)) < probed) | (before < top)]
                out.append((place.astype(np.int32), int(sizes[place].sum())))
            return pd.DataFrame(out, columns=["cells", "rows_read"])

        chosen = nearest("qvec", "top_k", "wanted", "of_cells", "of_sizes")
        return self._with_sizes(questions, k).withColumn("chosen", chosen).select("*", "chosen.*").drop("chosen")

    def _within_reach(self, first: DataFrame, found: DataFrame) -> DataFrame:
        """The questions with the cells not yet looked into that can hold a chunk as good as the last hit so far."""
        dim, centers, sizes = self.dim, self.centers, self.sizes
        angles = np.arccos(np.clip(self.reach, -1, 1))

        @F.pandas_udf("array<int>")
        def others(
            vectors: pd.Series, last: pd.Series, done: pd.Series, wanted: pd.Series, of_cells: pd.Series, of_sizes: pd.Series
        ) -> pd.Series:
            turns = np.arccos(np.clip(_unit(vectors, dim) @ centers.T, -1, 1))
            bounds = np.cos(np.maximum(0, turns - angles))
            out = []
            for bound, floor, cells, kind, typed, counts in zip(bounds, last, done, wanted, of_cells, of_sizes):
                fitting = sizes if kind is None else _sizes_of(len(centers), typed, counts)
                open_cells = (fitting > 0) & (pd.isna(floor) | (bound >= floor - _MARGIN))
                open_cells[np.asarray(cells, dtype=int)] = False
                out.append(np.flatnonzero(open_cells).astype(np.int32))
            return pd.Series(out)

        full = found.groupBy("query_id").agg(
            F.when(F.count("*") >= F.any_value("top_k"), F.min("score")).alias("last")
        ).withColumnRenamed("query_id", "found_id")
        known = first.join(full, F.col("query_id") == F.col("found_id"), "left")
        return known.withColumn("cells", others("qvec", "last", "cells", "wanted", "of_cells", "of_sizes")).drop("found_id", "last")

    def _meet(self, chosen: DataFrame) -> DataFrame:
        """The ``top_k`` best chunks of every question in each tile of its cells.

        A cell's chunks are dealt into tiles by a number of their own, its questions by a hash of their id, so neither a large cell nor
        repeated ids make a tile larger.
        """
        spark, tile = chosen.sparkSession, self._tile()
        asked = chosen.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()
        cells = [r["cell"] for r in asked]
        tiles = [(r["cell"], -(-int(self.sizes[r["cell"]]) // tile), -(-r["count"] // tile)) for r in asked]
        # a row for each cell, and a frame for each side
        ours, theirs = (F.broadcast(spark.createDataFrame(tiles, "cell int, parts int, q_tiles int")) for _ in range(2))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        hashed = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        left = (
            chosen.select("query_id", "top_k", "wanted", "qvec", F.explode("cells").alias("cell"))
            .join(ours, "cell")
            .withColumn("q_tile", hashed(F.col("query_id").cast("string"), "q_tiles"))
            .withColumn("part", every("parts"))
        )
        right = (
            self.rows.where(F.col("cell").isin(cells))
            .select("cell", "lot", "chunk_id", "doc_type", "embedding")
            .join(theirs, "cell")
            .withColumn("part", hashed(F.col("lot"), "parts"))
            .withColumn("q_tile", every("q_tiles"))
        )

        def search(key, asked_rows, chunk_rows):
            q, c, scores = _best_pairs(asked_rows, chunk_rows)
            q, c = pa.array(q), pa.array(c)
            return pa.table(
                [asked_rows.column("query_id").take(q), asked_rows.column("top_k").take(q), chunk_rows.column("cell").take(c),
                 chunk_rows.column("lot").take(c), chunk_rows.column("chunk_id").take(c), pa.array(scores, pa.float64())],
                names=["query_id", "top_k", "cell", "lot", "chunk_id", "score"],
            )

        schema = StructType([
            chosen.schema["query_id"], chosen.schema["top_k"], StructField("cell", IntegerType()), StructField("lot", LongType()),
            self.rows.schema["chunk_id"], StructField("score", DoubleType()),
        ])
        key = ("cell", "part", "q_tile")
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, schema)

    def search(self, questions: DataFrame, k: int | None = DEFAULT_K, probed: int = PROBED, exact: bool = False) -> DataFrame:
        """The most similar chunks of every question, by cosine, ties by chunk id, with all chunk columns.

        ``questions`` are as for ``similarity_topk_batch``, their ids unique. Looked into are the cells of ``choose``. With ``exact`` the
        score of the last hit there is then held against what each other cell can reach at most, from the angle between question and
        center less the cell's widest angle, and the cells that it does not rule out are looked into as well; the hits are those of
        comparing all chunks. Questions without a usable vector of the index's length have no hits. Eager: the choice and the
        first hits are parked.
        """
        first = park(self.choose(questions, k, probed), "probes")
        found = self._meet(first)
        if exact:
            found = park(_ranked(found).drop("rank"), "first-hits")
            found = found.unionByName(self._meet(park(self._within_reach(first, found), "probes")))
        hits = park(_ranked(found), "hits").select("query_id", "rank", "score", F.col("cell").alias("hit_cell"), F.col("lot").alias("hit_lot"))
        cells = [r["hit_cell"] for r in hits.select("hit_cell").distinct().collect()]
        kept = [c for c in self.rows.columns if c not in _ADDED]
        texts = self.rows.where(F.col("cell").isin(cells)).select(*kept, "cell", "lot")
        fits = (F.col("cell") == F.col("hit_cell")) & (F.col("lot") == F.col("hit_lot"))
        return texts.join(hits, fits).select("query_id", "rank", "score", *kept)


def _sizes_of(cells: int, numbers: np.ndarray | None, counts: np.ndarray | None) -> np.ndarray:
    sizes = np.zeros(cells, dtype=np.int64)
    if numbers is not None:
        sizes[np.asarray(numbers, dtype=int)] = counts
    return sizes


def train_cells(emb: DataFrame, dim: int, path: str, coarse: int = COARSE, fine: int = FINE) -> TrainedCells:
    """Fit at most ``coarse`` times ``fine`` cells on SAMPLE_ROWS rows and store every chunk in its cell's folder below ``path``.

    What lies at ``path`` is overwritten. Chunks of another vector length, with components that are null or not finite, or of length zero
    are left out: they are never hits. Columns ``cell``, ``near`` and ``lot`` are the index's own; such columns of ``emb`` are not kept.
    """
    if not 1 <= coarse * fine <= MOST_CELLS:
        raise ValueError(f"between 1 and {MOST_CELLS} cells, not {coarse * fine}")
    spark = emb.sparkSession
    known = emb.drop("cell", "near", "lot").where(_usable("embedding", dim))
    by_hash = (F.xxhash64(F.col("chunk_id").cast("string")), F.col("chunk_id"), F.xxhash64("embedding"))
    sample = known.orderBy(*by_hash).limit(SAMPLE_ROWS).select("embedding").collect()
    first, second, within = _train(_unit([r["embedding"] for r in sample], dim), coarse, fine)

    @F.pandas_udf("cell int, near double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        if not len(first):  # no row was there to be sampled
            return pd.DataFrame({"cell": np.zeros(len(vectors), dtype=np.int32), "near": np.zeros(len(vectors))})
        cell, near = _place(_unit(vectors, dim), first, second, within)
        return pd.DataFrame({"cell": cell, "near": near})

    # parked, so that a row's cell and number stay what they are when a task of the shuffle below is repeated
    placed = known.withColumn("placed", place("embedding")).select("*", "placed.*", F.monotonically_increasing_id().alias("lot"))
    placed = park(placed.drop("placed"), "placed")
    placed.repartitionByRange("cell", "lot").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    placed.groupBy("cell", "doc_type").agg(F.count("*").alias("n"), F.min("near").alias("reach")).write.mode("overwrite").parquet(
        f"{path}/held"
    )
    centers = [(i, center.tolist()) for i, center in enumerate(second)]
    # the schema of the rows goes with the centers: a table without rows has no folder to read it from
    spark.createDataFrame([(dim, placed.schema.json(), centers)], "dim int, rows string, centers array<struct<cell:int,center:array<double>>>").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}/centers")
    return open_cells(spark, path)


def open_cells(spark: SparkSession, path: str) -> TrainedCells:
    """The index that ``train_cells`` stored at ``path``."""
    about = spark.read.parquet(f"{path}/centers").first()
    schema = StructType.fromJson(json.loads(about["rows"]))
    count = len(about["centers"])
    centers = np.array([c["center"] for c in about["centers"]], dtype=float).reshape(count, about["dim"])
    held = spark.read.parquet(f"{path}/held")
    sizes, reach = np.zeros(count, dtype=np.int64), np.ones(count)
    for row in held.groupBy("cell").agg(F.sum("n").alias("n"), F.min("reach").alias("reach")).collect():
        sizes[row["cell"]], reach[row["cell"]] = row["n"], row["reach"]
    return TrainedCells(spark.read.schema(schema).parquet(f"{path}/rows"), held, centers, sizes, reach)
