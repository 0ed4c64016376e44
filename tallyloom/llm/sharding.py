"""Balanced shards by vector bin packing: bytes, tokens and rows at once, equal texts together.

Placing is sequential, so what is placed must stay few: groups (equal texts) that hold more than a small part of the whole are
placed one by one, all others as bundles of groups with neighbouring hashes. Both numbers are bounded by parameters,
not by the corpus. A group beyond a shard's fair part of bytes or rows is first split into equal chunks by document.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import park

BUNDLES = 16384
HEAVY_PART = 1 / 4096
SLOT_BUCKET_ROWS = 100_000
DIMENSIONS = ("bytes", "tokens", "rows")


def place_vectors(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each vector: largest first, always where the dot product with the residual capacity is highest.

    Each dimension counts as a part of its own total, so the capacities are equal. The first dimension is the law: among the
    shards that still have room for it the product decides; where none has, the one with the most room takes it. Ties go to the
    lowest shard.
    """
    totals = np.maximum(vectors.sum(axis=0, dtype=np.float64), 1)
    parts = vectors / totals
    residual = np.full((shards, vectors.shape[1]), 1 / shards)
    out = np.empty(len(vectors), dtype=np.int64)
    for i in np.argsort(-parts.max(axis=1), kind="stable"):
        fits = residual[:, 0] >= parts[i, 0]
        merit = np.where(fits, residual @ parts[i], -np.inf) if fits.any() else residual[:, 0]
        out[i] = at = int(np.argmax(merit))
        residual[at] -= parts[i]
    return out


def _sums(size: str = "size", tokens: str = "tokens") -> list[Column]:
    return [F.sum(size).alias("bytes"), F.sum(tokens).alias("tokens"), F.count("*").alias("rows")]


def shard_documents(docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text",
                    bundles: int = BUNDLES, heavy_part: float = HEAVY_PART) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law ``bytes``.

    Sizes are UTF-8 bytes of the text plus 1; tokens are runs without white space. Null texts count as empty
    and form one group with empty ones. Null and repeated ids are rows like others. An empty table gives no rows. Eager: one
    pass over the texts stores a digest of each row; at most ``bundles`` + 3 / ``heavy_part`` vectors come to the driver.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    digest = park(
        docs.select(
            F.col(id_column).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.md5(F.encode(text, "UTF-8")).alias("grp"),
        ).withColumn("bundle", F.pmod(F.xxhash64("grp"), F.lit(bundles)).cast("int")),
        "digests",
    )
    groups = park(digest.groupBy("grp", "bundle").agg(*_sums()), "groups")
    totals = [max(1, v or 0) for v in groups.agg(*(F.sum(d) for d in DIMENSIONS)).first()]
    is_heavy = F.lit(False)
    for dimension, total in zip(DIMENSIONS, totals):
        is_heavy = is_heavy | (F.col(dimension) > F.lit(total * heavy_part))
    heavy = groups.where(is_heavy).select("grp", *DIMENSIONS).collect()
    chunks_of = lambda r: max(1, math.ceil(shards * max(r["bytes"] / totals[0], r["rows"] / totals[2])))
    spark = docs.sparkSession
    splits = spark.createDataFrame([(r["grp"], chunks_of(r)) for r in heavy], "grp string, chunks int")
    cut = digest.join(F.broadcast(splits), "grp", "left").withColumn(
        "chunk", F.when(F.col("chunks") > 1, F.pmod(F.xxhash64("id", "size"), F.col("chunks")).cast("int")).otherwise(F.when(F.col("chunks") == 1, 0))
    )
    unit = [F.when(F.col("chunk").isNotNull(), F.col("grp")).alias("heavy"), "chunk", F.when(F.col("chunk").isNull(), F.col("bundle")).alias("light")]
    units = cut.select("*", unit[0], unit[2]).groupBy("heavy", "chunk", "light").agg(*_sums()).collect()
    units.sort(key=lambda r: (r["heavy"] or "", -1 if r["chunk"] is None else r["chunk"], -1 if r["light"] is None else r["light"]))
    vectors = np.array([[r[d] for d in DIMENSIONS] for r in units], dtype=np.float64).reshape(-1, 3)
    placed = place_vectors(vectors, shards).tolist() if units else []
    to_heavy = spark.createDataFrame([(r["heavy"], r["chunk"], s) for r, s in zip(units, placed) if r["heavy"] is not None], "grp string, chunk int, own_shard int")
    to_light = spark.createDataFrame([(r["light"], s) for r, s in zip(units, placed) if r["heavy"] is None], "bundle int, bundle_shard int")
    rows = (
        cut.join(F.broadcast(to_heavy), ["grp", "chunk"], "left")
        .join(F.broadcast(to_light), "bundle", "left")
        .select("id", "size", "text_crc32", F.coalesce("own_shard", "bundle_shard").alias("shard"))
    )
    return (
        _with_slots(rows, max(1, totals[2] // SLOT_BUCKET_ROWS // shards + 1))
        .select(
            F.col("id").alias(id_column), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _with_slots(rows: DataFrame, buckets: int) -> DataFrame:
    """``slot`` counts each shard's rows from 0 without gaps: by bucket, and within a bucket by id."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "size", "text_crc32"), F.lit(buckets)))
    within = Window.partitionBy("shard", "bucket").orderBy("id", "size", "text_crc32")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return (
        rows.withColumn("rank", F.row_number().over(within))
        .join(starts, ["shard", "bucket"])
        .withColumn("slot", (F.col("first") + F.col("rank") - 1).cast("long"))
    )
