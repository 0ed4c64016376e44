"""Keeping a searchable table in step with growing source folders.

The index is a folder of deliveries: ``_stream=<stream id>/_batch_id=<number>``. A stream's id lives in its checkpoint, so
batches of several streams never share a folder, and a batch repeated after a failure replaces its own.
A row with a true ``deleted`` column takes its key out of the index; a row of a higher version replaces the one before.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

STREAM, BATCH = "_stream", "_batch_id"


def refresh_index(
    spark: SparkSession,
    source_dir: str,
    index_dir: str,
    checkpoint_dir: str,
    schema: StructType,
    max_files_per_trigger: int = 1000,
) -> None:
    """Read the files that arrived since the last run and add their rows to the index.

    Runs until the source is used up, then stops. One checkpoint belongs to one source; further
    sources feed the same index through checkpoints of their own.
    """
    known, stream_id = threading.Event(), []

    def append(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        folder = f"{index_dir}/{STREAM}={stream_id[0]}/{BATCH}={batch_id}"
        batch.write.mode("overwrite").parquet(folder)

    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )
    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    stream_id.append(query.id)  # kept in the checkpoint, the same after a restart
    known.set()
    query.awaitTermination()


def indexed_versions(spark: SparkSession, index_dir: str, schema: StructType) -> DataFrame:
    """Every version that is stored, with the stream and batch that brought it."""
    places = [StructField(STREAM, StringType()), StructField(BATCH, LongType())]
    return spark.read.schema(StructType([*schema.fields, *places])).parquet(index_dir)


def _latest(rows: DataFrame, schema: StructType, key: str, version: str) -> DataFrame:
    """One row for each key, of the highest version; among equal ones the later batch, then a hash of the row, decides.

    One pass over the rows; the maximum is combined before the shuffle, so a key sent very often costs a row per task.
    """
    order = F.struct(version, BATCH, STREAM, F.xxhash64(*schema.names))
    best = F.max_by(F.struct(*schema.names), order).alias("_latest")
    return rows.groupBy(F.col(key).alias("_key")).agg(best).select("_latest.*")


def _alive(schema: StructType) -> Column:
    return ~F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in schema.names else F.lit(True)


def current_index(
    spark: SparkSession,
    index_dir: str,
    schema: StructType,
    key: str = "chunk_id",
    version: str = "version",
) -> DataFrame:
    """The latest version of each key, without keys whose latest version is a deletion."""
    return _latest(indexed_versions(spark, index_dir, schema), schema, key, version).where(_alive(schema))


def compact_index(
    spark: SparkSession,
    index_dir: str,
    schema: StructType,
    key: str = "chunk_id",
    version: str = "version",
) -> None:
    """Replace all stored deliveries by one that holds the latest version of each key, deletions included.

    The new delivery is complete before the old ones go. A stop in between leaves rows twice, which
    ``current_index`` does not show, and batches that arrive meanwhile are not touched. Deletions stay stored, so that an older
    version arriving late does not bring its key back. Not to be run while a stream repeats a failed batch.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(index_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [batch.getPath() for stream in files.listStatus(path(index_dir)) for batch in files.listStatus(stream.getPath())]
    folders = [p.toString() for p in old]
    rows = indexed_versions(spark, index_dir, schema)
    if not folders:
        return
    # only the listed deliveries: one that arrives now must not be read, for it will not be deleted
    listed = spark.read.schema(rows.schema).option("basePath", index_dir).parquet(*folders)
    latest = _latest(listed, schema, key, version)
    latest.write.parquet(f"{index_dir}/{STREAM}=compacted-{uuid.uuid4().hex}/{BATCH}=0")
    for folder in old:
        files.delete(folder, True)


def freshness(
    source: DataFrame, index: DataFrame, key: str = "chunk_id", version: str = "version"
) -> DataFrame:
    """How the current index stands against the source, both with one row for each key.

    source_rows, indexed_rows, ``missing_rows`` (keys that are absent from the index), ``stale_rows`` (indexed at
    another version), ``extra_rows`` (indexed, but gone from the source) and their sum, ``lag``.
    """
    sides = [
        df.select(F.col(key).alias("key"), F.col(version).alias(name), F.lit(True).alias(f"in_{name}"))
        for df, name in ((source, "source"), (index, "index"))
    ]
    both = sides[0].join(sides[1], "key", "full")
    counted = lambda condition, name: F.coalesce(F.sum(condition.cast("long")), F.lit(0)).alias(name)
    there, held = F.col("in_source").isNotNull(), F.col("in_index").isNotNull()
    return both.agg(
        counted(there, "source_rows"),
        counted(held, "indexed_rows"),
        counted(there & ~held, "missing_rows"),
        counted(there & held & ~F.col("source").eqNullSafe(F.col("index")), "stale_rows"),
        counted(held & ~there, "extra_rows"),
    ).withColumn("lag", F.col("missing_rows") + F.col("stale_rows") + F.col("extra_rows"))
