"""A change feed for tables that are overwritten: each snapshot is compared with the one before, and the differences become a delivery.

What is kept of a snapshot is a key and a 128-bit hash of each row, in ``<state>/snapshot=<n>``. The differences are written into the folder that
``refresh.refresh_index`` reads as a stream, so the index follows a table that knows no history of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tallyloom.session import park

INSERT, UPDATE, DELETE = "insert", "update", "delete"
_SNAPSHOT, _BEGUN = "snapshot", "begun"


def _plain(df: DataFrame, name: str) -> Column:
    """A column as something whose hash tells nulls and empty values apart, also within arrays and structs."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, MapType):
        column, kind = F.array_sort(F.map_entries(column)), ArrayType(StructType())
    if isinstance(kind, (ArrayType, StructType, VariantType)):
        return F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
    return column


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """(one, two): a 128-bit hash of the columns. NULL differs from every value, and a value in one column from the same in the next."""
    parts = [p for c in columns for p in (F.col(c).isNull(), _plain(df, c))]
    return F.struct(F.xxhash64(F.lit(0), *parts).alias("one"), F.xxhash64(F.lit(1), *parts).alias("two"))


def snapshot_rows(table: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(_key, _hash, _row): a row for each key; of rows that share a key, that of the highest hash. A NULL key is a key.

    ``columns`` are those whose change counts, all but the key if none are given. Combined before the shuffle.
    """
    watched = list(columns) if columns is not None else [c for c in table.columns if c != key]
    row = F.struct(row_hash(table, watched).alias("h"), row_hash(table, table.columns).alias("all"), F.struct(*table.columns).alias("r"))
    picked = F.max_by(row, F.struct(row["h"], row["all"]))
    return table.groupBy(F.col(key).alias("_key")).agg(picked.alias("_p")).select("_key", F.col("_p.h").alias("_hash"), F.col("_p.r").alias("_row"))


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(change, the columns of ``after``): rows that came, rows whose watched columns differ, and rows that went.

    ``before`` is a table like ``after``, or what ``snapshot_rows`` or the state folder kept of one: _key and _hash. Rows that went hold their key
    alone, other columns are NULL. One shuffle by key; equal rows end there.
    """
    old = before.select("_key", "_hash") if "_hash" in before.columns else snapshot_rows(before, key, columns).select("_key", "_hash")
    return _changes(old, snapshot_rows(after, key, columns), after.schema, key).drop("_key", "_hash")


def _changes(old: DataFrame, new: DataFrame, schema: StructType, key: str) -> DataFrame:
    sides = old.withColumnRenamed("_hash", "_old").unionByName(new.withColumnRenamed("_hash", "_new"), allowMissingColumns=True)
    # One row a key and side at most, so the first that is not null is the only one.
    one = lambda name: F.first(name, ignorenulls=True).alias(name)
    met = sides.groupBy("_key").agg(one("_old"), one("_new"), one("_row"))
    kind = (
        F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNull(), DELETE).when(F.col("_old") != F.col("_new"), UPDATE)
    )
    columns = [F.coalesce(F.col("_row")[c], F.col("_key")).alias(c) if c == key else F.col("_row")[c].alias(c) for c in schema.names]
    return met.withColumn("change", kind).where("change is not null").select("change", "_key", F.col("_new").alias("_hash"), *columns)


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, state_dir: str) -> tuple[list[int], list[int]]:
    """(numbers of the complete snapshots, numbers of all deliveries that were begun), ascending."""
    path, files = _files(spark, state_dir)
    if not files.exists(path(state_dir)):
        return [], []
    names = [s.getPath().getName().partition("=") for s in files.listStatus(path(state_dir))]
    taken = sorted(int(n) for kind, _, n in names if kind == _SNAPSHOT and files.exists(path(f"{state_dir}/{_SNAPSHOT}={n}/_SUCCESS")))
    return taken, sorted(int(n) for kind, _, n in names if kind == _BEGUN)


def last_snapshot(spark: SparkSession, state_dir: str) -> int:
    """Number of the last snapshot that was taken in, 0 if none was."""
    return max(_numbers(spark, state_dir)[0], default=0)


def deliver_changes(
    table: DataFrame, source_dir: str, state_dir: str, key: str = "chunk_id", version: str = "version", columns: Sequence[str] | None = None,
) -> int:
    """Compare ``table`` with the last snapshot and append what changed to ``source_dir``; returns the new snapshot's number.

    A delivered row has the table's columns, the snapshot's number as ``version`` and a ``deleted`` mark. The table must have neither column; a
    table without any change delivers no rows. The delivery is written before the state. After a stop in between the next call
    delivers the same changes, or newer ones, under a higher number, as each number is marked as begun first; an index of latest versions takes both.
    Older states than the last two are removed. One writer at a time.
    """
    clash = {version, "deleted"} & set(table.columns)
    if clash:
        raise ValueError(f"the table has columns that the feed adds: {sorted(clash)}")
    spark = table.sparkSession
    taken, begun = _numbers(spark, state_dir)
    number = max([*taken, *begun], default=0) + 1
    path, files = _files(spark, state_dir)
    files.mkdirs(path(f"{state_dir}/{_BEGUN}={number}"))
    new = snapshot_rows(table, key, columns)
    if taken:
        old = spark.read.parquet(f"{state_dir}/{_SNAPSHOT}={taken[-1]}")
    else:
        old = new.select("_key", "_hash").limit(0)
    # The next state is the old one with the changes worked in, so it cannot differ from what was delivered, even if the table is overwritten meanwhile.
    changes = park(_changes(old, new, table.schema, key), "changes")
    delivery = changes.select(*table.columns, F.lit(number).cast("long").alias(version), (F.col("change") == DELETE).alias("deleted"))
    if changes.head(1):
        delivery.write.mode("append").parquet(source_dir)
    same = F.col("_key").eqNullSafe(F.col("_changed"))
    kept = old.join(changes.select(F.col("_key").alias("_changed")), same, "left_anti")
    state = kept.unionByName(changes.where(F.col("change") != DELETE).select("_key", "_hash"))
    state.write.mode("overwrite").parquet(f"{state_dir}/{_SNAPSHOT}={number}")
    for passed in [f"{_SNAPSHOT}={n}" for n in taken[:-1]] + [f"{_BEGUN}={n}" for n in begun]:
        files.delete(path(f"{state_dir}/{passed}"), True)
    return number


def feed_schema(table: DataFrame, version: str = "version") -> StructType:
    """The schema of what ``deliver_changes`` delivers, as the stream and the index need it."""
    return StructType(list(table.schema.fields)).add(version, "long").add("deleted", "boolean")
