"""Reading and writing tables, views and delimited files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OFFSET_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSS Z"


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header row and quoted fields; the schema is given, never inferred.

    Quotes inside quoted fields are doubled. Files are split for reading, so a record may not
    span lines.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def overwrite_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace a table and its schema by ``df``. With ``path`` the table lives there.

    ``df`` may not read the table it replaces.
    """
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def rewrite_table(
    spark: SparkSession, name: str, change: Callable[[DataFrame], DataFrame], path: str
) -> DataFrame:
    """Store ``change`` of a table under the table's own name.

    The rows are written to ``path``, a new folder, while the table still reads its old one; then the table is pointed there.
    A stop before that leaves the table as it was. The schema must stay the same. The old folder stays for readers that
    began before; its place is the caller's to clear.
    """
    before = spark.table(name)
    changed = change(before)
    if changed.schema != before.schema:
        raise ValueError(f"{name} would change its schema")
    changed.write.parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def create_table_as(
    spark: SparkSession, name: str, query: str | DataFrame, path: str | None = None
) -> DataFrame:
    """Create or replace a table from a query text or a frame."""
    df = spark.sql(query) if isinstance(query, str) else query
    return overwrite_table(df, name, path)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view; it is evaluated anew each time it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def rows(spark: SparkSession, values: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A small frame from literal rows."""
    return spark.createDataFrame(list(values), schema)


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows; with ``order`` the same rows each time."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def ingest_dimension(
    df: DataFrame,
    rename: Mapping[str, str],
    keys: Sequence[str],
    created_at: str | None = "created_at",
    two_letter_state: str | None = None,
) -> DataFrame:
    """Reference rows as a dimension: renamed, offset timestamps parsed, one row per key.

    Among rows of one key the latest one stays, and among those the least by its columns.
    ``two_letter_state`` names a column that must hold a two-letter code, which drops
    rows that are not places.
    """
    dim = df.withColumnsRenamed(dict(rename))
    if created_at is not None:
        dim = dim.withColumn(created_at, F.try_to_timestamp(created_at, F.lit(OFFSET_TIMESTAMP)))
    if two_letter_state is not None:
        dim = dim.where(F.length(two_letter_state) == 2)
    others = [c for c in dim.columns if c not in keys and c != created_at]
    latest = [F.col(created_at).desc_nulls_last()] if created_at is not None else []
    order = [*latest, *others] or list(keys)
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return (
        dim.withColumn("_nth", F.row_number().over(newest_first)).where("_nth = 1").drop("_nth")
    )
