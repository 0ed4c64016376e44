"""Data audits: keys, orphans, fan-out, vector sizes and accepted values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, (F.col(key).isNull() for key in keys))


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: each with its row count and whether a part is NULL."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("is_null", _any_null(keys))
        .where((F.col("n") > 1) | F.col("is_null"))
    )


def key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How a declared key holds: rows, distinct keys, keys of several rows and keys with a NULL part."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("key_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.count_if(_any_null(keys)).alias("null_keys"),
    )


def orphan_audit(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]
) -> DataFrame:
    """Left keys without a right row, with their row counts.

    Both sides shrink to one row per key before they meet, so a hot key is one row.
    """
    left_keys = [a for a, _ in keys]
    used = left.groupBy(*left_keys).agg(F.count(F.lit(1)).alias("n"))
    known = right.select(*(F.col(b).alias(f"_{b}") for _, b in keys)).distinct()
    condition = reduce(Column.__and__, (F.col(a) == F.col(f"_{b}") for a, b in keys))
    return used.join(known, condition, "left_anti")


def matched_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]
) -> DataFrame:
    """Left keys that meet right rows, with the number ``n`` of those rows."""
    used = left.select(*(a for a, _ in keys)).distinct()
    per_key = right.groupBy(*(F.col(b).alias(f"_{b}") for _, b in keys)).agg(
        F.count(F.lit(1)).alias("n")
    )
    condition = reduce(Column.__and__, (F.col(a) == F.col(f"_{b}") for a, b in keys))
    return used.join(per_key, condition)


def fanout_audit(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]
) -> DataFrame:
    """Largest number of right rows that one left key meets, and how many keys meet several."""
    return matched_keys(left, right, keys).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("max_matches"),
        F.count_if(F.col("n") > 1).alias("keys_with_several"),
    )


def embedding_audit(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Row count by vector length; a missing vector has length NULL."""
    size = F.when(F.col(vector).isNotNull(), F.size(vector))
    return df.groupBy(size.alias("dim")).agg(F.count(F.lit(1)).alias("n"))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted list, with their row counts; NULL is not judged."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
