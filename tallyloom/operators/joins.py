"""Equi-join shapes used by the marts and the metric layer.

No hint is given anywhere: a dimension is broadcast only when Spark's size estimate is below
``spark.sql.autoBroadcastJoinThreshold`` (or AQE measures it so), and a hot key in a shuffled
join is split by AQE's skew-join rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Fact to dimension on shared key names; facts without a dimension row are dropped."""
    return fact.join(dim, on=keys, how="inner")


def join_optional(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Fact to an optional parent; the parent's columns are NULL when there is none."""
    return fact.join(dim, on=keys, how="left")


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL keys match each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    condition = reduce(
        Column.__and__, (F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys)
    )
    return left.join(renamed, condition, how).drop(*(f"__{key}" for key in keys))


def with_total(df: DataFrame, source: DataFrame, total: Column, name: str) -> DataFrame:
    """Attach a grand total computed from ``source`` to every row of ``df``.

    The total is an uncorrelated scalar subquery, run once, so no join takes place.
    """
    return df.withColumn(name, source.agg(total.alias(name)).scalar())


def join_aggregates(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_aggs: Sequence[Column],
    right_aggs: Sequence[Column],
) -> DataFrame:
    """Aggregate two facts to one grain each, then join; keys on one side only are dropped."""
    return left.groupBy(*keys).agg(*left_aggs).join(
        right.groupBy(*keys).agg(*right_aggs), on=list(keys), how="inner"
    )


def territory(fact: DataFrame, clinic_map: DataFrame) -> DataFrame:
    """Spread zip-level facts over the clinics serving each zip.

    A zip served by several clinics counts for each of them; unassigned zips are left out.
    The fact's own state column gives way to the map's.
    """
    assigned = clinic_map.where(F.col("clinic_name").isNotNull())
    return fact.drop("state_code").join(
        assigned.select("zip_code", "clinic_name", "state_code"), on="zip_code"
    )
