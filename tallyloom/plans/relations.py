"""Audits over every relationship of the metric layer at once, each table read once for each side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.metrics import RELATIONSHIPS, Tables
from tallyloom.sources.files import rows

_PARTS = [f"_k{i}" for i in range(max(len(edge.keys) for edge in RELATIONSHIPS.values()))]


def _keys_by_edge(tables: Tables, side: int) -> DataFrame:
    """(edge, key parts, n): the rows of each key on one side of each edge.

    A row yields one key for every edge that its table takes part in. Keys of fewer parts are filled up with blanks; a NULL part
    stays NULL and so meets nothing.
    """
    found = []
    for table in sorted({(edge.left, edge.right)[side] for edge in RELATIONSHIPS.values()}):
        keys = [
            F.struct(
                F.lit(name).alias("edge"),
                *(
                    (F.col(edge.keys[i][side]).cast("string") if i < len(edge.keys) else F.lit("")).alias(part)
                    for i, part in enumerate(_PARTS)
                ),
            )
            for name, edge in RELATIONSHIPS.items()
            if (edge.left, edge.right)[side] == table
        ]
        found.append(tables[table].select(F.explode(F.array(*keys)).alias("key")).select("key.*"))
    return reduce(DataFrame.unionByName, found).groupBy("edge", *_PARTS).agg(F.count(F.lit(1)).alias("n"))


def _for_every_edge(found: DataFrame) -> DataFrame:
    """One row for each edge; an edge without any finding has zeros."""
    names = rows(found.sparkSession, [(name,) for name in RELATIONSHIPS], "edge string")
    return names.join(found, "edge", "left").na.fill(0)


def orphans_by_edge(tables: Tables) -> DataFrame:
    """For every edge the left keys without a right row, and their rows."""
    orphans = _keys_by_edge(tables, 0).join(_keys_by_edge(tables, 1).select("edge", *_PARTS), ["edge", *_PARTS], "left_anti")
    return _for_every_edge(
        orphans.groupBy("edge").agg(F.count(F.lit(1)).alias("orphan_keys"), F.sum("n").alias("orphan_rows"))
    )


def fanout_by_edge(tables: Tables) -> DataFrame:
    """For every edge the most right rows that one left key meets, and how many keys meet several."""
    met = _keys_by_edge(tables, 0).select("edge", *_PARTS).join(_keys_by_edge(tables, 1), ["edge", *_PARTS])
    return _for_every_edge(
        met.groupBy("edge").agg(F.max("n").alias("max_matches"), F.count_if(F.col("n") > 1).alias("keys_with_several"))
    )
