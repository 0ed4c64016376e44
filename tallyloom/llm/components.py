"""Connected components of a graph given as rows of edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import park


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another; component is the smallest node of it.

    Each round points every node at the neighbour (or itself) whose hash is least and contracts along
    the pointers. Hashes make the order random, so the graph shrinks by a factor a round, for
    chains as for stars. Only counts come to the driver. Eager: a round writes its tables to the shared folder. Nulls, loops and
    repeated edges are ignored; no edges: no rows.
    """
    left = park(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    labels = None
    while left.head(1):
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        pointers = park(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(order("b")).alias("near"))
            .select("node", F.least(order("node"), F.col("near"))["n"].alias("to")),
            "pointers",
        )
        if labels is None:
            labels = pointers.withColumnRenamed("to", "label")
        else:
            labels = park(
                labels.join(pointers, F.col("label") == pointers["node"], "left").select(
                    labels["node"], F.coalesce("to", "label").alias("label")
                ),
                "labels",
            )
        onto = lambda c: pointers.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        left = park(
            left.join(onto("a"), "a")
            .join(onto("b"), "b")
            .where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            "edges",
        )
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = park(labels.groupBy("label").agg(F.min("node").alias("component")), "least")
    return park(labels.join(least, "label").select("node", "component"), "components")
