"""Connected components of a graph given by its edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import stored

#: Pointer jumps a round: a chain shrinks to an eighth.
JUMPS = 3


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ends of `edges` (a, b); a component is its smallest id.

    Each round hooks every node to its smallest neighbour if that is smaller, jumps
    along the hooks, and contracts the edges; a round leaves a fraction of the nodes,
    so the number of rounds grows with the logarithm of the longest chain. Minima are
    combined before the shuffle; tables of a round are written, so lineage stays short.
    """
    live = stored(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    labels = stored(live.select(F.col("a").alias("id")).union(live.select("b")).distinct().withColumn("component", F.col("id")))
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
        parent = stored(parent.select("id", F.least("id", "near").alias("up")))
        for _ in range(JUMPS):
            above = parent.select(F.col("id").alias("up"), F.col("up").alias("top"))
            parent = stored(parent.join(above, "up").select("id", F.col("top").alias("up")))
        labels = stored(
            labels.join(parent.withColumnRenamed("id", "component"), "component", "left").select(
                "id", F.coalesce("up", "component").alias("component")
            )
        )
        for end in ("a", "b"):
            live = live.join(parent.withColumnRenamed("id", end), end).drop(end).withColumnRenamed("up", end)
        live = stored(live.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    return labels
