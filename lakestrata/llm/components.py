"""Connected components of an edge list, by alternating large and small stars.

Every round is two group-by-min steps and joins; a star centre with many
neighbours is aggregated on the map side and its join partition can be split,
so no neighbour list is ever gathered. Each round is written to the shared
folder. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of a node and its neighbours."""
    return C.written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the least node reachable."""
    now = C.written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the least neighbour
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = C.written(large, "cc-large")
        # small star: a node and its smaller neighbours move to the least of them
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = C.written(small.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct(), "cc")
        # done when no centre has an edge to a smaller node and nothing moved
        moved = small.exceptAll(now).limit(1).count() + now.exceptAll(small).limit(1).count()
        now = small
        if moved == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
