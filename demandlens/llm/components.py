"""Connected components of a graph given by its edges, as joins and pre-aggregated minima.

Alternates two steps (Kiveris et al., Connected Components in MapReduce and Beyond,
2014): every node links its larger neighbours to the smallest node around, then its
smaller ones. Edges never grow in number; rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import checkpointed


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, of every node but the roots."""
    a, b = F.col(left), F.col(right)
    stars = checkpointed(edges.where(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct())
    state = summary(stars)
    while True:
        around = stars.select("node", "root").union(stars.select("root", "node"))
        least = around.groupBy("node").agg(F.min("root").alias("least"))
        large = (
            around.where("root > node")
            .join(least.select("node", F.least("node", "least").alias("least")), "node")
            .select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        )
        large = checkpointed(large)
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        stars = checkpointed(
            large.join(least, "node")
            .select(F.explode(F.array(F.struct("node", "least"), F.struct(F.col("root").alias("node"), "least"))).alias("e"))
            .select(F.col("e.node").alias("node"), F.col("e.least").alias("root"))
            .where("node <> root").distinct()
        )
        state, before = summary(stars), state
        if state == before:
            return stars


def summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first())
