"""Connected components of a graph given as an edge table.

Alternating stars: every node first links its larger neighbours, then its
smaller ones, to the least of its neighbours, until each component is a star
around its least node. Rounds grow with the logarithm of the number of nodes;
each is written to the shared folder, so nothing of the graph meets in the
driver and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``(node, component)`` of every node with a link to another.

    ``links`` holds undirected pairs of longs, repeats, both directions and
    loops allowed; pairs with a null are ignored. ``component`` is the least
    node that can be reached. No link gives no row.
    """
    a, b = F.col(first), F.col(second)
    edges = staged(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                   "edges")
    before = _state(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
