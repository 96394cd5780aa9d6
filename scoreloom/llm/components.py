"""Connected components of an edge table by alternating large and small stars.

Each step points nodes at the least neighbour they know; the steps are joins with one-row-per-node
minima, so hubs cost no more than their edges, and the number of rounds grows with the logarithm of the
longest path. After each round the edges are a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared


#: Edges that need no care for hubs: a task may hold them all.
FEW = 1_000_000


def _least(least: DataFrame, hubs: bool) -> DataFrame:
    """Stored where a node may have very many edges: adaptive execution splits it only where both sides come straight from a shuffle."""
    return _shared.stored(least, "least") if hubs else least


def _large(edges: DataFrame, hubs: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(_least(least, hubs), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(edges: DataFrame, hubs: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down.groupBy("u").agg(F.min("v").alias("m")), hubs)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """node, root (the least node of its component) for every node of ``edges`` (u, v: long) but the roots themselves."""
    edges = _shared.stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    sign, n = None, edges.count()
    while True:
        large = _large(edges, n > few).distinct()
        before, edges = edges, _shared.stored(_small(_shared.stored(large, "large") if n > few else large, n > few).distinct(), "edges")
        _shared.dropped(before)
        new = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == sign or new[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        sign, n = new, new[0]
