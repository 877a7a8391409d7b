"""Connected components of a graph given by its edges, by alternating star contractions.

Each round joins edges with the smallest neighbour of each node.  Smallest neighbours are
aggregated before the shuffle, and the joins are plain equi-joins that adaptive execution can
split, so a node with a third of all edges is no bottleneck.  Rounds grow with the logarithm of
the graph's diameter.

Defined cases: loops, nulls, directions and repeated edges do not matter; no edges give no rows; the
smallest node of a component names it; columns after the first two are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
    return both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").selectExpr("v AS u", "m AS v")
    return moved.unionAll(least.selectExpr("u", "m AS v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable; only nodes with an edge.

    ``edges`` has two columns of the same ordered type.  Loops, nulls, directions and repeated
    edges do not matter; no edges give no rows.
    """
    a, b = edges.columns[:2]
    current = stored(
        edges.selectExpr(f"greatest(`{a}`, `{b}`) AS u", f"least(`{a}`, `{b}`) AS v", f"`{a}` <> `{b}` AS real")
        .filter("real").drop("real").distinct(),
        "edges",
    )
    mark = None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(seen)
        current = stored(_small_star(_large_star(current)), "stars")
