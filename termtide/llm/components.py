"""Connected components of a graph given as an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.common import HOT_KEYS, LEAST_HOT, cut


def _hung_larger(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours hung under its smallest neighbour, or itself if it is less.

    `(a, b, moved)`, where a is the larger end. The neighbours of one node meet in a task, but for
    nodes with very many: those are a few thousand at most, and their smallest neighbours are
    sent to all tasks.
    """
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    limit = max(pairs.count() // HOT_KEYS, LEAST_HOT)
    hubs = both.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("least"))
    hubs = hubs.filter(F.col("n") > limit).select("a", "least").collect()
    few = both
    if hubs:
        hubs = F.broadcast(pairs.sparkSession.createDataFrame(hubs, "a bigint, least bigint"))
        few = both.join(hubs, "a", "left_anti")
    least = few.withColumn("least", F.min("b").over(Window.partitionBy("a")))
    if hubs:
        least = least.unionByName(both.join(hubs, "a"))
    return least.filter("b > a").selectExpr("b AS a", "least(least, a) AS b", "least < a AS moved")


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, component)` for every node in `edges(a, b)`; the component is its smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, under its smallest
    neighbour, until all edges lead to a root. The number of edges does not grow, the number of
    rounds is logarithmic in practice, and each round is cut off by a table. Only counts, flags
    and the nodes with very many neighbours come to the driver. Null ends are ignored.
    """
    pairs = edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    pairs = cut(pairs.distinct(), "components")
    moving = True
    while moving:
        # Dealt by node first, so that neither the distinct edges nor the window shuffle again.
        hung = _hung_larger(pairs).repartition("a").distinct()
        hung = hung.withColumn("least", F.min("b").over(Window.partitionBy("a")))
        # The edge to the smallest neighbour stays.
        hung = hung.selectExpr("if(b = least, a, b) AS a", "least AS b", "moved OR b <> least AS moved")
        hung = cut(hung, "components")
        # Where nothing moved all edges led to a root already, and are distinct.
        moving = bool(hung.agg(F.bool_or("moved")).first()[0])
        pairs = hung.drop("moved")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
