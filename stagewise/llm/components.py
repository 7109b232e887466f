"""Connected components of an edge table by rounds of DataFrame joins (large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _starred(edges: DataFrame, both: bool) -> DataFrame:
    """Link the neighbours of every node to the smallest node around it.

    ``both``: from all neighbours, link the larger ones (large-star); else from
    the smaller neighbours and the node itself (small-star). A hub's rows are
    joined by key, so a skewed join can split them.
    """
    around = edges.select("a", "b")
    if both:
        around = around.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).withColumnRenamed("a", "_node")
    met = around.join(least, F.col("a") == F.col("_node"))
    if both:
        return met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    links = met.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return links.unionByName(least.select(F.col("_node").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b): root is the smallest node connected to it.

    Loops and repeated edges are allowed; an empty table gives an empty one.
    The rounds grow with the logarithm of the longest way; each is stored.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = stored(pairs, "edges")
    mark = None
    while True:
        state = stored(_starred(_starred(state, both=True), both=False), "edges")
        now = tuple(
            state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if now == mark:
            break
        mark = now
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
