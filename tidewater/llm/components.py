"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a and b): the smallest node
    that it reaches.

    Each round maps every node to the first node, in some order, among itself and its
    neighbours and contracts the edges by that map. The first round takes the nodes in their
    own order, which finishes stars around their smallest node; later ones take a fresh random
    order each, which leaves a fraction of the nodes also on long paths. Neighbours are only
    aggregated, never gathered, so a node may have any number of them. Each round's tables are
    written to the shared folder.
    """
    edges = saved(edges.select("a", "b").where("a <> b").distinct().withColumn("turn", F.lit(1)), "edges")
    label = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct() \
        .select("node", F.col("node").alias("now"))

    def rank(c):
        # The round is a column, not a literal, so that all rounds share their compiled code.
        order = F.when(F.col("turn") == 1, F.col(c)).otherwise(F.xxhash64("turn", F.col(c)))
        return F.struct(order.alias("r"), F.col(c).alias("v"))

    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a", "turn"))
        first = saved(both.groupBy("a", "turn").agg(F.min(rank("b")).alias("m"))
                      .select(F.col("a").alias("old"), F.least("m", rank("a"))["v"].alias("new")), "contraction")
        edges = saved(edges.join(first.select(F.col("old").alias("a"), F.col("new").alias("x")), "a")
                      .join(first.select(F.col("old").alias("b"), F.col("new").alias("y")), "b")
                      .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("turn") + 1).alias("turn"))
                      .distinct(), "edges")
        label = saved(label.join(first.select(F.col("old").alias("now"), "new"), "now", "left")
                      .select("node", F.coalesce("new", "now").alias("now")), "labels")
    least = label.groupBy("now").agg(F.min("node").alias("component"))
    return label.join(least, "now").select("node", "component")
