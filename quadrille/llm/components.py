"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the undirected edges ``a, b`` (longs): the smallest node it can reach.

    Each round every node moves to its least neighbour, if that is smaller, and on to that one's own choice;
    edges follow their ends and vanish when both ends meet. A node loses to a neighbour unless it is least among
    its own, so rounds grow with the logarithm of the graph. Only partial minima are shuffled for hot nodes, and the
    joins have stored tables on both sides, whose hot partitions adaptive execution can split.
    """
    edges = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.selectExpr("b as a", "a as b"))
        up = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).selectExpr("node", "least(node, least) as up"), "up")
        far = up.selectExpr("node as up", "up as farther")
        up = stored(up.join(far, "up", "left").selectExpr("node", "coalesce(farther, up) as up"), "up")
        if labels is None:
            labels = up.selectExpr("node", "up as comp")
        else:
            moved = up.selectExpr("node as comp", "up as moved")
            labels = stored(labels.join(moved, "comp", "left").selectExpr("node", "coalesce(moved, comp) as comp"), "labels")
        a = up.selectExpr("node as a", "up as a_up")
        b = up.selectExpr("node as b", "up as b_up")
        edges = stored(
            edges.join(a, "a").join(b, "b").where("a_up != b_up")
            .selectExpr("least(a_up, b_up) as a", "greatest(a_up, b_up) as b").distinct(),
            "edges",
        )
    if labels is None:
        return edges.selectExpr("a as node", "b as comp")
    return labels
