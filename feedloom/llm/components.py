"""Connected classes of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import settle


def connect(links: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node reachable from each node of the links ``(a, b)``.

    Alternating large and small stars: every node's larger neighbours, then its smaller ones, are hung on its
    smallest neighbour, until nothing changes. Each round is a table in the shared folder; the links only ever
    meet as grouped rows, and the smallest neighbour is a partial aggregate, so a hot node is no hot group.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x <> y").distinct(), "links")
    while True:
        both = edges.union(edges.select("y", "x"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = settle(
            both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y").distinct(),
            "large-star",
        )
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        hung = large.join(least, "x")
        small = settle(
            hung.select(F.col("y").alias("x"), F.col("m").alias("y")).union(least.select("x", F.col("m").alias("y"))).where("x <> y").distinct(),
            "small-star",
        )
        parents = small.groupBy("x").agg(F.min("y").alias("y"), F.max("y").alias("most"))
        open_rows = parents.where("y <> most").select("x").union(
            small.join(parents.select(F.col("x").alias("node")), F.col("y") == F.col("node"), "left_semi").select("x")
        )
        edges = small
        if open_rows.isEmpty():  # every node hangs on one root
            roots = edges.select(F.col("y").alias("node"), F.col("y").alias("label")).distinct()
            return settle(edges.select(F.col("x").alias("node"), F.col("y").alias("label")).union(roots), "classes")
