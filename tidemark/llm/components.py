"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node of its component.

    Rounds of two steps: every node takes the smallest root seen at a neighbour's root, then
    roots are followed to their own roots. Each is an aggregate or a join on a key, never a walk on the
    driver. A link table shrinks to links between different roots in each round, so a
    large star is gone after the first.
    """
    edges = materialise(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    parent = materialise(nodes.select("node", F.col("node").alias("root")), "roots")
    while not edges.isEmpty():
        # every larger end hangs below its smallest smaller end
        hung = edges.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to"))
        jump = materialise(hung, "jump")
        while True:  # follow the new chains to their ends; each pass halves them
            to = jump.select(F.col("from").alias("mid"), F.col("to").alias("end"))
            longer = jump.join(to, jump["to"] == to["mid"], "left")
            if longer.where(F.col("mid").isNotNull()).isEmpty():
                break
            jump = materialise(longer.select("from", F.coalesce("end", "to").alias("to")), "jump")

        def moved(df: DataFrame, column: str) -> DataFrame:
            there = jump.select(F.col("from").alias("__from"), F.col("to").alias("__to"))
            return df.join(there, F.col(column) == F.col("__from"), "left") \
                .withColumn(column, F.coalesce("__to", column)).drop("__from", "__to")

        parent = materialise(moved(parent, "root"), "roots")
        rest = moved(moved(edges, "a"), "b").where(F.col("a") != F.col("b"))
        edges = materialise(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return parent
