"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessel.plans.stages import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, the component being the least node reachable.

    Alternates two steps until nothing changes, each a grouped minimum: every node's larger neighbours, then its smaller
    ones, are tied to the least node around it. A component of any shape shrinks to a star in a logarithmic number of rounds.
    Each round is written, so that lineage stays short. Self-loops count as nodes; null ends are dropped.
    """
    flat = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    links = written(flat.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    work, mark = links.filter("a != b"), None
    while True:
        # large star: each node's larger neighbours go to the least of its neighbourhood
        around = work.union(work.select("b", "a"))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        # small star: each node's smaller neighbours, and the node, go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        work = written(small.filter("a != b").distinct(), "stars")
        state = work.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == mark:
            return nodes.join(work, nodes.node == work.a, "left").select("node", F.coalesce("b", "node").alias("component"))
        mark = tuple(state)
