"""Connected components by alternating stars, each step a join and a grouping in Spark.

Every node learns the least of its neighbours and passes it on to the larger ones (large
star), then to the smaller ones (small star), until each edge leads to the least node of
its component. The number of steps grows with the logarithm of the size, not with the
diameter. Edges are written to the shared folder after each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import stage


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct())


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots themselves; the root is
    the least node of the component."""
    edges, mark = stage(edges.select("a", "b").filter("a <> b"), "edges"), None
    while True:
        edges = stage(small_star(large_star(edges)), "edges")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == mark or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
