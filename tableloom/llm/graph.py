"""Connected components of an edge table by alternating star contraction.

Each step is a grouped minimum and a join; edges are written to the shared
folder after each round, so a lost executor repeats one round at most. Nothing
but two numbers of each round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge ``(a, b)``; the root is the component's least node and has a row too.

    Self-loops and repeated edges change nothing; no edges give no rows. Nodes
    must not be null.
    """
    edges = stored(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
