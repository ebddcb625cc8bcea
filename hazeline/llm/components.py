"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.plans.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge; root is the smallest node reachable.

    ``edges`` has two columns of one ordered type. Loops, repeats and either direction are
    allowed; edges with a null are left out. Every round is written to the shared folder and
    read back. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    clean = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stage(clean.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "edges")
    mark = None
    while True:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "stars")
        print_of = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        seen = tuple(now.agg(F.count("*"), print_of).first())
        if seen == mark or seen[0] == 0:
            break
        mark = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
