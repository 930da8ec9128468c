"""Connected components of an edge table by alternating large-star and small-star steps.

Each step replaces a node's edges by edges to the least node around it; the edges shrink to stars in a few rounds.
Nothing is collected but a count and a checksum; each round's edges are stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (long columns a, b); the root is the component's least node."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == last:
            break
        last = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
