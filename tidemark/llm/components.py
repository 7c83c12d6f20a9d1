"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of every node with a smaller one in its component; ``label`` is the smallest.

    ``links(a, b)`` holds longs in either order; NULLs are left out. Each round points every node's larger
    neighbours, then its smaller ones, to the smallest node around it; rounds grow with the logarithm of the
    table. Minima are taken with map-side combine, so a node with very many links is never gathered in one
    task, and each round is a written table.
    """
    pairs = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = written(pairs.distinct(), "links")
    before = None
    while before != (now := _state(edges)):
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(
            both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "links",
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        lower = large.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(lower.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
