"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from graphloom.llm.common import materialise


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (both.join(least, "u").where(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge between two nodes; the root is the least node of the component.

    Each step is a written table, and the driver sees only its row count and checksum.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v"))
    now, seen = materialise(pair.distinct(), "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            break
        now, seen = materialise(_stars(now), "edges"), state
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
