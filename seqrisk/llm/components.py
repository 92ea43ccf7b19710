"""Connected components by alternating large and small stars.

Every round rewires edges towards the smallest neighbour (public algorithm of
Kiveris et al., 2014), with two joins and map-side minima; no neighbour list
is gathered. Each round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seqrisk.llm.common import saved


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _print(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest
    node that can be reached."""
    e = saved(edges.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _print(e)
    while seen[0]:
        e = saved(_small(_large(e)))
        now = _print(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
