"""Connected components by alternating large and small stars, on DataFrames.

A node's neighbours are never gathered: each step takes the least neighbour
by a combinable minimum and joins it back, so a hub's edges may be split.
Each round's edges are written to the shared folder, and the round's before removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import drop_table, via_table


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v")))


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the least node that each node of ``edges (u, v)`` reaches."""
    now = via_table(edges.where("u <> v").distinct(), "edges")
    seen = _print(now)
    while True:
        before, now = now, via_table(_small(_large(now)).where("u <> v").distinct(), "edges")
        new = _print(now)
        drop_table(before)
        if new == seen:
            break
        seen = new
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
