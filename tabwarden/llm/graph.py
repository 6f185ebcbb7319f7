"""Connected components by alternating large and small stars, with a written table after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.functions import sizing


def _hang(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "u")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``root`` (smallest node of the component), for every node that has an edge.

    ``edges``: ``a``, ``b`` (bigint). Each round hangs a node's larger neighbours on its smallest one,
    then its smaller ones; minima are aggregated map-side and a hub's rows are split by the planner.
    Rounds grow with the logarithm of the longest chain. Edges with a null end count for nothing.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = sizing.cut_lineage(e, name)
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _hang(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _hang(large, least).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = sizing.cut_lineage(small.where("u <> v").distinct(), name)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
