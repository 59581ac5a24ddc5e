"""Connected components of an edge table by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramline.plans.storage import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest one, or to itself."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them. Takes edges with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u > v")
    return tied.unionByName(least.select("u", F.col("least").alias("v")))


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node with a link to another, the smallest node that it reaches. Nodes may be of any type
    that has an order. Every round is a written table; sums are partial, so a node may have any number of links."""
    now = written(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    mark = _print(now)
    while mark[0]:
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
        after = _print(now)
        if after == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
