"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(neighbours: DataFrame, keep, name: str, rows: int) -> DataFrame:
    """Links each kept neighbour of u to the least of u and its neighbours.

    The least ones are written first: the join is then between plain exchanges, and Spark can split the
    partition of a node with very many links.
    """
    least = neighbours.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    least = staged(least.select("m_u", F.least("m_u", "m").alias("m")), "star-least", rows)
    met = neighbours.join(least, F.col("u") == F.col("m_u"))
    out = met.where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return staged(out.where("u <> v").distinct(), name, rows)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """u, root for every node of ``edges`` (u, v); root is the least node of its component. ``rows``: of ``edges``, at most.

    Every step is a grouped minimum and a join over written tables; a node with very many links
    is pre-aggregated before the shuffle. The number of rounds grows with the logarithm of the
    largest component.
    """
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links", rows)
    seen = None
    while True:
        sign = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("s")).first()
        if sign == seen:
            break
        seen = sign
        large = _star(_both(now), F.col("v") > F.col("u"), "large-star", 2 * sign["n"])
        # v <= u: the links as they lie, and the node itself by way of its least neighbour
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        own = down.select("u", F.col("u").alias("v")).distinct()
        now = _star(down.unionByName(own), F.lit(True), "small-star", 2 * sign["n"])
    roots = now.groupBy("u").agg(F.min("v").alias("root"))
    tops = now.select(F.col("v").alias("u")).distinct().join(now.select("u").distinct(), "u", "left_anti")
    return roots.unionByName(tops.select("u", F.col("u").alias("root")))
