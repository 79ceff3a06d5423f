"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.store import store

#: Parts that a node's edges are dealt to by their other end; a hub's minimum is given to each.
SALTS = 8


def _with_lowest(edges: DataFrame) -> DataFrame:
    """``u, v, m``: each edge with the smaller of ``u`` and its smallest neighbour, which is counted map-side first."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    lowest = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).select("u", "m", salts)
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(lowest, ["u", "salt"]).select("u", "v", "m")


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node next to it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_lowest(both).filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    lowest = _with_lowest(down)
    moved = lowest.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` for every node of ``edges``: the smallest node it is connected to.

    No neighbour list is ever gathered: a hub is a key with many small rows, dealt to several parts. Every round is
    written to the shared folder.
    """
    now = store(edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == tuple(sign) or not sign["n"]:
            break
        before = tuple(sign)
        now = store(small_star(store(large_star(now), "large-star")), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
