"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doseline.llm.common import keep


def _toward_least(edges: DataFrame) -> DataFrame:
    """Each end `u` of (`u`, `v`) with the least of itself and its neighbours, `m`."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _toward_least(down)
    rest = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = linked.select("u", F.col("m").alias("v"))
    return rest.unionByName(own).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, its component's least node, for each node of links (`a`, `b`).

    Every round hangs each node's neighbours below the least of them, first the larger ones,
    then the smaller ones, until nothing changes; rounds grow as the logarithm of the longest
    chain. Minima are aggregated before shuffling, and a node with many links is split by
    Spark's skew join. Each round is written to the shared folder; only a count and a
    checksum of it reach the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = keep(edges.distinct(), "links")
    mark = None
    while True:
        edges = keep(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = now
