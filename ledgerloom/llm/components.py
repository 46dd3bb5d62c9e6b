"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least_neighbour() -> Column:
    """A node's neighbours are one window: two ids a row, on disk where they are many."""
    return F.min("v").over(Window.partitionBy("u"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    near = _both_ways(edges).withColumn("m", F.least(_least_neighbour(), "u"))
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; expects the smaller id in `v`."""
    down = edges.withColumn("m", _least_neighbour())
    ties = F.array(*[F.struct(F.col(c).alias("u"), F.col("m").alias("v")) for c in ("u", "v")])
    return down.select(F.explode(ties).alias("tie")).select("tie.u", "tie.v").where("u <> v")


def connected_components(edges: DataFrame) -> DataFrame:
    """`(u, v)` links of any orientable type to `(u, v)`: every non-smallest node with the smallest it reaches.

    Self-links and repeated links are ignored. The number of rounds grows with the logarithm of the
    node count; each round is written to the shared folder.
    """
    current = staged(edges.where("u <> v").distinct(), "links")
    seen = None
    while True:
        sign = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if sign == seen or sign[0] == 0:
            return current
        seen = sign
        current = staged(_small_star(_large_star(current)).distinct(), "links")
