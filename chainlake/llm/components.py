"""Connected components by alternating stars: each round makes every node point nearer to its smallest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    # Half of each hash: their sum cannot overflow below 2^31 edges times 2^32.
    check = F.sum(F.xxhash64("hi", "lo").bitwiseAND(0xFFFFFFFF).cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), check).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
    )
    # Written, so that both sides of the join are plain scans: a node of very many edges is split by AQE.
    least = saved(both.groupBy("node").agg(F.min("other").alias("least")), "least")
    moved = both.join(least, "node").where("other > node")
    return moved.select(F.col("other").alias("hi"), F.least("node", "least").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = saved(edges.groupBy("hi").agg(F.min("lo").alias("least")), "least")
    moved = edges.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every node that an edge touches and that is not its component's smallest itself.

    Takes repeated edges, loops and either direction. Rounds grow with the logarithm of the components'
    diameter; each is a written table, and only its size and checksum reach the driver. No edges: no rows.
    """
    ordered = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")
    )
    now = saved(ordered.distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = saved(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
