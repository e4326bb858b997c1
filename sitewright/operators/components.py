"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.session import Workspace


def _symmetric(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the least of its closed neighbourhood."""
    both = _symmetric(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """Label every vertex of an edge with the least vertex of its component: columns id, root.

    edges: u, v of one ordered type. Edges with a null end and loops link nothing; repeated edges count
    once. Without edges the result is empty. Every step is an aggregate and an equi-join over the edges;
    a step's table is written to the shared folder and the one before it removed. No neighbourhood is
    gathered: the rounds grow with the logarithm of the longest path.
    """
    now = work.write(edges.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"{name}-0")
    before, step = None, 0
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))).first()
        if not state[0] or state == before:
            break
        before = state
        step += 1
        following = work.write(_small_star(_large_star(now)), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
        now = following
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(roots)
