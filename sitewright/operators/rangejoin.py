"""Joins on coordinates: overlap, band and nearest.

Every join is an equi-join on the keys and a coordinate bucket with the exact condition as a residual, so
that no chromosome is compared as a whole and a crowded one is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.session import Workspace


def _bucket(c: Column, width: int) -> Column:
    return F.floor(c / width)


def overlap_join(points: DataFrame, intervals: DataFrame, keys: list[str], pos: str, start: str, end: str, width: int = 1 << 14, how: str = "inner") -> DataFrame:
    """Points with the intervals (inclusive at both ends) that contain them.

    how: inner, left, left_semi or left_anti. An interval is listed in each bucket it touches, so width
    should be near the usual interval length. Null coordinates match nothing.
    """
    listed = intervals.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col(start), width), _bucket(F.col(end), width)))).where(F.col(start) <= F.col(end))
    p, i = points.withColumn("_bucket", _bucket(F.col(pos), width)).alias("p"), listed.alias("i")
    on = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in [*keys, "_bucket"]] + [F.col(f"p.{pos}").between(F.col(f"i.{start}"), F.col(f"i.{end}"))]
    joined = p.join(i, on, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_bucket")
    rest = [c for c in intervals.columns if c not in keys]
    return joined.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in rest])


def band_join(left: DataFrame, right: DataFrame, keys: list[str], left_pos: str, right_pos: str, reach: int) -> DataFrame:
    """Pairs with equal keys and coordinates at most reach apart. Columns of the sides must not clash but for the keys."""
    near = F.explode(F.array_distinct(F.array(*[_bucket(F.col(left_pos) + d, max(reach, 1)) for d in (-reach, 0, reach)])))
    pairs = left.withColumn("_bucket", near).join(right.withColumn("_bucket", _bucket(F.col(right_pos), max(reach, 1))), [*keys, "_bucket"])
    return pairs.where(F.abs(F.col(left_pos) - F.col(right_pos)) <= reach).drop("_bucket")


def nearest_edge(points: DataFrame, edges: DataFrame, keys: list[str], before: bool, width: int) -> DataFrame:
    """keys, pos and the nearest edge at or before (after) each distinct point.

    Two levels: a window inside each bucket, and one over the buckets' own extremes, so that no task
    holds more than a bucket of points or the list of buckets.
    """
    both = points.select(*keys, "pos", F.lit(None).cast("long").alias("edge")).union(edges.select(*keys, F.col("edge").alias("pos"), "edge")).withColumn("b", _bucket(F.col("pos"), width))
    pick, order = (F.max, F.col("pos").asc()) if before else (F.min, F.col("pos").desc())
    inside = W.partitionBy(*keys, "b").orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    local = both.withColumn("inside", pick("edge").over(inside)).where("edge is null")
    step = F.col("b").asc() if before else F.col("b").desc()
    sums = both.groupBy(*keys, "b").agg(pick("edge").alias("own")).withColumn("carried", pick("own").over(W.partitionBy(*keys).orderBy(step).rowsBetween(W.unboundedPreceding, -1)))
    return local.join(sums.select(*keys, "b", "carried"), [*keys, "b"]).select(*keys, "pos", F.coalesce("inside", "carried").alias("edge"))


def fill_down(rows: DataFrame, heads: DataFrame, keys: list[str], width: int = 1 << 16) -> DataFrame:
    """Keys, pos and the last head (column edge) at or before each distinct position."""
    return nearest_edge(rows, heads, keys, True, width).distinct()


def nearest_join(points: DataFrame, intervals: DataFrame, keys: list[str], pos: str, start: str, end: str, width: int = 1 << 18, work: Workspace | None = None) -> DataFrame:
    """Each distinct point with all its nearest intervals: keys, pos, distance and the interval's columns.

    distance is 0 inside an interval, else the difference to its nearest edge. A point whose keys have no
    interval is not in the result. Equal intervals are all kept. Both sides are used several times: with a
    work folder they are written there once.
    """
    spots = points.select(*keys, F.col(pos).cast("long").alias("pos")).where("pos is not null").distinct()
    named = intervals.withColumn("_start", F.col(start).cast("long")).withColumn("_end", F.col(end).cast("long")).where("_start <= _end")
    spots, named = Workspace.settle(spots, work, "spots"), Workspace.settle(named, work, "intervals")
    inside = Workspace.settle(overlap_join(spots, named, keys, "pos", "_start", "_end", width).withColumn("distance", F.lit(0).cast("long")), work, "inside")
    outside = spots.join(inside.select(*keys, "pos").distinct(), [*keys, "pos"], "left_anti")
    left = nearest_edge(outside, named.select(*keys, F.col("_end").alias("edge")).distinct(), keys, True, width).withColumnRenamed("edge", "left_edge")
    right = nearest_edge(outside, named.select(*keys, F.col("_start").alias("edge")).distinct(), keys, False, width).withColumnRenamed("edge", "right_edge")
    d = left.join(right, [*keys, "pos"]).withColumn("distance", F.least(F.col("pos") - F.col("left_edge"), F.col("right_edge") - F.col("pos")))
    sides = F.array(F.struct(F.col("left_edge").alias("edge"), F.lit(True).alias("is_end")), F.struct(F.col("right_edge").alias("edge"), F.lit(False).alias("is_end")))
    wanted = d.select(*keys, "pos", "distance", F.explode(sides).alias("e")).where(F.abs(F.col("e.edge") - F.col("pos")) == F.col("distance")).select(*keys, "pos", "distance", "e.edge", "e.is_end")
    ends = named.withColumn("edge", F.col("_end")).withColumn("is_end", F.lit(True)).unionByName(named.withColumn("edge", F.col("_start")).withColumn("is_end", F.lit(False)))
    near = wanted.join(ends, [*keys, "edge", "is_end"])
    columns = [*keys, "pos", "distance", *[c for c in intervals.columns if c not in keys]]
    return inside.select(columns).union(near.select(columns))
