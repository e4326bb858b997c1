"""Snapping of noisy coordinates to locally supported peaks (§2.13 a; A4, J4, J5, J6, J7, T1, W1, F13)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.session import Workspace

#: Coordinates of one window partition. Partitions overlap by the radius, so a crowded chromosome is
#: spread over many tasks.
BIN = 1 << 16


def coordinate_weights(df: DataFrame, keys: list[str], coord: str, weight: str) -> DataFrame:
    """keys, coord and the summed weight w of each distinct coordinate."""
    return df.groupBy(*keys, coord).agg(F.sum(weight).alias("w"))


def local_maxima(df: DataFrame, keys: list[str], coord: str, weight: str, radius: int) -> DataFrame:
    """keys, coord, w and anchor (w is the greatest within +-radius) of each distinct coordinate. Ties are all anchors."""
    return _anchored(coordinate_weights(df, keys, coord, weight), keys, coord, radius)


def _anchored(w: DataFrame, keys: list[str], coord: str, radius: int) -> DataFrame:
    own = F.floor(F.col(coord) / BIN)
    spread = w.withColumn("bin", F.explode(F.array_distinct(F.array(own, F.floor((F.col(coord) - radius) / BIN), F.floor((F.col(coord) + radius) / BIN)))))
    near = W.partitionBy(*keys, "bin").orderBy(coord).rangeBetween(-radius, radius)
    return spread.withColumn("top", F.max("w").over(near)).where(F.col("bin") == own).select(*keys, coord, "w", (F.col("w") >= F.col("top")).alias("anchor"))


def corrected_positions(weights: DataFrame, keys: list[str], coord: str, window: int = 8, radius: int = 2, shrink: float = 4.0) -> DataFrame:
    """keys, coord and corrected of each coordinate that some anchor within +-window captures.

    weights: as from coordinate_weights. The anchor with the strongest pull w * exp(-d^2 / (2 (window/shrink)^2)) wins, ties go to the lowest
    coordinate. An anchor itself may be captured by a stronger one.
    """
    anchors = _anchored(weights, keys, coord, radius).where("anchor")
    sigma = window / shrink
    reach = anchors.select(*keys, F.col(coord).alias("anchor_at"), "w", F.explode(F.sequence(F.lit(-window), F.lit(window))).alias("d"))
    pull = F.col("w") * F.exp(-F.col("d") * F.col("d") / F.lit(2 * sigma * sigma))
    reach = reach.withColumn("pull", pull).withColumn(coord, F.col("anchor_at") + F.col("d"))
    return reach.drop("w").join(weights.select(*keys, coord), [*keys, coord]).groupBy(*keys, coord).agg(F.max_by("anchor_at", F.struct(F.col("pull"), -F.col("anchor_at"))).alias("corrected"))


def standardize_positions(df: DataFrame, keys: list[str], coord: str, weight: str, window: int = 8, radius: int = 2, shrink: float = 4.0, work: Workspace | None = None) -> DataFrame:
    """df with the column `corrected`; rows without an anchor keep their coordinate.

    A null key or coordinate is never moved: corrected is its coordinate. Repeated rows add their weight.
    With a work folder, the weights of the coordinates are written there once, so that df is read twice only.
    """
    if not (window >= 0 and radius >= 0 and shrink > 0 and math.isfinite(shrink)):
        raise ValueError("window and radius must not be negative and shrink must be positive")
    weights = Workspace.settle(coordinate_weights(df.where(F.col(coord).isNotNull()), keys, coord, weight), work, f"weights-{coord}")
    moved = corrected_positions(weights, keys, coord, window, radius, shrink)
    return df.join(moved, [*keys, coord], "left").withColumn("corrected", F.coalesce("corrected", coord))


def standardize_breakpoints(df: DataFrame, keys: list[str], coord: str, weight: str, read: str, window: int = 5, radius: int = 2, shrink: float = 4.0, work: Workspace | None = None) -> DataFrame:
    """As standardize_positions, but only groups of keys with two or more reads and two or more breaks move.

    The gate needs no distinct count: the least and the greatest value of a group tell whether it has two.
    """
    per = df.groupBy(*keys, coord).agg(F.sum(weight).alias("w"), F.min(read).alias("_r1"), F.max(read).alias("_r2"))
    per = Workspace.settle(per, work, f"weights-{coord}")
    gate = per.groupBy(*keys).agg((F.min("_r1") < F.max("_r2")).alias("_reads"), (F.min(coord) < F.max(coord)).alias("_breaks")).where("_reads and _breaks").select(*keys)
    weights = per.where(F.col(coord).isNotNull()).join(gate, keys, "left_semi").select(*keys, coord, "w")
    moved = corrected_positions(weights, keys, coord, window, radius, shrink)
    return df.join(moved, [*keys, coord], "left").withColumn("corrected", F.coalesce("corrected", coord))
