"""Per-key aggregation in which a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items the frequency sketch follows. Its counts are off by at most 3.5/TRACKED of the rows, so a key
#: with SHARE of them is always seen. Both the sketch and the list of heavy keys are bounded by it.
TRACKED = 8192
SHARE = 0.002


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """The keys with at least about `share` of the rows of df: at most 1/share + TRACKED * error rows.

    One pass with a mergeable frequent-items sketch; nothing but the sketch is shuffled.
    """
    most = min(TRACKED * 3 // 4, int(2 / share))
    top = df.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top"), F.count("*").alias("n"))
    return top.select(F.explode("top").alias("t"), "n").where(F.col("t.count") >= F.col("n") * share).select(F.col("t.item").alias(key))


def aggregate_skewed(df: DataFrame, key: str, aggs: list[Column], share: float = SHARE) -> DataFrame:
    """Group df by key and compute aggs, crowded keys no slower than the others.

    Heavy keys are found by the sketch and handled through a broadcast join: their rows never leave
    their task before they are reduced to one partial row a task and key. All other rows take the
    ordinary shuffle; the two results are disjoint and united. The heavy list is bounded (heavy_keys),
    so it may be broadcast at any size of df.

    Null keys form no group. An empty df gives an empty result. Columns of df that aggs do not use are
    ignored, whatever their names. Repeated rows count each time.
    """
    heavy = heavy_keys(df.select(key), key, share)
    known = df.where(F.col(key).isNotNull())
    crowded = known.join(F.broadcast(heavy), key, "left_semi").groupBy(key).agg(*aggs)
    others = known.join(F.broadcast(heavy), key, "left_anti").groupBy(key).agg(*aggs)
    return crowded.unionByName(others)
