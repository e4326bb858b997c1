"""Consolidation of pairwise matches into groups (problem 2).

Vertices that cannot merge anything are taken out first: those with one neighbour are stripped, and of
the chains of vertices with two neighbours an independent set is spliced out in every round (list
ranking by independent-set contraction), its two neighbours being linked instead. What is left is a
small core whose vertices all have three or more neighbours; it is solved by star contraction. Each
removed vertex kept the vertex it hung on; pointer doubling over these restores the labels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.operators.components import connected_components
from sitewright.session import Workspace


def _priority(c: Column, step: int) -> Column:
    return F.xxhash64(F.lit(step), c)


def contract(edges: DataFrame, work: Workspace) -> tuple[DataFrame | None, DataFrame]:
    """Strip and splice until no vertex of degree one or two is left.

    edges: distinct u < v. Returns the removed vertices (v, parent), or None, and the core's edges.
    """
    removed: list[DataFrame] = []
    step = 0
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = both.groupBy("u").agg(F.count("*").alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        light = ends.where("d <= 2")
        around = light.select("u", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("nb"))
        rival = ends.where("d <= 2").select(F.col("u").alias("nb"), F.lit(True).alias("light"))
        # of two neighbours that both could go, only the one of lower priority goes in this round
        stays = F.col("light") & (_priority(F.col("nb"), step) < _priority(F.col("u"), step))
        chosen = (
            around.join(rival, "nb", "left")
            .groupBy("u", "lo", "hi")
            .agg(F.max(F.coalesce(stays, F.lit(False))).alias("stays"))
            .where("not stays")
            .select(F.col("u").alias("v"), F.col("lo").alias("parent"), F.col("hi").alias("other"))
        )
        out = work.write(chosen, f"removed-{step}")
        if out.isEmpty():
            break
        removed.append(out.select("v", "parent"))
        gone = out.select("v", F.explode(F.array_distinct(F.array("parent", "other"))).alias("nb"))
        spliced = out.where("parent <> other").select(F.col("parent").alias("u"), F.col("other").alias("v"), F.lit(0).alias("gone"))
        changes = gone.select(F.least("v", "nb").alias("u"), F.greatest("v", "nb").alias("v"), F.lit(1).alias("gone")).union(spliced)
        left = edges.select("u", "v", F.lit(0).alias("gone")).union(changes).groupBy("u", "v").agg(F.max("gone").alias("gone")).where("gone = 0").select("u", "v")
        step += 1
        edges = work.write(left, f"edges-{step}")
        work.drop(f"edges-{step - 1}")
        if edges.isEmpty():
            break
    return (reduce(DataFrame.union, removed) if removed else None), edges


def restore(removed: DataFrame, core: DataFrame, work: Workspace) -> DataFrame:
    """Labels of the core carried back to the removed vertices: columns id, root.

    The removed vertices hang on each other as a forest no deeper than the rounds of contraction; each
    pass doubles the distance that a vertex looks up.
    """
    forest, step = work.write(removed, "forest-0"), 0
    while True:
        up = forest.select(F.col("v").alias("parent"), F.col("parent").alias("above"))
        jumped = forest.join(up, "parent", "left").select("v", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved"))
        step += 1
        following = work.write(jumped, f"forest-{step}")
        work.drop(f"forest-{step - 1}")
        forest = following.select("v", "parent")
        if following.where("moved").isEmpty():
            break
    labels = forest.join(core.select(F.col("id").alias("parent"), "root"), "parent", "left").select(F.col("v").alias("id"), F.coalesce("root", "parent").alias("root"))
    tops = forest.select(F.col("parent").alias("id")).distinct().join(core, "id", "left_anti").select("id", F.col("id").alias("root"))
    return labels.union(tops).union(core)


def group_vertices(edges: DataFrame, work: Workspace) -> DataFrame:
    """One root for all vertices linked directly or over others: columns id, root.

    edges: u, v of one ordered type. Loops and edges with a null end link nothing and repeated edges
    count once; a vertex without another does not occur in the result. No edges give no rows.
    """
    start = edges.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    removed, core_edges = contract(work.write(start, "edges-0"), work)
    core = connected_components(core_edges, work, "core")
    return core if removed is None else work.write(restore(removed, core, work), "labels")


class KeyCollision(ValueError):
    """Two match keys got the same 64-bit number; the caller takes another seed."""


def group_records(matches: DataFrame, record: str, keys: list[str], work: Workspace) -> DataFrame:
    """Give each record the group of all records linked to it: columns record, groupid.

    matches: one row per record and match; rows with equal keys match each other. groupid is the least
    record (by code point) of the group. Only records linked to another one are in the result, once
    each. A null record is no record, and a row with a null key links nothing. Repeated rows count once.

    The graph's vertices are the matches, numbered by a 64-bit hash that is checked against a second
    one. A record in a single match has one neighbour and one in two matches has two, so that records
    are the first vertices to be stripped and spliced: the record's least match is linked to its others.
    """
    known = matches.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [record, *keys]]))
    for seed in range(8):
        try:
            return _group_records(known.select(F.col(record).alias("r"), F.xxhash64(F.lit(seed), *keys).alias("k"), F.xxhash64(F.lit(~seed), *keys).alias("check")), record, work, seed)
        except KeyCollision:
            continue
    raise KeyCollision("no seed without a collision")


def _group_records(rows: DataFrame, record: str, work: Workspace, seed: int) -> DataFrame:
    numbered = rows.groupBy("k").agg(F.min("check").alias("a"), F.max("check").alias("b"))
    if not numbered.where("a <> b").isEmpty():
        raise KeyCollision
    # two hashes stand for the record itself, so that its text is not shuffled for the links
    short = rows.select(F.xxhash64("r").alias("r1"), F.xxhash64(F.lit(1), "r").alias("r2"), "k")
    least = short.groupBy("r1", "r2").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi").select("r1", "r2", "lo")
    links = short.join(least, ["r1", "r2"]).where("k <> lo").select(F.col("lo").alias("u"), F.col("k").alias("v"))
    labels = group_vertices(links, work).select(F.col("id").alias("k"), "root")

    records = work.write(rows.groupBy("r").agg(F.min("k").alias("k")), f"records-{seed}")
    per_match = records.groupBy("k").agg(F.min("r").alias("r"), F.count("*").alias("n"))
    rooted = work.write(per_match.join(labels, "k", "left").select("k", F.coalesce("root", "k").alias("root"), "r", "n"), f"rooted-{seed}")
    groups = rooted.groupBy("root").agg(F.min("r").alias("groupid"), F.sum("n").alias("n")).where("n > 1").select("root", "groupid")
    named = rooted.select("k", "root").join(groups, "root").select("k", "groupid")
    return records.join(named, "k").select(F.col("r").alias(record), "groupid")
