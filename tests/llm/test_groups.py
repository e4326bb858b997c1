import random

import pytest

from sitewright.llm.groups import group_records, group_vertices
from sitewright.llm.queries import QUERIES
from sitewright.operators.components import connected_components
from sitewright.session import Workspace, table


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in edges:
        parent[find(u)] = find(v)
    groups = {}
    for x in list(parent):
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.root, set()).add(r.id)
    return {frozenset(g) for g in out.values()}


def shapes():
    chain = [(i, i + 1) for i in range(60)]
    cycle = [(100 + i, 100 + (i + 1) % 17) for i in range(17)]
    star = [(200, 201 + i) for i in range(80)]
    clique = [(300 + i, 300 + j) for i in range(6) for j in range(i)]
    rng = random.Random(4)
    tangle = [(rng.randrange(400, 460), rng.randrange(400, 460)) for _ in range(70)]
    return {"chain": chain, "cycle": cycle, "star": star, "clique": clique, "tangle": tangle, "all": chain + cycle + star + clique + tangle + [(30, 105), (201, 300), (5, 5), (0, 1), (1, 0)]}


@pytest.mark.parametrize("shape", ["cycle", "clique", "all"])
def test_shapes(spark, shape):
    edges = shapes()[shape]
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    want = roots([e for e in edges if e[0] != e[1]])
    got = group_vertices(df, Workspace(spark, "t")).collect()
    assert grouped(got) == want and len({r.id for r in got}) == len(got)
    least = connected_components(df, Workspace(spark, "t")).collect()
    assert grouped(least) == want and all(r.root == min(g) for r in least for g in want if r.id in g)


def test_records(spark):
    rows = [("b", "k", 1), ("a", "k", 1), ("b", "m", 2), ("c", "m", 2), ("c", "m", 2), ("lone", "z", 9), ("n1", None, 3), ("n2", None, 3), (None, "k", 1), ("é", "q", 5), ("Z", "q", 5)]
    df = spark.createDataFrame(rows, "readid string, k string, n int").selectExpr("*", "1 as groupid", "2 as root")
    got = {tuple(r) for r in group_records(df, "readid", ["k", "n"], Workspace(spark, "t")).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a"), ("é", "Z"), ("Z", "Z")}
    assert group_records(df.limit(0), "readid", ["k", "n"], Workspace(spark, "t")).count() == 0


def test_hot_match_and_hot_record(spark):
    rows = [(f"r{i:04}", "hot") for i in range(500)] + [("r0001", f"k{i}") for i in range(300)] + [(f"s{i:04}", f"k{i}") for i in range(300)]
    got = group_records(spark.createDataFrame(rows, "r string, k string"), "r", ["k"], Workspace(spark, "t")).collect()
    assert len(got) == 800 and {x.groupid for x in got} == {"r0000"}


def test_table(spark, sf):
    edges = {}
    for r in table(spark, sf, "buildstdfragments").collect():
        c = r.clusterid.strip(" \t\u00a0") if r.clusterid else ""
        if c not in ("", "NA"):
            edges.setdefault((r.trial, r.subject, r.sample, r.mode, r.refgenome, c), set()).add(r.readid)
    want = {(x, min(g)) for g in roots([(a, b) for s in edges.values() for a in [min(s)] for b in s]) if len(g) > 1 for x in g}
    assert {tuple(r) for r in QUERIES["p2_found"](spark, sf).collect()} == want
