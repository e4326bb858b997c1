import random

import pytest

from sitewright.operators.standardize import local_maxima, standardize_breakpoints, standardize_positions

CASES = [
    ({46: 1, 47: 1, 48: 5, 49: 8, 50: 10, 51: 8, 52: 5, 53: 1, 54: 1}, (8, 2, 4), {50: 40}),
    (dict(zip(range(46, 56), [1, 3, 10, 3, 1, 1, 3, 10, 3, 1])), (8, 2, 4), {48: 18, 53: 18}),
    (dict(zip(range(46, 61), [1, 3, 10, 3, 1] * 3)), (8, 2, 4), {48: 18, 53: 18, 58: 18}),
    (dict(zip(range(46, 57), [1, 3, 5, 10, 20, 10, 5, 3, 9, 4, 3])), (8, 2, 4), {50: 54, 54: 19}),
    (dict(zip(range(46, 55), [1, 2] * 4 + [1])), (8, 2, 4), {47: 4, 49: 3, 51: 3, 53: 3}),
    (dict(zip(range(46, 58), [1, 2, 1, 2, 1, 2, 1, 2, 1, 5, 10, 5])), (8, 2, 4), {47: 4, 49: 3, 51: 3, 56: 23}),
    ({1000: 100, 1003: 10, 1006: 5}, (8, 4, 4), {1000: 115}),
    ({1000: 100, 1003: 10, 1006: 5}, (4, 4, 4), {1000: 110, 1006: 5}),
    ({1000: 100, 1003: 60}, (8, 4, 4), {1000: 160}),
    ({1000: 100, 1003: 60}, (8, 2, 4), {1000: 100, 1003: 60}),
    ({1000: 100, 1003: 60}, (8, 2, 2), {1000: 160}),
    ({1000: 100, 1003: 60}, (8, 2, 8), {1000: 100, 1003: 60}),
    ({1000: 100, 1003: 60}, (8, 4, 8), {1000: 160}),
    ({101: 100, 103: 5, 111: 20}, (5, 2, 4), {101: 105, 111: 20}),
    ({101: 100, 103: 5, 111: 20}, (1, 2, 4), {101: 100, 103: 5, 111: 20}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_goldens(spark, case):
    peaks, (window, radius, shrink), want = CASES[case]
    df = spark.createDataFrame([("chrX", "+", c, n) for c, n in peaks.items()], "chrom string, strand string, coord long, reads long")
    got = standardize_positions(df, ["chrom", "strand"], "coord", "reads", window, radius, shrink).groupBy("corrected").sum("reads")
    assert {r[0]: r[1] for r in got.collect()} == want


def test_bins_do_not_show(spark):
    rng = random.Random(3)
    rows = [("c", 65536 * rng.randrange(4) + rng.randrange(-12, 12), rng.randrange(1, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "chrom string, coord long, reads long")
    weight = {}
    for _, c, n in rows:
        weight[c] = weight.get(c, 0) + n
    want = {(c, w, all(w >= weight.get(c + d, 0) for d in range(-4, 5))) for c, w in weight.items()}
    assert {(r.coord, r.w, r.anchor) for r in local_maxima(df, ["chrom"], "coord", "reads", 4).collect()} == want


def test_nulls_and_gate(spark):
    df = spark.createDataFrame([("a", 1, 5, "r1"), ("a", 2, 1, "r1"), ("b", 1, 5, "r1"), ("b", 2, 1, "r2"), (None, 1, 1, "r"), ("b", None, 1, "r3")], "posid string, coord long, reads long, readid string")
    got = {(r.posid, r.coord): r.corrected for r in standardize_breakpoints(df, ["posid"], "coord", "reads", "readid").collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("b", 1): 1, ("b", 2): 1, (None, 1): 1, ("b", None): None}
    assert standardize_positions(df.limit(0), ["posid"], "coord", "reads").count() == 0
