import random

import pytest

from sitewright.functions.genome import parsed_position, psl_percent_identity, psl_score, revcomp
from sitewright.operators.fragments import anchor_competition, build_fragments, dominant_umis, rescue_reads, shortest_fragment
from sitewright.operators.rangejoin import band_join, nearest_join, overlap_join
from sitewright.operators.rollup import dominant_class, site_rollup, whole_percentages
from sitewright.operators.sites import annotate_nearest, annotate_repeats, dual_detections
from sitewright.session import Workspace
from pyspark.sql import functions as F

ALIGNED = "readid string, chrom string, strand string, start int, end int"


def test_fragments(spark):
    anchors = spark.createDataFrame([("A", "chr1", "+", 100, 129), ("B", "chr1", "-", 300, 329), ("C", "chr1", "+", 100, 129), ("D", "chr1", "+", 100, 129), ("E", "chr1", "+", 400, 409), ("F", "chr1", "+", 500, 529), ("G", "chr2", "+", 1000, 1029), ("G", "chr3", "+", 2000, 2029), ("H", "chr1", "+", 100, 129), (None, "chr1", "+", 1, 2)], ALIGNED)
    adrift = spark.createDataFrame([("A", "chr1", "-", 170, 199), ("B", "chr1", "+", 250, 279), ("C", "chr2", "-", 170, 199), ("D", "chr1", "+", 170, 199), ("E", "chr1", "-", 410, 420), ("F", "chr1", "-", 200000, 200029), ("G", "chr2", "-", 1070, 1099), ("G", "chr3", "-", 2070, 2099), (None, "chr1", "-", 1, 90)], ALIGNED)
    got = {(r.readid, r.chrom, r.strand, r.frag_start, r.frag_end) for r in build_fragments(anchors, adrift).collect()}
    assert got == {("A", "chr1", "+", 100, 199), ("B", "chr1", "-", 250, 329), ("G", "chr2", "+", 1000, 1099), ("G", "chr3", "+", 2000, 2099)}


def test_dual_detection(spark):
    rows = [(s, "chr1", st, p, m, "ACGT", n, rep, 101) for s, m, rep, st, p, n in [("D1", "U5", 1, "-", 104, 8), ("D1", "U3", 5, "+", 100, 4), ("D10", "U5", 1, "-", 104, 2), ("D10", "U3", 5, "+", 100, 1), ("D2", "U5", 1, "-", 104, 2), ("D2", "U3", 1, "+", 100, 2), ("D2", "U3", 1, "+", 101, 2)]]
    df = spark.createDataFrame(rows, "sample string, chrom string, strand string, pos long, mode string, leader string, reads long, replicate int, width long")
    got = {(r.sample, r.chrom, r.strand, r.pos, r.leader, r.reads, r.sonic_lengths) for r in dual_detections(df, ["sample"]).collect()}
    assert got == {("D1", "chr1", "-", 102, "ACGT/ACGT", 12, 2), ("D10", "chr1", "-", 102, "ACGT/ACGT", 3, 2)}


def test_sonic_lengths(spark):
    df = spark.createDataFrame([("s", r, w, 1) for r, w in [(1, 100), (1, 120), (2, 100), (2, 140), (2, 160)]], "site string, replicate int, width int, reads int")
    r = site_rollup(df, ["site"], "replicate", "width", "reads").first()
    assert (r.reads, r.sonic_lengths, r.n_reps_obs, r.sonic_lengths_sample) == (5, 5, 2, 4)


def test_annotation(spark):
    tu = spark.createDataFrame([("gA", "chr1", 100, 200, "+", "GENE_A"), ("gA", "chr1", 400, 450, "-", "GENE_B"), ("gB", "chr1", 600, 700, "+", "GENE_C")], "genome string, chrom string, start int, end int, strand string, gene string")
    exon = spark.createDataFrame([("gA", "chr1", 110, 120), ("gA", "chr1", 180, 190), ("gA", "chr1", 410, 420)], "genome string, chrom string, start int, end int")
    reps = spark.createDataFrame([("gA", "chr1", 105, 115, 1, "AluY", "SINE/Alu"), ("gA", "chr1", 105, 115, 2, "AT_rich", "Simple_repeat"), ("gA", "chr1", 400, 430, 3, "L1HS", "LINE/L1"), ("gB", "chr1", 490, 510, 4, "ERVK", "LTR/ERVK")], "genome string, chrom string, start int, end int, ord int, name string, class string")
    sites = spark.createDataFrame([("gA", "chr1", 110), ("gA", "chr1", 250), ("gA", "chr1", 425), ("gB", "chr1", 500), ("gB", "chr9", 5)], "genome string, chrom string, pos int")
    got = {(r.genome, r.chrom, r.pos): (r.nearest_gene, r.nearest_dist, r.in_gene, r.in_exon) for r in annotate_nearest(sites, tu, exon, ["genome", "chrom"]).collect()}
    assert got == {("gA", "chr1", 110): ("GENE_A", 0, True, True), ("gA", "chr1", 250): ("GENE_A", 50, False, False), ("gA", "chr1", 425): ("GENE_B", 0, True, False), ("gB", "chr1", 500): ("GENE_C", 100, False, False), ("gB", "chr9", 5): (None, None, False, False)}
    got = {r.pos: (r.repeat_name, r.repeat_class) for r in annotate_repeats(sites, reps, ["genome", "chrom"]).collect()}
    assert got == {110: ("AluY,AT_rich", "SINE/Alu,Simple_repeat"), 250: (None, None), 425: ("L1HS", "LINE/L1"), 500: ("ERVK", "LTR/ERVK"), 5: (None, None)}


def test_dominant_class(spark):
    rows = [("MHC.1", "a", "SINE/Alu"), ("MHC.1", "a", "Simple"), ("MHC.1", "b", None), ("MHC.1", "c", "LINE"), ("MHC.2", "a", "SINE/Alu"), ("MHC.2", "b", "SINE/Alu"), ("MHC.2", "b", "Simple"), ("MHC.2", "a", "SINE/Alu")]
    got = {r.cluster: (r.dominant_class, r.dominant_percent, r.tied_classes) for r in dominant_class(spark.createDataFrame(rows, "cluster string, posid string, class string"), ["cluster"], "posid", "class").collect()}
    assert got == {"MHC.1": ("tie", 33.33, "LINE,SINE/Alu,Simple,none"), "MHC.2": ("SINE/Alu", 100.0, None)}


@pytest.mark.parametrize("seed", [1, 2])
def test_range_joins_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    pts = [(rng.choice("ab"), rng.randrange(-500, 3000)) for _ in range(150)] + [("z", 5), ("a", None)]
    ivs = [(rng.choice("ab"), s, s + rng.choice([0, 3, 40, 900])) for s in (rng.randrange(-300, 2500) for _ in range(40))] + [("a", 100, 50)]
    p = spark.createDataFrame(pts, "k string, pos long")
    i = spark.createDataFrame(ivs, "k string, s long, e long")
    inside = sorted((k, x, s, e) for k, x in pts for q, s, e in ivs if k == q and x is not None and s <= x <= e)
    assert sorted(map(tuple, overlap_join(p, i, ["k"], "pos", "s", "e", 64).collect())) == inside
    dist = lambda x, s, e: max(s - x, x - e, 0)
    want = []
    for k, x in {t for t in pts if t[1] is not None}:
        own = [(s, e) for q, s, e in ivs if q == k and s <= e]
        best = min((dist(x, *t) for t in own), default=None)
        want += [(k, x, best, s, e) for s, e in own if dist(x, s, e) == best]
    assert sorted(map(tuple, nearest_join(p, i, ["k"], "pos", "s", "e", 128).collect())) == sorted(want)
    other = spark.createDataFrame([(k, x) for k, x in pts if k == "a"], "k string, q long")
    want = sorted((k, x, y) for k, x in pts for c, y in pts if k == c == "a" and x is not None and y is not None and abs(x - y) <= 7)
    assert sorted(map(tuple, band_join(p, other, ["k"], "pos", "q", 7).collect())) == want


def test_rescue(spark):
    rows = [("u1", "p1"), ("u2", "p2"), ("m1", "p1"), ("m1", "p9"), ("m2", "p1"), ("m2", "p2"), ("m3", "p8"), ("m3", "p9")]
    df = spark.createDataFrame([(r, p, "s") for r, p in rows], "readid string, posid string, subject string")
    assert [tuple(r) for r in rescue_reads(df, "readid", "posid", ["subject"]).collect()] == [("m1", "s", "p1")]


def test_competition(spark):
    rows = [("frag", "a", i, i + 50) for i in range(7)] + [("frag", "b", 1, 2)] + [("read", "a", 1, 2)] * 20 + [("read", "b", 1, 2)] * 2 + [("none", "a", 1, 2), ("none", "b", 1, 2), ("one", "a", 1, 2)]
    got = {r.cluster: (r.decision, r.posid) for r in anchor_competition(spark.createDataFrame(rows, "cluster string, posid string, start int, end int"), ["cluster"], ["posid"], "start", "end").collect()}
    assert got == {"frag": ("fragments", "a"), "read": ("reads", "a"), "none": ("removed", None), "one": ("single", "a")}


def test_umis(spark):
    rows = [("few", u, i) for i, u in enumerate("AAB")] + [("split", u, 100 + i) for i, u in enumerate("A" * 6 + "B" * 5 + "C")] + [("one", "T", 500)]
    df = spark.createDataFrame([(f, u, i, str(i)) for f, u, i in rows], "frag string, umi string, rec int, readid string")
    got = {}
    for r in dominant_umis(df, ["frag"], "umi", "rec", "readid", Workspace(spark, "t")).collect():
        got.setdefault(r.frag, []).append((r.rec, r.umi))
    assert {f: "".join(u for _, u in sorted(x)) for f, x in got.items()} == {"few": "AAA", "split": "A" * 7 + "B" * 5, "one": "T"}


def test_shortest_and_percentages(spark):
    df = spark.createDataFrame([("k", 5, 9), ("k", 1, 4), ("k", 3, 6), ("q", None, 1)], "k string, s int, e int")
    assert {tuple(r) for r in shortest_fragment(df, ["k"], F.col("e") - F.col("s"), "s").collect()} == {("k", 1, 4), ("q", None, 1)}
    counts = spark.createDataFrame([("g", "a", 1), ("g", "b", 1), ("g", "c", 1)], "g string, l string, n long")
    assert sorted(r.percent for r in whole_percentages(counts, ["g"], "l", "n").collect()) == [33, 33, 34]


def test_scalars(spark):
    r = spark.createDataFrame([("ACGTN", "chr1-42")], "s string, p string").select(revcomp(F.col("s")).alias("rc"), *[parsed_position(F.col("p"))[n] for n in ("chrom", "strand", "pos")], psl_score(F.lit(30), F.lit(2), F.lit(5), F.lit(1), F.lit(0)).alias("score"), psl_percent_identity(F.lit(90), F.lit(5), F.lit(0), F.lit(1), F.lit(97), F.lit(95)).alias("pid")).first()
    assert tuple(r) == ("NACGT", "chr1", "-", 42, 29, 90.6)
