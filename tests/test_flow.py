import random

import pytest
from pyspark.sql import functions as F

from sitewright.functions.genome import revcomp
from sitewright.operators.rollup import fragment_members, fragment_rollup
from sitewright.operators.sequences import last_match, orientation_vote
from sitewright.operators.sites import label_duals, orient_sites
from sitewright.plans import stages
from sitewright.session import Workspace
from sitewright.sources.lake import merge_heads, missing_updates, nearest_names

FRAGS = "trial string, subject string, sample string, refgenome string, mode string, leaderseqhmm string, vectorfastafile string, chrom string, strand string, pos long, replicate int, width long, reads long, umi string, leader string"


def _frag(sample, mode, replicate, strand, pos, reads, umi="A" * 12, leader="ACGTACGT", chrom="chr1", width=101):
    return ("LOD", "CLONE", sample, "hs1", mode, "h.hmm", "v.fa", chrom, strand, pos, replicate, width, reads, umi, leader)


# The documented worked example of dual detection.
DUAL_ROWS = [_frag("DILUTION_1", "U5", 1, "-", 104, 8), _frag("DILUTION_1", "U3", 5, "+", 100, 4), _frag("DILUTION_10", "U5", 1, "-", 104, 2), _frag("DILUTION_10", "U3", 5, "+", 100, 1)]


def test_sites_with_dual_detection(spark):
    df = spark.createDataFrame(DUAL_ROWS, FRAGS)
    got = {r["sample"]: r for r in stages.build_sites(df, Workspace(spark, "t")).collect()}
    assert {s: (r["mode"], r.posid, r.reads, r.sonic_lengths, r.sonic_lengths_sample, r.n_reps_obs, r.umis, r.percent_rel_abund) for s, r in got.items()} == {
        "DILUTION_1": ("dual detect", "chr1-102", 12, 2, 1, None, None, 100.0),
        "DILUTION_10": ("dual detect", "chr1-102", 3, 2, 1, None, None, 100.0),
    }
    r = got["DILUTION_1"]
    assert (r.rep1_reads, r.rep5_reads, r.rep2_reads, r.rep1_umis, r.rep5_rep_leader, r.rep_leader, r.leaderseqhmm) == (8, 4, None, None, "ACGTACGT/ACGTACGT", "ACGTACGT/ACGTACGT", "h.hmm")
    plain = stages.build_sites(df, Workspace(spark, "t"), duals=False, orient=False).collect()
    assert {(r["sample"], r["mode"], r.posid) for r in plain} == {(s, m, p) for s in ("DILUTION_1", "DILUTION_10") for m, p in (("U5", "chr1-104"), ("U3", "chr1+100"))}


def test_sites_keep_ambiguous_ends_and_count_umis(spark):
    rows = [_frag("D2", "U5", 1, "-", 104, 2, "C" * 12), _frag("D2", "U3", 1, "+", 100, 2), _frag("D2", "U3", 2, "+", 101, 2, None, None), _frag("D2", "AAV", 1, "+", 500, 1), _frag("D2", "U5", 1, "-", None, 2), (None, *_frag("D2", "U5", 1, "-", 104, 2)[1:])]
    got = {(r["mode"], r.posid): (r.reads, r.umis, r.rep1_umis, r.n_reps_obs, r.rep_leader, r.percent_rel_abund) for r in stages.build_sites(spark.createDataFrame(rows * 2, FRAGS), Workspace(spark, "t")).collect()}
    assert got == {("U5", "chr1-102"): (4, 1, 1, 1, "ACGTACGT", 33.33), ("U3", "chr1-102"): (4, 1, 1, 1, "ACGTACGT", 33.33), ("U3", "chr1-103"): (4, 0, None, 1, None, 33.33)}
    assert stages.build_sites(spark.createDataFrame([], FRAGS), Workspace(spark, "t")).count() == 0


def test_labels_lose_no_row(spark):
    rng = random.Random(3)
    rows = [_frag(rng.choice("ab"), rng.choice(["U3", "U5", "AAV", None]), rng.randrange(3), rng.choice(["+", "-", None]), rng.choice([None, *range(100, 400, 7)]), 1) for _ in range(200)]
    df = spark.createDataFrame(rows, FRAGS).withColumn("_at", F.lit("extra"))
    out = label_duals(df, ["sample"], 3)
    assert out.columns == df.columns and out.count() == 200
    only = spark.createDataFrame([("AAV", "+", 5), (None, "-", 7)], "mode string, strand string, pos long")
    assert {tuple(r) for r in orient_sites(only).collect()} == {("AAV", "+", 5), (None, "-", 7)}
    mixed = only.unionByName(spark.createDataFrame([("U3", "+", 5), ("U5", "-", 7), ("dual detect", "-", 9)], only.schema))
    assert {tuple(r) for r in orient_sites(mixed).collect()} == {("U3", "-", 7), ("U5", "-", 5), ("dual detect", "-", 9)}


@pytest.mark.parametrize("overhang", [False, True])
@pytest.mark.parametrize("most", [0, 1, 2])
def test_last_match_agrees_with_a_loop(spark, overhang, most):
    rng = random.Random(most)
    word = lambda n: "".join(rng.choice("AC") for _ in range(n))
    rows = [(word(rng.randrange(0, 15)), word(rng.randrange(0, 6))) for _ in range(150)] + [(None, "AC"), ("ACAC", None), ("", ""), ("ACGT" * 500 + "TTTTTT", "TTTTTT")]

    def slow(text, probe):
        if not text or not probe:
            text, probe = text or "", probe or ""
        padded = text + "\0" * (most if overhang else 0)
        hits = [p + 1 for p in range(len(padded) - len(probe) + 1) if sum(a != b for a, b in zip(padded[p : p + len(probe)], probe)) <= most]
        return max(hits, default=0) if probe else 0

    df = spark.createDataFrame(rows, "s string, p string")
    got = df.select("s", "p", last_match(F.col("s"), F.col("p"), most, overhang).alias("at")).collect()
    assert [r["at"] for r in got] == [slow(r.s, r.p) for r in got]


def test_overread(spark):
    body, adapter, leader = "GATTACACCATTGACCAGTATTGACCATGA", "CTCCGCTTAAGGGACT", "TCTGGCTAACTAGGGAACC"
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("both", body + turned(adapter), body + turned(leader)), ("none", body + "AA", body), ("short", body[:20] + turned(adapter), body), ("first", turned(adapter)[:8] + body, body)]
    df = spark.createDataFrame([(i, a, b, adapter, leader) for i, a, b in rows], "readid string, anchorreadseq string, adriftreadseq string, linker2 string, leaderseq string")
    got = {r.readid: (r.anchorreadseq, r.adriftreadseq) for r in stages.trim_overread(df).collect()}
    assert got == {"both": (body, body), "none": (body + "AA", body), "first": (turned(adapter)[:8] + body, body)}
    with pytest.raises(Exception, match="over-read trimming needs"):
        stages.trim_overread(df.withColumn("linker2", F.lit(None).cast("string"))).collect()
    assert stages.trim_overread(df.withColumn("linker2", F.lit("ACG")).where("readid = 'x'")).count() == 0


def test_demultiplex_options(spark):
    sheet_schema = "trial string, subject string, sample string, replicate int, index1seq string, adriftreadlinkerseq string, refgenome string, leaderseqhmm string, vectorfastafile string, mode string"
    sheet = spark.createDataFrame([("T", "S", "umi", 1, "AAAACCCCGGGG", "ACGTACNNNNNNGGATCC", "hg38", "h", "v", "U5"), ("T", "S", "plain", 1, "TTTTCCCCGGTA", "ACGTACGGATCC", "hg38", "h", "v", "U5")], sheet_schema)
    body = "TTGCATTGCATTGCATTGCA"
    rows = [(0, "r0", "AAAACCCCGGGG", "ACGTACTTTTTTGGATCC" + body), (1, "r1", "AAAACCCCGGGG", "ACGTACCCCCCCGGATCC" + body), (2, "r2", "TTTTCCCCGGTA", "ACGTACGGATCC" + body), (3, "r3", "TTTTCCCCGGTA", "TTTTACGGATCC" + body)]
    df = spark.createDataFrame([(i, n, x, a, "I" * len(a), body, "I" * len(body)) for i, n, x, a in rows], "rec_idx long, readid string, i1 string, r1 string, q1 string, r2 string, q2 string")
    kept = lambda **o: {(r["sample"], r.readid): (r.umi, r.linker1, r.linker2, r.n_reads) for r in stages.demultiplex(df, sheet, stages.DemultiplexOptions(**o)).collect()}
    assert kept() == {("umi", "r0"): ("A" * 12, "ACGTAC", "GGATCC", 2), ("plain", "r2"): ("A" * 12, "ACGTACGGATCC", None, 1)}
    single = kept(collapse=False, capture_umis=True)
    assert single == {("umi", "r0"): ("TTTTTT", "ACGTAC", "GGATCC", 1), ("umi", "r1"): ("CCCCCC", "ACGTAC", "GGATCC", 1), ("plain", "r2"): (None, "ACGTACGGATCC", None, 1)}
    assert ("plain", "r3") in kept(adrift_linkers=False, collapse=False)
    turned = df.withColumn("i1", revcomp(F.col("i1")))
    assert stages.demultiplex(turned, sheet).count() == 0
    assert stages.demultiplex(turned, sheet, stages.DemultiplexOptions(auto_orientation=True)).count() == 2
    votes = orientation_vote(turned, "i1", sheet, "index1seq").first()
    assert (votes.n_forward, votes.n_reverse, votes.reverse) == (0, 4, True)
    assert orientation_vote(turned.limit(0), "i1", sheet, "index1seq").first().reverse is False


def test_golay_before_matching(spark):
    from sitewright.operators.sequences import golay_correct

    code = golay_correct(spark.createDataFrame([("AACCACCACCAC",)], "b string"), "b", "fixed")
    word = next((r.fixed for r in code.collect() if r.fixed), None) or golay_correct(spark.createDataFrame([("A" * 12,)], "b string"), "b", "fixed").first().fixed
    assert word is not None
    wrong = ("C" if word[0] != "C" else "A") + word[1:]
    sheet = spark.createDataFrame([("T", "S", "a", 1, word, "ACGTACNNNNNNGGATCC", "g", "h", "v", "U5")], "trial string, subject string, sample string, replicate int, index1seq string, adriftreadlinkerseq string, refgenome string, leaderseqhmm string, vectorfastafile string, mode string")
    body = "TTGCATTGCATTGCATTGCA"
    df = spark.createDataFrame([(0, "r", wrong, "ACGTACTTTTTTGGATCC" + body, "I" * 38, body, "I" * 20), (1, "s", "ACG", "ACGTACTTTTTTGGATCC" + body, "I" * 38, body, "I" * 20)], "rec_idx long, readid string, i1 string, r1 string, q1 string, r2 string, q2 string")
    strict = stages.DemultiplexOptions(index_mismatches=0)
    assert stages.demultiplex(df, sheet, strict).count() == 0
    assert [r.readid for r in stages.demultiplex(df, sheet, stages.DemultiplexOptions(index_mismatches=0, golay=True)).collect()] == ["r"]


def test_fragment_members_and_first_row(spark):
    df = spark.createDataFrame([("f", "r1", "U", 2, "L"), ("f", "r1", "U", 1, "L"), ("f", "r2", None, 1, "K"), (None, "r3", "V", 5, None)], "frag string, read string, umi string, n int, leader string")
    got = {tuple(r) for r in fragment_members(df, ["frag"], {"read": "read", "umi": "umi"}).collect()}
    assert got == {("f", "read", "r1", 2), ("f", "read", "r2", 1), ("f", "umi", "U", 2), (None, "read", "r3", 1), (None, "umi", "V", 1)}
    rolled = {r.frag: (r.reads, r.n_records, r.umi, r.rep_leader) for r in fragment_rollup(df, ["frag"], "n", "read", "leader", first=("umi",), order="read").collect()}
    assert rolled == {"f": (4, 3, "U", "L"), None: (5, 1, "V", None)}


def test_names_and_updates(spark):
    names = spark.createDataFrame([("hg38",), ("hs1",), ("mm10",), (None,)], "name string")
    values = spark.createDataFrame([("hg39",), ("hs1",), (None,), ("",)], "value string")
    got = [tuple(r) for r in nearest_names(values, "value", names, "name", 2).orderBy("value", "rank").collect()]
    assert got == [("", 1, "hs1", 3), ("", 2, "hg38", 4), ("hg39", 1, "hg38", 1), ("hg39", 2, "hs1", 3)]
    assert nearest_names(values, "value", names.limit(0), "name").count() == 0
    key = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2)], "s string, r int")
    assert [tuple(r) for r in missing_updates(key, key.where("r = 1"), ["s", "r"]).collect()] == [("a", 2)]
    a, b = {"id": "run_a", "rows": 1}, {"id": "run_b", "rows": 2}
    assert merge_heads([b, a, dict(b)]) == ["run_b", "run_a"]
    with pytest.raises(ValueError, match="run_a"):
        merge_heads([a, {"id": "run_a", "rows": 9}])
