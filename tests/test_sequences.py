import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitewright.operators import sequences as sq
from sitewright.plans import stages
from sitewright.session import Workspace


def test_barcodes(spark):
    rng = random.Random(2)
    codes = ["".join(rng.choice("ACGT") for _ in range(12)) for _ in range(30)]
    seqs = [c[:i] + rng.choice("ACGTN") + c[i + 1 :] for c in codes for i in (0, 5, 6, 11)] + ["A" * 12, None, "ACGT"]
    seqs += [s[:3] + "N" + s[4:] for s in seqs[:40]]
    reads = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id int, s string")
    sheet = spark.createDataFrame([(c,) for c in codes], "b string")
    for most in (0, 1, 2):
        want = {(s, c, d) for s in set(seqs) if s and len(s) == 12 for c in codes for d in [sum(x != y for x, y in zip(s, c))] if d <= most}
        assert {tuple(r) for r in sq.match_barcodes(reads, "s", sheet, "b", most).collect()} == want
    got = {r.id: r.b for r in sq.assign_reads(reads, "id", "s", sheet, "b").collect()}
    assert got == {i: m[0] for i, s in enumerate(seqs) if s and len(s) == 12 for m in [[c for c in codes if sum(x != y for x, y in zip(s, c)) <= 1]] if len(m) == 1}


def slow_trim(q, least=10, events=2, half=3):
    for i in range(len(q)):
        window = [q[min(max(j, 0), len(q) - 1)] for j in range(i - half, i + half + 1)]
        if sum(ord(c) - 33 <= least for c in window) >= events:
            return i
    return len(q)


def test_quality_trim(spark):
    rng = random.Random(4)
    qs = ["".join(rng.choice("+IIIIIII") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", "+", "I", "++", None]
    assert list(sq.trim_lengths(pa.array(qs))) == [slow_trim(q or "") for q in qs]
    df = spark.createDataFrame([("ACGTACGTAC", "IIIIIII++I"), (None, None)], "s string, q string")
    assert {tuple(r) for r in sq.quality_trim(df, "s", "q").collect()} == {("ACGTA", "IIIII"), (None, None)}


def test_golay(spark):
    column, error = sq.golay_tables()
    assert (error >= 0).sum() == 2325
    bits = {b: s for s, b in sq.GOLAY_BITS.items() if s != "N"}
    rng = random.Random(1)
    parity = [[int(x) for x in row] for row in sq.GOLAY_PARITY]
    rows = []
    for _ in range(60):
        info = [rng.randrange(2) for _ in range(12)]
        word = [sum(info[i] * parity[i][j] for i in range(12)) % 2 for j in range(12)] + info
        name = lambda w: "".join(bits[w[k], w[k + 1]] for k in range(0, 24, 2))
        for flips, fixed in ((0, True), (3, True), (4, False)):
            noisy = list(word)
            for k in rng.sample(range(24), flips):
                noisy[k] ^= 1
            rows.append((name(noisy), name(word) if fixed else None))
    rows += [(None, None), ("ACGT", None), ("ACGTACGTACGX", None), ("", None)]
    df = spark.createDataFrame(rows, "barcode string, want string")
    assert [r for r in sq.golay_correct(df, "barcode").collect() if r.want != r.corrected] == []


def test_row_numbers(spark):
    rng = random.Random(1)
    values = [rng.randrange(50) for _ in range(500)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(7)
    got = sq.global_row_number(df, [F.col("v"), F.col("i")], Workspace(spark, "t")).collect()
    assert [(r.v, r.i) for r in sorted(got, key=lambda r: r.row_number)] == sorted((v, i) for i, v in enumerate(values)) and sorted(r.row_number for r in got) == list(range(1, 501))


def test_consensus(spark):
    df = spark.createDataFrame([("AC",), ("AG",), ("TT",), ("TN",), ("",), (None,)], "seq string")
    got = {(r.bin, r.position): (r.base, r.agreement) for r in sq.binned_consensus(df, "seq", 2, 1, 3, Workspace(spark, "t")).collect()}
    assert got == {(1, 1): ("A", 1.0), (1, 2): ("C", 0.5), (2, 1): ("T", 1.0), (2, 2): ("T", 0.5)}
    assert sq.binned_consensus(df.limit(0), "seq", 2, 1, 3, Workspace(spark, "t")).count() == 0


def test_demultiplex(spark):
    linker = ("ACGTAC", "NNNNNN", "GGATCC")
    sheet = spark.createDataFrame([("T", "S", "a", 1, "AAAACCCCGGGG", "".join(linker), "hg38", "h.hmm", "v.fa", "U5"), ("T", "S", "b", 1, "TTTTCCCCGGGG", "".join(linker), "hg38", "h.hmm", "v.fa", "U5")], "trial string, subject string, sample string, replicate int, index1seq string, adriftreadlinkerseq string, refgenome string, leaderseqhmm string, vectorfastafile string, mode string")
    body = "TTGCATTGCATTGCATTGCA"
    r1 = lambda l1="ACGTAC", umi="TTTTTT", l2="GGATCC": l1 + umi + l2 + body
    reads = [("AAAACCCCGGGG", r1(), body), ("AAAACCCCGGGT", r1(umi="CCCCCC"), body), ("TTTTCCCCGGGG", r1(), body), ("AATTCCCCGGGG", r1(), body), ("AAAACCCCGGGG", r1(l1="CCGTAA"), body), ("AAAACCCCGGGG", r1(l2="GGATCA") + "GGGGGAGGGGGACT", body), ("AAAACCCCGGGG", r1()[:12], body), ("AAAACCCCGGGG", None, None)]
    rows = [(i, f"r{i}", i1, a, "I" * len(a or ""), b, "I" * len(b or "")) for i, (i1, a, b) in enumerate(reads)]
    df = spark.createDataFrame(rows, "rec_idx long, readid string, i1 string, r1 string, q1 string, r2 string, q2 string")
    got = {(r["sample"], r.umi, r.adriftreadseq): (r.n_reads, r.readid) for r in stages.demultiplex(df, sheet).collect()}
    assert got == {("a", "A" * 12, body): (3, "r0"), ("b", "A" * 12, body): (1, "r2")}
    kept = stages.demultiplex(df, sheet, stages.DemultiplexOptions(capture_umis=True))
    assert {(r["sample"], r.umi): r.n_reads for r in kept.collect()} == {("a", "TTTTTT"): 2, ("a", "CCCCCC"): 1, ("b", "TTTTTT"): 1}
    assert {r["sample"]: r.demultiplexed_reads for r in stages.sample_report(sheet, kept).collect()} == {"a": 3, "b": 1}


@pytest.mark.parametrize(("anchor", "end", "radius", "want"), [("GGGGCAGGGG", 6, 1, 6), ("GGGGGCAGGG", 6, 1, 7), ("CAGGGGGGGG", 1, 3, 2), ("GGGGGGGGGG", 5, 2, None)])
def test_terminal_motif(spark, anchor, end, radius, want):
    df = spark.createDataFrame([(anchor, end, "CA", radius)], "a string, e int, m string, r int")
    assert df.select(stages.terminal_motif(*map(F.col, "aemr")).alias("x")).first().x == want


def test_reads_to_sites(spark):
    align = "readid string, chrom string, strand string, start int, end int, n_reads long, subject string, sample string, replicate int"
    anchors, adrift = [], []
    for i, (pos, stop, n) in enumerate([(1000, 1100, 50), (1002, 1100, 3), (1000, 1150, 20), (1000, 1151, 2)]):
        anchors.append((f"r{i}", "chr1", "+", pos, pos + 29, n, "P", "S", 1))
        adrift.append((f"r{i}", "chr1", "-", stop - 29, stop))
    sites = stages.reads_to_sites(spark.createDataFrame(anchors, align), spark.createDataFrame(adrift, "readid string, chrom string, strand string, start int, end int"), ["subject"], ["sample"]).collect()
    assert [(r.posid, r.reads, r.sonic_lengths, r.percent_rel_abund) for r in sites] == [("chr1+1000", 75, 2, 100.0)]


def test_hmm_gate_and_vector_filter(spark):
    hits = spark.createDataFrame([("r1", "h", 1, 20, "+", 12.0, 20), ("r2", "h", 5, 20, "+", 12.0, 20), ("r3", "h", 1, 20, "-", 12.0, 20), ("r4", "h", 1, 20, "+", 12.0, 15), ("r5", "x", 1, 20, "+", 12.0, 20)], "targetName string, queryName string, targetStart int, targetEnd int, strand string, fullScore double, hmmEnd int")
    limits = spark.createDataFrame([("h", 1, 3, 5.0, 20.0, True, 1, 20)], "queryName string, minStart int, maxStart int, minScore double, maxScore double, matchEnd boolean, endRadius int, hmmLength int")
    assert [r.targetName for r in stages.hmm_gate(hits, limits).collect()] == ["r1"]
    reads = spark.createDataFrame([("a", "CCCC" + "ACGTA"), ("b", "GGGG" + "TTTTT"), ("c", "AC"), ("d", None)], "readid string, anchorreadseq string")
    found = spark.createDataFrame([("ACGTA", 95.0, 1, 5), ("TTTTT", 95.0, 1, 2), ("TTTTT", 50.0, 1, 5)], "qseqid string, pident double, qstart int, qend int")
    clean, vector = stages.vector_filter(reads, found, 5)
    assert {r.readid for r in clean.collect()} == {"b", "c", "d"} and {r.readid for r in vector.collect()} == {"a"}
    split = stages.split_leader(reads.withColumn("end", F.lit(4)), "end")
    assert {tuple(r) for r in split.select("readid", "leaderseq", "anchorreadseq").collect()} == {("a", "CCCC", "ACGTA"), ("b", "GGGG", "TTTTT")}


def test_consensus_covers_whole_sequences(spark, sf):
    from sitewright.plans.site_queries import sequence_consensus
    from sitewright.session import table

    seqs = [r.leaderseq.strip().upper() for r in table(spark, sf, "known_sites").where("leaderseq is not null").select("leaderseq").collect()]
    seqs = sorted((x for x in seqs if x), key=lambda x: (x[:20], x))
    votes = {}
    for i, x in enumerate(seqs, 1):
        for at, base in enumerate(x, 1):
            cell = votes.setdefault((-(-i * 50 // len(seqs)), at), {})
            cell[base] = cell.get(base, 0) + 1
    want = {k: max((n, -ord(b)) for b, n in c.items() if b in "ACGT") if set(c) & set("ACGT") else None for k, c in votes.items()}
    got = {(r.bin, r.position): (r.base, r.agreement) for r in sequence_consensus(spark, sf).collect()}
    assert got.keys() == want.keys() and max(p for _, p in got) == max(map(len, seqs)) > 60
    for k, best in want.items():
        assert got[k] == ((chr(-best[1]), round(best[0] / sum(votes[k].values()), 6)) if best else (None, None))


@pytest.mark.parametrize("overhang", [False, True])
def test_patterns_anywhere(spark, overhang):
    rng = random.Random(5)
    reads = ["".join(rng.choice("AC") for _ in range(rng.randrange(0, 14))) for _ in range(60)]
    patterns = ["ACCA", "AACCAAC", "CCC"]
    want = set()
    for most in (0, 1):
        want = set()
        for r in set(reads):
            for p in patterns:
                pad = most if overhang else 0
                t = "." * pad + r + "." * pad
                for at in range(len(t) - len(p) + 1):
                    n = sum(x != y for x, y in zip(t[at:], p))
                    if n <= most:
                        want.add((r, p, at + 1 - pad, n))
                        break
        df = spark.createDataFrame([(r,) for r in reads] + [(None,)], "s string")
        got = sq.match_anywhere(df, "s", spark.createDataFrame([(p,) for p in patterns], "p string"), "p", most, overhang)
        assert {tuple(r) for r in got.collect()} == want


def test_barcodes_of_several_lengths(spark):
    sheet = spark.createDataFrame([("ACGTA",), ("ACGTACG",), ("A",)], "b string")
    reads = spark.createDataFrame([(1, "ACGTT"), (2, "ACGTACC"), (3, "ACGTAC"), (4, "C"), (5, None)], "id int, s string")
    assert {(r.id, r.b) for r in sq.assign_reads(reads, "id", "s", sheet, "b").collect()} == {(1, "ACGTA"), (2, "ACGTACG"), (4, "A")}
