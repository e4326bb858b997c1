import gzip

import pytest
from pyspark.sql import functions as F

from sitewright.functions import genome
from sitewright.operators.rollup import display_range
from sitewright.operators.sheet_parser import sheet_report
from sitewright.operators.sites import recovery_metrics
from sitewright.plans import stages
from sitewright.session import Workspace
from sitewright.sources import lake, readers
from sitewright.streaming.history import stream_fragments


def put(path, text):
    path.write_text(text)
    return str(path)


def test_fastq(spark, tmp_path):
    records = [(f"r{i}", "ACGT" * (i % 5 + 1)) for i in range(3000)]
    text = lambda tag: "".join(f"@{n} {tag}\n{s}\n+\n{'@' * len(s)}\n" for n, s in records)
    plain = put(tmp_path / "r1.fastq", text("1:N"))
    with gzip.open(tmp_path / "r2.fastq.gz", "wt") as f:
        f.write(text("2:N"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.rec_idx: (r.readid, r.seq, len(r.quality)) for r in readers.read_fastq(spark, plain).collect()}
        assert got == {i: (n, s, len(s)) for i, (n, s) in enumerate(records)}
        both = readers.read_fastq_triplet(spark, plain, str(tmp_path / "r2.fastq.gz"), plain)
        assert both.count() == 3000 and both.where("rec_idx = 7").first().readid == "r7"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    bad = put(tmp_path / "bad.fastq", text("x").replace("@r5 ", "@q5 "))
    with pytest.raises(Exception, match="read ids differ"):
        readers.read_fastq_triplet(spark, plain, bad, plain).collect()
    with pytest.raises(Exception, match="broken record"):
        readers.read_fastq(spark, put(tmp_path / "short.fastq", "@a\nACG\n+\nII\n")).collect()


def test_alignments(spark, tmp_path):
    psl = put(tmp_path / "a.psl", "\t".join(map(str, [30, 1, 0, 0, 0, 0, 0, 0, "+", "q1", 31, 0, 31, "chr1", 1000, 99, 130, 1, "31,", "0,", "99,"])) + "\n")
    r = readers.read_psl(spark, psl).first()
    assert (r.qStart, r.tStart, r.qWidth, r.tWidth) == (1, 100, 31, 31)
    tbl = put(tmp_path / "a.tbl", "# head\nread1 - hmm1 - 1 20 3 22 1 25 100 + 1e-5 12.5 0.1 -\nread1 - hmm1 - 1 20 3 22 1 25 100 + 1e-5 12.5 0.1 -\nread1 - hmm1 - 1 9 1 9 1 9 100 - 1 3.5 0 -\n")
    hits = readers.read_tblout(spark, tbl)
    assert hits.count() == 3
    best = readers.best_hits(hits, "targetName", "fullScore", "hmmStart").collect()
    assert len(best) == 1 and best[0].hmmEnd == 20 and best[0].fullScore == 12.5
    blast = put(tmp_path / "b.tsv", "\t".join(map(str, ["q", "v", 98.5, 25, 0, 0, 1, 25, 10, 34, 1e-9])) + "\n")
    assert readers.read_blast(spark, blast).first().pident == 98.5


def test_hmm_parameters(spark, tmp_path):
    put(tmp_path / "v.cfg", "HMMminStartPos\t1\nHMMmaxStartPos\t3\nHMMminFullBitScore\t-0.5\nHMMmaxFullBitScore\t10\nHMMmatchEnd\tTRUE\nHMMmatchTerminalSeq\tCA\nHMMmatchEndRadius\t1\n")
    put(tmp_path / "v.hmm", "HMMER3/f\nNAME  U5\nLENG  101\n")
    r = readers.read_hmm_parameters(spark, str(tmp_path)).first()
    assert (r.queryName, r.minStart, r.maxStart, r.minScore, r.maxScore, r.matchEnd, r.motif, r.endRadius, r.hmmLength) == ("v", 1, 3, -0.5, 10.0, True, "CA", 1, 101)
    put(tmp_path / "w.cfg", "HMMminStartPos\t5\nHMMmaxStartPos\t3\n")
    with pytest.raises(Exception, match="unusable parameters of profile w"):
        readers.read_hmm_parameters(spark, str(tmp_path)).collect()


def test_clusters(spark, tmp_path):
    path = put(tmp_path / "c.clstr", ">Cluster 0\n0\t30nt, >r1... *\n1\t30nt, >r2... at +/97.00%\n>Cluster 1\n0\t28nt, >r3... *\n>Cluster 2\n")
    assert {tuple(r) for r in readers.read_clusters(spark, path).collect()} == {(0, "r1", True, 2), (0, "r2", False, 2), (1, "r3", True, 1)}


def test_annotation(spark, tmp_path):
    good = ["1", "NM_1", "chr1", "+", "100", "500", "150", "400", "2", "100,300,", "200,500,", "0", "GENE", "cmpl", "cmpl", "0,0,"]
    bad = [*good[:9], "100,300,", "200,501,", *good[11:]]
    genes = readers.read_genepred(spark, put(tmp_path / "g.txt", "\n".join("\t".join(x) for x in (good, bad)) + "\n"))
    assert {tuple(r) for r in readers.transcripts(genes).collect()} == {("chr1", 101, 500, "+", "NM_1", "GENE")}
    assert {tuple(r) for r in readers.exons(genes).collect()} == {("chr1", 101, 200, "+", "exon 1", "GENE"), ("chr1", 301, 500, "+", "exon 2", "GENE")}
    ten, fifteen, short = good[1:11], good[1:], good[:9]
    bad_strand = [*good[:3], "*", *good[4:]]
    path = put(tmp_path / "mixed.txt", "\n".join("\t".join(x) for x in (ten, fifteen, short, bad, bad_strand)) + "\n\n")
    assert sorted((r.bin, r.name2 or "", r.score, r.txStart, r.exonEnds[-1]) for r in readers.read_genepred(spark, path).collect()) == [(None, "", 0, 100, 500), (None, "GENE", 0, 100, 500)]
    assert sorted(r.reason for r in readers.rejected_genepred(spark, path).collect()) == ["columns", "exons", "strand"]
    out = put(tmp_path / "r.out", "   SW  perc\nscore  div.\n\n  463   1.3  0.6  1.7  chr1  10001  10468 (249) C  AluY  SINE/Alu  (0) 471 1 1\n  3612 11.4 21.5 1.3 chr1 10469 11447 (248) ? TAR1 Satellite 399 1712 483 2\n")
    r = readers.read_repeats(spark, out).collect()
    assert len(r) == 1 and (r[0].strand, r[0].repeat_name, r[0].query_start) == ("-", "AluY", 10001)


def test_scope_replacement(spark, tmp_path):
    path = f"file://{tmp_path}/sites"
    row = lambda s, p: (s, "g 1/x", p)
    frame = lambda rows: spark.createDataFrame(rows, "sample string, genome string, posid string")
    scope = ["sample", "genome"]
    everything = frame([row("a", "1"), row("b", "2"), row("c", "3")])
    lake.replace_scope(spark, everything, everything.select(*scope).distinct(), path, scope)
    lake.replace_scope(spark, frame([row("a", "9")]), frame([row("a", ""), row("b", "")]).select(*scope), path, scope)
    got = {(r["sample"], r.genome, r.posid) for r in spark.read.schema("posid string, sample string, genome string").parquet(path).collect()}
    assert got == {row("a", "9"), row("c", "3")}
    for rows, groups in (([row("z", "1")], [row("a", "")]), ([], [row("a", ""), row("a", "")]), ([], [row(" ", "")])):
        with pytest.raises(ValueError):
            lake.replace_scope(spark, frame(rows), frame(groups).select(*scope), path, scope)
    run = lake.write_manifest(spark, path, "sites", {"window": 8, "dbPassword": "x"}, ["run_1"], 2)
    record = lake.read_manifest(spark, path)
    assert record["id"] == run and record["arguments"] == {"window": 8} and lake.read_manifest(spark, path + "none")["history"] == "unavailable"


def test_catalog(spark):
    new = spark.createDataFrame([("T", "s1"), ("T", "s2")], "trial string, sample string")
    key = ["trial", "sample"]
    catalog = lake.register_samples(new.limit(0), new, key)
    with pytest.raises(ValueError):
        lake.register_samples(catalog, new.select(F.lower("trial").alias("trial"), "sample"), key)
    counts = spark.createDataFrame([("T", "s1", 5)], "trial string, sample string, demultiplexed_reads long")
    once = lake.update_counts(catalog, counts, key)
    assert {tuple(r) for r in once.collect()} == {("T", "s1", 5), ("T", "s2", None)}
    with pytest.raises(Exception, match="set already"):
        lake.update_counts(once, counts, key).collect()


def test_stream(spark, tmp_path):
    schema = "subject string, fragid string, reads long"
    table, inbox = f"{tmp_path}/table", tmp_path / "in"

    def arrive(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(inbox))
        stream_fragments(spark, str(inbox), schema, table, f"{tmp_path}/cp", ["subject"], ["subject", "fragid"]).awaitTermination()
        return {(r.subject, r.fragid, r.reads) for r in spark.read.schema(schema).parquet(table).collect()}

    assert arrive(1, [("s", "a", 1), ("s", "b", 2), ("t", "c", 3)]) == {("s", "a", 1), ("s", "b", 2), ("t", "c", 3)}
    assert arrive(2, [("s", "b", 9), ("u", "d", 4)]) == {("s", "a", 1), ("s", "b", 9), ("t", "c", 3), ("u", "d", 4)}
    assert not list(tmp_path.glob("table_staged/*"))  # what was staged is removed


def test_chromosome_selection(spark):
    sizes = spark.createDataFrame([("chr1", 9), ("chr2", 8), ("chrUn_1", 1), (None, 2)], "chrom string, size int")
    listed = spark.createDataFrame([("chr2",), ("chr2",), (None,)], "chrom string")
    names = lambda df: sorted(r.chrom for r in df.collect())
    assert names(readers.select_chromosomes(sizes, "chrom", r"^chr\d+$")) == ["chr1", "chr2"] and readers.select_chromosomes(sizes, "chrom").count() == 4
    assert names(readers.select_chromosomes(sizes, "chrom", listed=listed)) == ["chr2"] and names(readers.select_chromosomes(sizes, "chrom", listed=listed.limit(0))) == []
    with pytest.raises(ValueError, match="chr2"):
        readers.select_chromosomes(sizes.where("size = 9"), "chrom", listed=listed)


def test_verified_write_and_tsv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 0.5)], "id int, t string, x double")
    path = f"file://{tmp_path}/t"
    assert lake.write_verified(df, path) == 3 and lake.write_verified(df.limit(0), path) == 0
    lake.write_tsv(df, path)
    back = spark.read.csv(path, sep="\t", header=True, schema="id int, t string, x double", nullValue="NA")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and all(str(f).endswith(".gz") for f in tmp_path.glob("t/part-*"))
    changing = df.withColumn("x", F.rand())  # another value each time would be another content
    assert lake.write_verified(changing, path) == 3


def test_translated_alignments(spark):
    row = spark.createDataFrame([("++", 10, 20, 5, 70, 100), ("+-", 10, 20, 30, 70, 100), ("+-", 10, 20, 29, 70, 100), ("+", 10, 20, 5, 70, 100)], "s string, b int, n int, ts int, te int, size int")
    factor = genome.psl_size_factor(*[F.col(c) for c in ("s", "b", "n", "ts", "te", "size")])
    n = F.lit
    rows = row.select(factor, genome.psl_score(n(20), n(1), n(4), n(1), n(2), factor), genome.psl_percent_identity(n(20), n(1), n(4), n(1), n(25), n(75), factor)).collect()
    assert [r[0] for r in rows] == [3, 3, 1, 1] and [r[1] for r in rows] == [60, 60, 18, 18]
    assert rows[0][2] == 94.7 and rows[3][2] == 92.0
    assert row.select(genome.psl_percent_identity(n(0), n(0), n(0), n(0), n(0), n(0))).first()[0] == 100


def test_profile_limits(spark):
    stats = spark.createDataFrame([("s", "p", 3), ("s", "q", 4), ("t", None, 1)], "sample string, leaderseqhmm string, reads int")
    limits = spark.createDataFrame([("p", 1), ("p", 2)], "queryName string, minStart int")
    assert {(r.sample, r.minStart) for r in stages.profile_limits(stats, limits).collect()} == {("s", 1), ("s", 2)}


def test_recovery_and_reports(spark, tmp_path):
    work = Workspace(spark, "recovery", f"file://{tmp_path}/w")
    truth = spark.createDataFrame([("c", 10), ("c", 10), ("c", 50), ("d", 10), ("d", None)], "chrom string, pos long")
    seen = spark.createDataFrame([("c", 13), ("c", 8), ("c", 70), (None, 10)], "chrom string, pos long")
    assert tuple(recovery_metrics(truth, seen, ["chrom"], 5, work).first()) == (3, 1, 2, 3, 1, 33.33)
    assert tuple(recovery_metrics(truth.limit(0), seen, ["chrom"], 5, work).first()) == (0, 0, 0, 3, 3, None)
    hist = spark.createDataFrame([("a", 0, 3, 9, 90.0), ("a", 25, 0, 1, 10.0), ("a", 50, 0, 0, 0.0), ("b", 0, 0, 0, 0.0)], "k string, x_bin long, y_bin long, weight long, percent double")
    assert [tuple(r) for r in display_range(hist, ["k"], 5).collect()] == [("a", 0, 25, 0, 3, 10)]
    head = "trial\tindex1Seq\treplicate"
    lines = [(1, "a", 1, head), (2, "a", 2, "t\tACGTACGTACGT\t1"), (3, "a", 3, "t\tACGT\tx"), (4, "b", 1, head), (5, "b", 2, "t\tACGTACGTACGT\t1"), (6, "c", 1, head)]
    rows = sheet_report(spark.createDataFrame(lines, "line_id long, sheet string, line_no int, line string"))
    assert {tuple(r) for r in rows.collect()} == {("a", 2, 2, "FAILED"), ("b", 1, 0, "PASS"), ("c", 0, 0, "PASS")}
