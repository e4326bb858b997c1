"""Queries that run the pipeline's stages and file readers on reads, sheets and files derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.genome import psl_percent_identity, psl_score, revcomp, with_positions
from sitewright.operators.rangejoin import band_join
from sitewright.operators.rollup import fragment_members
from sitewright.plans.site_queries import FRAGMENT, SAMPLE
from sitewright.plans.site_sql import _FRAGMENT, _SAMPLE, _spot
from sitewright.plans.stages import DemultiplexOptions, attach_alignments, build_sites, demultiplex, hmm_gate, in_site_order, sample_report, sequences_to_align, trim_overread, vector_filter
from sitewright.session import Workspace, table
from sitewright.sources import readers
from sitewright.sources.lake import missing_updates, nearest_names, pull_records, register_samples, update_counts

REPLICATE = [*SAMPLE, "replicate"]
#: What the derived reads have behind their linkers.
_BODY = "GATTACACCATTGACCAGTA"


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "sampledata").drop("sheet", "line_no").withColumn("index1seq", F.upper("index1seq")).withColumn("adriftreadlinkerseq", F.upper("adriftreadlinkerseq")).distinct()


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read triplets from the sheet's rows and the fragments of their samples: index, linker with its Ns as Cs, leader."""
    frags = table(spark, sf_dir, "buildstdfragments").groupBy(*REPLICATE, "readid").agg(F.min("repleaderseq").alias("leader"))
    rows = frags.join(_sheet(spark, sf_dir).select(*REPLICATE, "index1seq", "adriftreadlinkerseq").distinct(), REPLICATE)
    text = lambda c, name: [c.alias(name), F.repeat(F.lit("I"), F.length(c)).alias(f"q{name[1]}")]
    readid = F.concat_ws("|", "readid", "replicate", "index1seq", "adriftreadlinkerseq", *SAMPLE)
    return rows.select(readid.alias("rec_idx"), readid.alias("readid"), F.col("index1seq").alias("i1"), *text(F.concat(F.translate("adriftreadlinkerseq", "N", "C"), F.lit(_BODY)), "r1"), *text(F.concat(F.lit(_BODY), F.coalesce("leader", F.lit(_BODY))), "r2"))


def demultiplex_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.13 d with Golay correction off and the orientation by vote."""
    rows = demultiplex(_reads(spark, sf_dir), _sheet(spark, sf_dir), DemultiplexOptions(auto_orientation=True, poly_g=False), Workspace(spark, "demultiplex"))
    return rows.select(*REPLICATE, "refgenome", "mode", "leaderseqhmm", "vectorfastafile", "anchorreadseq", "adriftreadseq", "umi", "n_reads", "readid")


def demultiplex_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the same reads without collapse and with their UMIs."""
    rows = demultiplex(_reads(spark, sf_dir), _sheet(spark, sf_dir), DemultiplexOptions(collapse=False, capture_umis=True, poly_g=False), Workspace(spark, "demultiplex"))
    return rows.select(*REPLICATE, "readid", "umi", "linker1", "linker2", "n_reads")


def demultiplex_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per sample and replicate of the sheet."""
    sheet = _sheet(spark, sf_dir)
    return sample_report(sheet.select(*REPLICATE).distinct(), demultiplex(_reads(spark, sf_dir), sheet, work=Workspace(spark, "demultiplex")))


def overread_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: mates that run into the other end's adapter after ten letters of their own."""
    rows = table(spark, sf_dir, "known_sites").select(F.upper(F.trim("leaderseq")).alias("leaderseq")).where("length(leaderseq) >= 40").distinct()
    linker2 = F.substring("leaderseq", 20, 10)
    reads = rows.withColumn("linker2", linker2).withColumn("anchorreadseq", F.concat("leaderseq", revcomp(linker2), F.lit("ACGTACGT"))).withColumn("adriftreadseq", F.concat(F.substring("leaderseq", 5, 30), revcomp(F.col("leaderseq"))))
    return trim_overread(reads)


def build_sites_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.13 k, P4, P5, A8-A12, T7 in one plan; ends up to 2,000 bases apart count as one site, for the tables hold few closer ones."""
    rows = table(spark, sf_dir, "buildstdfragments").withColumn("width", F.col("fragend") - F.col("fragstart") + 1)
    keep = [*SAMPLE, "refgenome", "mode", "leaderseqhmm", "vectorfastafile", "replicate", "width", "umi", F.col("nreads").alias("reads"), F.col("repleaderseq").alias("leader")]
    return in_site_order(build_sites(with_positions(rows, "posid", *keep).drop("posid"), Workspace(spark, "sites"), 2000))


def fragment_members_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragment_members(table(spark, sf_dir, "buildstdfragments").where("posid is not null"), FRAGMENT, {"read": "readid", "umi": "umi"})


def _file(rows: DataFrame, work: Workspace, name: str, *cells: Column | str, separator: str = "\t") -> str:
    """A text file of the rows; a null cell is empty."""
    cells = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cells]
    rows.select(F.concat_ws(separator, *cells).alias("value")).write.text(work.path(name))
    return work.path(name)


def fastq_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads written as FASTQ and read back."""
    rows = table(spark, sf_dir, "buildstdfragments").groupBy("readid").agg(F.min("repleaderseq").alias("seq")).where("seq is not null")
    path = _file(rows, Workspace(spark, "fastq"), "reads", F.concat(F.lit("@"), "readid", F.lit(" 1:N:0")), "seq", F.lit("+"), F.repeat(F.lit("I"), F.length("seq")), separator="\n")
    return readers.read_fastq(spark, path).select("readid", "seq", "quality")


def profile_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of profile hits read, gated, reduced to the best per read and joined to its reads."""
    reads = table(spark, sf_dir, "buildstdfragments").where(r"leaderseqhmm is not null and repleaderseq is not null and readid rlike '^\\S'").select(F.regexp_extract("readid", r"^\S*", 0).alias("readid"), "leaderseqhmm", "nreads", F.length("repleaderseq").alias("n"), F.col("fragstart").alias("at"))
    start, score = (F.col("at") % 7 + 1).alias("s"), (F.col("nreads") * 2.5).alias("x")
    hits = reads.select("readid", "leaderseqhmm", "n", start, score).distinct()
    minus, one = F.lit("-"), F.lit(1)
    path = _file(hits, Workspace(spark, "profiles"), "hits", "readid", minus, "leaderseqhmm", minus, one, "n", "s", "n", "s", "n", "n", F.lit("+"), F.lit(0.001), "x", F.lit(0.0), minus, separator="  ")
    names = reads.select(F.col("leaderseqhmm").alias("queryName")).distinct()
    limits = names.select("queryName", F.lit(1).alias("minStart"), F.lit(5).alias("maxStart"), F.lit(5.0).alias("minScore"), F.lit(1000.0).alias("maxScore"), F.lit(True).alias("matchEnd"), F.lit(2).alias("endRadius"), F.lit(32).alias("hmmLength"))
    kept = hmm_gate(readers.read_tblout(spark, path), limits)
    best = readers.best_hits(kept.select(F.col("targetName").alias("readid"), "queryName", "fullScore", "targetStart", (F.col("targetStart") * 1000 + F.length("queryName")).alias("ord")), "readid", "fullScore", "ord")
    return reads.groupBy("readid").agg(F.count("*").alias("n_rows")).join(best.select("readid", "fullScore", "targetStart"), "readid")


def vector_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of read ends read from a BLAST table; reads of both kinds per sample."""
    reads = table(spark, sf_dir, "buildstdfragments").where("repleaderseq is not null").select(*SAMPLE, "readid", F.col("repleaderseq").alias("anchorreadseq"))
    ends = sequences_to_align(reads.withColumn("end", F.expr("right(anchorreadseq, 25)")).withColumn("genome", F.lit("vector")), "genome", "end")
    hits = ends.withColumn("g", F.length(F.regexp_replace("end", "[^G]", "")))
    one = F.lit(1)
    path = _file(hits, Workspace(spark, "vector"), "hits", "end", F.lit("v"), F.col("g") + 82.5, F.lit(25), one, F.lit(0), one, F.lit(15) + F.col("g"), one, F.lit(25), F.lit(1e-5))
    clean, vector = vector_filter(reads, readers.read_blast(spark, path))
    return clean.withColumn("kind", F.lit("clean")).unionByName(vector.withColumn("kind", F.lit("vector"))).groupBy(*SAMPLE, "kind").agg(F.count("*").alias("n"))


def psl_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of the distinct leaders, read from PSL, brought back to all reads and scored."""
    reads = table(spark, sf_dir, "buildstdfragments").where("repleaderseq is not null").select("refgenome", "readid", F.col("repleaderseq").alias("qName"))
    hits = sequences_to_align(reads, "refgenome", "qName").withColumn("bad", F.length(F.regexp_replace("qName", "[^T]", "")) % 4).withColumn("n", F.length("qName"))
    zero = F.lit(0)
    path = _file(hits, Workspace(spark, "psl"), "hits", F.col("n") - F.col("bad"), "bad", zero, zero, zero, zero, zero, zero, F.lit("+"), "qName", "n", zero, "n", "refgenome", F.lit(1_000_000), F.lit(500), F.lit(500) + F.col("n"), F.lit(1), "n", zero, F.lit(500))
    found = readers.read_psl(spark, path).withColumnRenamed("tName", "refgenome")
    ali = F.col("qEnd") - F.col("qStart") + 1
    rows = attach_alignments(reads, found, "refgenome", "qName").withColumn("score", psl_score(F.col("matches"), F.col("misMatches"), F.col("repMatches"), F.col("qNumInsert"), F.col("tNumInsert")))
    rows = rows.withColumn("percent_id", psl_percent_identity(F.col("matches"), F.col("misMatches"), F.col("repMatches"), F.col("qNumInsert"), ali, F.col("tEnd") - F.col("tStart") + 1))
    return rows.select("refgenome", "readid", "qName", "tStart", "tWidth", "score", "percent_id").distinct()


def gene_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene predictions with two exons each, read and spread to exons."""
    rows = table(spark, sf_dir, "buildstdfragments").where("posid is not null and fragend - fragstart > 40").select("fragchromosome", "fragstrand", "fragstart", "fragend", "posid").distinct()
    s, e, zero = F.col("fragstart"), F.col("fragend"), F.lit(0)
    pair = lambda a, b: F.concat(a.cast("string"), F.lit(","), b.cast("string"), F.lit(","))
    path = _file(rows, Workspace(spark, "genes"), "genes", zero, "posid", "fragchromosome", "fragstrand", s, e, s, e, F.lit(2), pair(s, e - 10), pair(s + 20, e), zero, "posid", F.lit("none"), F.lit("none"), F.lit("0,0,"))
    genes = readers.read_genepred(spark, path)
    part = lambda df, kind: df.select("chrom", "start", "end", "strand", "name", "gene", F.lit(kind).alias("kind"))
    return part(readers.transcripts(genes), "transcript").unionByName(part(readers.exons(genes), "exon"))


def repeat_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeat table with its header lines, read back."""
    rows = table(spark, sf_dir, "buildstdfragments").where("vectorfastafile is not null").select("fragchromosome", "fragstart", "fragend", F.when(F.col("fragstrand") == "-", "C").otherwise(F.col("fragstrand")).alias("strand"), "vectorfastafile", "mode").distinct()
    score, f, z = F.lit(225), F.lit(1.5), F.lit("(0)")
    path = _file(rows, Workspace(spark, "repeats"), "table", score, f, f, f, "fragchromosome", "fragstart", "fragend", z, "strand", "vectorfastafile", "mode", F.lit(1), F.lit(9), z, F.lit(7), separator="   ")
    spark.range(1).select(F.lit("   SW  perc perc\nscore  div. del.\n").alias("value")).write.mode("append").text(path)
    return readers.read_repeats(spark, path).select(F.col("query_seq").alias("chrom"), F.col("query_start").alias("start"), F.col("query_end").alias("end"), "strand", "repeat_name", "repeat_class", "SW_score")


def _catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sample keys, folded to upper case, of the history with their counts, and those of later batches that are new."""
    key = [*REPLICATE, "ref_genome", "mode"]
    rows = table(spark, sf_dir, "samples").where(" and ".join(f"{c} is not null" for c in key)).select(*[F.upper(c).alias(c) if c != "replicate" else c for c in key], "batch", "demultiplexed_reads")
    old = rows.where("batch = 0").groupBy(*key).agg(F.max("demultiplexed_reads").alias("demultiplexed_reads"))
    new = rows.where("batch > 0").groupBy(*key).agg(F.max("demultiplexed_reads").alias("demultiplexed_reads")).join(old.select(*key), key, "left_anti")
    return old, new


def catalog_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: new samples registered and their counts filled in, each once."""
    key = [*REPLICATE, "ref_genome", "mode"]
    old, new = _catalog(spark, sf_dir)
    work = Workspace(spark, "catalog")
    counts = work.write(new.where("demultiplexed_reads is not null"), "counts")
    catalog = work.write(old.unionByName(register_samples(old, new, key)), "catalog")
    return update_counts(catalog, counts, key)


def catalog_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of later batches that got no count."""
    key = [*REPLICATE, "ref_genome", "mode"]
    new = Workspace(spark, "missing").write(_catalog(spark, sf_dir)[1], "new")
    return missing_updates(new, new.where("demultiplexed_reads is not null"), key)


def pulled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """catalog rows of some genomes and modes, all subjects."""
    return pull_records(table(spark, sf_dir, "samples"), ref_genome=["hg38", "hs1"], mode=["U5", "AAV"], subject=[]).select("sample_id", *SAMPLE, "ref_genome", "mode")


def control_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sites within three bases of a control, on its strand; controls are the positions with several fragment rows."""
    rows = table(spark, sf_dir, "buildstdfragments")
    seen = with_positions(rows, "posid", "nreads").groupBy("chrom", "strand", F.col("pos").alias("site_pos")).agg(F.sum("nreads").alias("reads"), F.count("*").alias("n"))
    seen = Workspace(spark, "controls").write(seen, "sites")
    targets = seen.where("n > 1").select("chrom", "strand", F.col("site_pos").alias("target"))
    return band_join(targets, seen.drop("n"), ["chrom", "strand"], "target", "site_pos", 3)


def name_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every trial of later batches that the history does not have, the three nearest that it has."""
    rows = table(spark, sf_dir, "samples").where("trial is not null")
    known = rows.where("batch = 0").select(F.col("trial").alias("name")).distinct()
    return nearest_names(rows.where("batch > 0").select(F.col("trial").alias("value")), "value", known, "name")


QUERIES = {
    "demultiplex_reads": demultiplex_reads,
    "demultiplex_single": demultiplex_single,
    "demultiplex_report": demultiplex_report,
    "overread_trim": overread_trim,
    "build_sites": build_sites_query,
    "fragment_members": fragment_members_query,
    "fastq_reads": fastq_reads,
    "profile_hits": profile_hits,
    "vector_hits": vector_hits,
    "psl_hits": psl_hits,
    "gene_parts": gene_parts,
    "repeat_table": repeat_table,
    "catalog_update": catalog_update,
    "catalog_missing": catalog_missing,
    "pulled_records": pulled_records,
    "control_sites": control_sites,
    "name_suggestions": name_suggestions,
}

_KEYS = f"{_SAMPLE}, replicate"
_SHEET = f"sheet AS (SELECT DISTINCT {_KEYS}, upper(index1seq) AS barcode, upper(adriftreadlinkerseq) AS linker, refgenome, leaderseqhmm, vectorfastafile, mode FROM sampledata)"
_DEMULTIPLEXED = rf"""{_SHEET}, part AS (SELECT *, regexp_extract(linker, '^([^N]*)(N*)(.*)$', ['a', 'b', 'c']) AS p FROM sheet),
  f AS (SELECT {_KEYS}, readid, min(repleaderseq) AS leader FROM buildstdfragments GROUP BY ALL),
  reads AS (SELECT concat_ws('|', readid, replicate, barcode, linker, {_SAMPLE}) AS readid, barcode AS i1, translate(linker, 'N', 'C') || '{_BODY}' AS r1, '{_BODY}' || coalesce(leader, '{_BODY}') AS r2
    FROM f JOIN (SELECT DISTINCT {_KEYS}, barcode, linker FROM sheet) USING ({_KEYS})),
  long AS (SELECT * FROM reads WHERE least(length(r1), length(r2)) > (SELECT max(length(linker)) FROM sheet)),
  near AS (SELECT i1, barcode FROM (SELECT DISTINCT i1 FROM long) JOIN (SELECT DISTINCT barcode FROM sheet) ON hamming(i1, barcode) <= 1),
  fits AS (SELECT part.*, readid, r1, r2 FROM long JOIN near USING (i1) JOIN part USING (barcode)
    WHERE hamming(substr(r1, 1, length(p.a)), p.a) <= 1 AND hamming(substr(r1, length(p.a) + length(p.b) + 1, length(p.c)), p.c) <= 1),
  kept AS (SELECT *, substr(r1, length(linker) + 1) AS adriftreadseq, r2 AS anchorreadseq FROM fits QUALIFY count(*) OVER (PARTITION BY readid) = 1)"""
_HAMMING = "list_max(list_filter(range(1, length({t}) - 5), lambda p: hamming(substr({t} || '#', p, 8), {q}) <= 1))"


def _turned(c: str) -> str:
    return f"reverse(translate({c}, 'ACGTN', 'TGCAN'))"


_SITE4 = f"{_SAMPLE}, refgenome"


def _duals(scope: str) -> str:
    """The rows of dual detections within scope (held) and what they become (named)."""
    pair = f"{scope}, chrom, u3s, u5_pos, u3_pos"
    return f"""x AS (SELECT {_SAMPLE}, refgenome, mode, leaderseqhmm, vectorfastafile, replicate, fragend - fragstart + 1 AS width, umi, nreads AS reads, repleaderseq AS leader, {_spot("posid")} FROM buildstdfragments WHERE posid IS NOT NULL),
  sided AS (SELECT *, CASE WHEN mode = 'U5' THEN CASE strand WHEN '+' THEN '-' ELSE '+' END ELSE strand END AS u3s, CASE strand WHEN '+' THEN pos + 2 ELSE pos - 2 END AS moved FROM x),
  near AS (SELECT DISTINCT {scope}, chrom, u3s, a.pos AS u5_pos, b.pos AS u3_pos FROM (SELECT * FROM sided WHERE mode = 'U5') a JOIN (SELECT * FROM sided WHERE mode = 'U3') b USING ({scope}, chrom, u3s) WHERE abs(a.pos - b.pos) <= 2000),
  pairs AS (SELECT * FROM near QUALIFY count(*) OVER (PARTITION BY {scope}, chrom, u3s, u5_pos) = 1 AND count(*) OVER (PARTITION BY {scope}, chrom, u3s, u3_pos) = 1),
  held AS (SELECT s.*, u5_pos, u3_pos FROM sided s JOIN pairs USING ({scope}, chrom, u3s) WHERE (mode = 'U5' AND pos = u5_pos) OR (mode = 'U3' AND pos = u3_pos)),
  place AS (SELECT {pair}, CAST(moved AS VARCHAR) AS spot FROM held GROUP BY {pair}, moved QUALIFY row_number() OVER (PARTITION BY {pair} ORDER BY count(*) DESC, CAST(moved AS VARCHAR)) = 1),
  lead AS (SELECT {pair}, mode, leader FROM held WHERE leader IS NOT NULL GROUP BY {pair}, mode, leader QUALIFY row_number() OVER (PARTITION BY {pair}, mode ORDER BY count(*) DESC, leader) = 1),
  named AS (SELECT {pair}, spot, concat_ws('/', max(leader) FILTER (WHERE mode = 'U3'), max(leader) FILTER (WHERE mode = 'U5')) AS label FROM place LEFT JOIN lead USING ({pair}) GROUP BY ALL)"""


_PAIR = f"{_SITE4}, chrom, u3s, u5_pos, u3_pos"
_BUILT = f"""{_duals(_SITE4)},
  done AS (SELECT {_SITE4}, 'dual detect' AS mode, chrom || CASE u3s WHEN '+' THEN '-' ELSE '+' END || spot AS posid, label AS leader, leaderseqhmm, vectorfastafile, replicate, width, umi, reads FROM held JOIN named USING ({_PAIR}) UNION ALL
    SELECT {_SITE4}, mode, chrom || CASE WHEN contains(mode, 'U3') THEN CASE strand WHEN '+' THEN '-' ELSE '+' END ELSE strand END || moved, leader, leaderseqhmm, vectorfastafile, replicate, width, umi, reads FROM sided s
    WHERE (contains(mode, 'U3') OR contains(mode, 'U5')) AND NOT EXISTS (FROM held h WHERE h.trial = s.trial AND h.subject = s.subject AND h.sample = s.sample AND h.refgenome = s.refgenome AND h.chrom = s.chrom AND h.mode = s.mode AND h.strand = s.strand AND h.pos = s.pos))"""
_TOP = "SELECT {k}, leader FROM done WHERE leader IS NOT NULL GROUP BY {k}, leader QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY count(DISTINCT width) DESC, sum(reads) DESC, leader) = 1"
_PLACE = f"{_SITE4}, mode, posid"
_PER_REPLICATE = ", ".join(
    f"CAST(max(reads) FILTER (WHERE replicate = {i}) AS BIGINT) AS rep{i}_reads, max(w) FILTER (WHERE replicate = {i}) AS rep{i}_sonic_lengths, max(umis) FILTER (WHERE replicate = {i}) AS rep{i}_umis, max(leader) FILTER (WHERE replicate = {i}) AS rep{i}_rep_leader"
    for i in (1, 2, 3, 4)
)
_BUILD_SITES = f"""WITH {_BUILT}, top AS ({_TOP.format(k=_PLACE)}), rtop AS ({_TOP.format(k=_PLACE + ", replicate")}),
  rep AS (SELECT {_PLACE}, replicate, sum(reads) AS reads, count(DISTINCT width) AS w, count(DISTINCT umi) AS umis FROM done GROUP BY ALL),
  wide AS (SELECT {_PLACE}, CAST(sum(w) AS BIGINT) AS sonic_lengths, count(*) AS n, {_PER_REPLICATE} FROM rep LEFT JOIN rtop USING ({_PLACE}, replicate) GROUP BY {_PLACE}),
  own AS (SELECT {_PLACE}, CAST(sum(reads) AS BIGINT) AS reads, count(DISTINCT width) AS sonic_lengths_sample, count(DISTINCT umi) AS umis, string_agg(DISTINCT leaderseqhmm, ';' ORDER BY leaderseqhmm) FILTER (WHERE trim(leaderseqhmm) <> '') AS leaderseqhmm,
    string_agg(DISTINCT vectorfastafile, ';' ORDER BY vectorfastafile) FILTER (WHERE trim(vectorfastafile) <> '') AS vectorfastafile FROM done GROUP BY ALL)
  SELECT * EXCLUDE (n, leader), leader AS rep_leader, CASE WHEN mode <> 'dual detect' THEN n END AS n_reps_obs, round(100.0 * sonic_lengths / sum(sonic_lengths) OVER (PARTITION BY {_SITE4}), 2) AS percent_rel_abund
  FROM own JOIN wide USING ({_PLACE}) LEFT JOIN top USING ({_PLACE})"""

_CATALOG_KEY = f"{_SAMPLE}, replicate, ref_genome, mode"
_CATALOG = f"""c AS (SELECT upper(trial) AS trial, upper(subject) AS subject, upper(sample) AS sample, replicate, upper(ref_genome) AS ref_genome, upper(mode) AS mode, batch = 0 AS old, max(demultiplexed_reads) AS demultiplexed_reads
    FROM samples WHERE trial IS NOT NULL AND subject IS NOT NULL AND sample IS NOT NULL AND replicate IS NOT NULL AND ref_genome IS NOT NULL AND mode IS NOT NULL GROUP BY ALL),
  u AS (SELECT * FROM c QUALIFY old OR NOT bool_or(old) OVER (PARTITION BY {_CATALOG_KEY}))"""
_GENES = "g AS (SELECT DISTINCT fragchromosome AS chrom, fragstrand AS strand, fragstart AS s, fragend AS e, posid FROM buildstdfragments WHERE posid IS NOT NULL AND fragend - fragstart > 40)"

SQL = {
    "demultiplex_reads": f"""WITH {_DEMULTIPLEXED} SELECT {_KEYS}, refgenome, mode, leaderseqhmm, vectorfastafile, anchorreadseq, adriftreadseq, 'AAAAAAAAAAAA' AS umi, count(*) AS n_reads, min(readid) AS readid FROM kept GROUP BY ALL""",
    "demultiplex_single": f"WITH {_DEMULTIPLEXED} SELECT {_KEYS}, readid, substr(r1, length(p.a) + 1, length(p.b)) AS umi, substr(r1, 1, length(p.a)) AS linker1, substr(r1, length(p.a) + length(p.b) + 1, length(p.c)) AS linker2, CAST(1 AS BIGINT) AS n_reads FROM kept",
    "demultiplex_report": f"WITH {_DEMULTIPLEXED} SELECT {_KEYS}, count(readid) AS demultiplexed_reads FROM (SELECT DISTINCT {_KEYS} FROM sheet) LEFT JOIN kept USING ({_KEYS}) GROUP BY ALL",
    "overread_trim": f"""WITH l AS (SELECT DISTINCT upper(trim(leaderseq)) AS leaderseq FROM known_sites WHERE length(trim(leaderseq)) >= 40),
  r AS (SELECT leaderseq, substr(leaderseq, 20, 10) AS linker2, leaderseq || {_turned("substr(leaderseq, 20, 10)")} || 'ACGTACGT' AS a, substr(leaderseq, 5, 30) || {_turned("leaderseq")} AS b FROM l),
  m AS (SELECT *, {_HAMMING.format(t="a", q=f"substr({_turned('linker2')}, 1, 8)")} AS i, {_HAMMING.format(t="b", q=f"substr({_turned('leaderseq')}, 1, 8)")} AS j FROM r),
  c AS (SELECT leaderseq, linker2, CASE WHEN i > 1 THEN substr(a, 1, i - 1) ELSE a END AS anchorreadseq, CASE WHEN j > 1 THEN substr(b, 1, j - 1) ELSE b END AS adriftreadseq FROM m)
  SELECT * FROM c WHERE length(anchorreadseq) >= 30 AND length(adriftreadseq) >= 30""",
    "build_sites": _BUILD_SITES,
    "dual_detect": f"""WITH {_duals("refgenome")}, d AS (SELECT refgenome, chrom, CASE u3s WHEN '+' THEN '-' ELSE '+' END AS strand, CAST(spot AS BIGINT) AS pos, label AS leader, replicate, sum(h.reads) AS reads, count(DISTINCT width) AS w FROM held h JOIN named USING (refgenome, chrom, u3s, u5_pos, u3_pos) GROUP BY ALL)
  SELECT refgenome, chrom, strand, pos, leader, CAST(sum(reads) AS BIGINT) AS reads, CAST(sum(w) AS BIGINT) AS sonic_lengths FROM d GROUP BY ALL""",
    "fragment_members": " UNION ALL ".join(f"SELECT {_FRAGMENT}, '{k}' AS kind, {c} AS value, count(*) AS n_records FROM buildstdfragments WHERE posid IS NOT NULL AND {c} IS NOT NULL GROUP BY ALL" for k, c in (("read", "readid"), ("umi", "umi"))),
    "fastq_reads": "SELECT regexp_extract(readid, '^\\S*') AS readid, min(repleaderseq) AS seq, repeat('I', length(min(repleaderseq))) AS quality FROM buildstdfragments WHERE repleaderseq IS NOT NULL GROUP BY buildstdfragments.readid",
    "profile_hits": """WITH r AS (SELECT regexp_extract(readid, '^\\S*') AS readid, leaderseqhmm, nreads * 2.5::DOUBLE AS x, length(repleaderseq) AS n, fragstart % 7 + 1 AS s FROM buildstdfragments WHERE leaderseqhmm IS NOT NULL AND repleaderseq IS NOT NULL AND regexp_matches(readid, '^\\S')),
  h AS (SELECT readid, x AS "fullScore", s AS "targetStart" FROM r WHERE s BETWEEN 1 AND 5 AND x BETWEEN 5 AND 1000 AND abs(32 - n) <= 2 QUALIFY row_number() OVER (PARTITION BY readid ORDER BY x DESC, s * 1000 + length(leaderseqhmm)) = 1)
  SELECT readid, n_rows, "fullScore", "targetStart" FROM h JOIN (SELECT readid, count(*) AS n_rows FROM r GROUP BY 1) USING (readid)""",
    "vector_hits": f"""WITH r AS (SELECT {_SAMPLE}, right(repleaderseq, 25) AS e FROM buildstdfragments WHERE repleaderseq IS NOT NULL), g AS (SELECT *, length(e) - length(replace(e, 'G', '')) AS g FROM r)
  SELECT {_SAMPLE}, CASE WHEN g + 82.5 >= 90 AND 100.0 * (15 + g) / length(e) >= 90 THEN 'vector' ELSE 'clean' END AS kind, count(*) AS n FROM g GROUP BY ALL""",
    "psl_hits": """WITH r AS (SELECT DISTINCT refgenome, readid, repleaderseq AS q, length(repleaderseq) AS n, (length(repleaderseq) - length(replace(repleaderseq, 'T', ''))) % 4 AS bad FROM buildstdfragments WHERE repleaderseq IS NOT NULL AND refgenome IS NOT NULL)
  SELECT refgenome, readid, q AS "qName", 501 AS "tStart", n AS "tWidth", n - 2 * bad AS score, round(100 - 0.1 * floor(1000.0 * bad / n), 2)::DOUBLE AS percent_id FROM r""",
    "gene_parts": f"""WITH {_GENES} SELECT chrom, s + 1 AS start, e AS "end", strand, posid AS name, posid AS gene, 'transcript' AS kind FROM g UNION ALL
  SELECT chrom, s + 1, s + 20, strand, 'exon 1', posid, 'exon' FROM g UNION ALL SELECT chrom, e - 9, e, strand, 'exon 2', posid, 'exon' FROM g""",
    "repeat_table": """SELECT DISTINCT fragchromosome AS chrom, fragstart AS start, fragend AS "end", fragstrand AS strand, vectorfastafile AS repeat_name, mode AS repeat_class, 225 AS "SW_score" FROM buildstdfragments WHERE vectorfastafile IS NOT NULL""",
    "catalog_update": f"WITH {_CATALOG} SELECT {_CATALOG_KEY}, demultiplexed_reads FROM u",
    "catalog_missing": f"WITH {_CATALOG} SELECT {_CATALOG_KEY} FROM u WHERE NOT old AND demultiplexed_reads IS NULL",
    "pulled_records": f"SELECT sample_id, {_SAMPLE}, ref_genome, mode FROM samples WHERE ref_genome IN ('hg38', 'hs1') AND mode IN ('U5', 'AAV')",
    "control_sites": f"""WITH s AS (SELECT chrom, strand, pos AS site_pos, CAST(sum(nreads) AS BIGINT) AS reads, count(*) AS n FROM (SELECT {_spot("posid")}, nreads FROM buildstdfragments WHERE posid IS NOT NULL) GROUP BY ALL),
  t AS (SELECT chrom, strand, site_pos AS target FROM s WHERE n > 1)
  SELECT chrom, strand, target, site_pos, reads FROM t JOIN s USING (chrom, strand) WHERE abs(target - site_pos) <= 3""",
    "name_suggestions": """WITH k AS (SELECT DISTINCT trial AS name FROM samples WHERE batch = 0 AND trial IS NOT NULL), v AS (SELECT DISTINCT trial AS value FROM samples WHERE batch > 0 AND trial IS NOT NULL AND trial NOT IN (SELECT name FROM k))
  SELECT value, CAST(row_number() OVER (PARTITION BY value ORDER BY d, name) AS INTEGER) AS rank, name, CAST(d AS INTEGER) AS distance
  FROM (SELECT value, name, levenshtein(regexp_replace(value, '[^ -~]', '~', 'g'), regexp_replace(name, '[^ -~]', '~', 'g')) AS d FROM v, k) QUALIFY rank <= 3""",
}

__all__ = ["QUERIES", "SQL"]
