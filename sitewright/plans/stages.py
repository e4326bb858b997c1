"""The pipeline's stages as DataFrame -> DataFrame functions (§2.13 d, e; §3)."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions.genome import posid, revcomp, trim_poly_g
from sitewright.operators.fragments import build_fragments
from sitewright.operators.rollup import collapse_duplicates, consensus_leader, joined_labels, relative_abundance, replicate_columns, replicate_range, site_rollup
from sitewright.operators.sequences import golay_correct, last_match, match_barcodes, orientation_vote, quality_trim, within
from sitewright.operators.sites import DUAL, label_duals, orient_sites
from sitewright.operators.standardize import standardize_breakpoints, standardize_positions
from sitewright.session import Workspace

GROUP = ["trial", "subject", "sample", "replicate", "mode", "refgenome", "vectorfastafile", "leaderseqhmm"]
MASKED_UMI = "AAAAAAAAAAAA"


@dataclass(frozen=True)
class DemultiplexOptions:
    index_mismatches: int = 1
    linker_mismatches: int = 1
    adrift_linkers: bool = True
    post_umi_linker: bool = True
    capture_umis: bool = False
    reverse_index: bool = False
    auto_orientation: bool = False
    golay: bool = False
    poly_g: bool = True
    collapse: bool = True
    trim_events: int = 2
    trim_score: int = 10
    trim_half_width: int = 3


def demultiplex(reads: DataFrame, sheet: DataFrame, options: DemultiplexOptions = DemultiplexOptions(), work: Workspace | None = None) -> DataFrame:
    """Assign reads to the samples of a sheet and collapse duplicates.

    reads: rec_idx, readid, i1, r1, q1, r2, q2. A read belongs to a sheet row if its index is within the
    allowed substitutions of the row's barcode and both linker parts are where they should be; a read that
    fits several rows is left out. Barcodes are matched once per distinct index sequence. A linker without Ns is
    tested whole, and its reads have no UMI and no second linker. auto_orientation: all index reads are reversed
    if more of them are barcodes then. golay: index reads are corrected first; what cannot be corrected stays.
    collapse: one row per sample, UMI and pair of sequences; otherwise one per read. With a work folder the
    assigned reads, which are used twice, are written there once.
    """
    o = options
    barcodes = sheet.withColumn("barcode", F.upper("index1seq")).withColumn("linker", F.upper("adriftreadlinkerseq"))
    rows = reads
    if o.auto_orientation:
        vote = orientation_vote(reads.select("i1"), "i1", barcodes, "barcode").select("reverse")  # one row
        rows = rows.join(F.broadcast(vote)).withColumn("i1", F.when(F.col("reverse"), revcomp(F.col("i1"))).otherwise(F.col("i1"))).drop("reverse")
    elif o.reverse_index:
        rows = rows.withColumn("i1", revcomp(F.col("i1")))
    if o.golay:
        rows = golay_correct(rows, "i1", "_fixed").withColumn("i1", F.coalesce("_fixed", "i1")).drop("_fixed")
    pairs = match_barcodes(rows, "i1", barcodes, "barcode", o.index_mismatches).select("i1", "barcode")
    trim = {"least": o.trim_score, "events": o.trim_events, "half_width": o.trim_half_width}
    rows = quality_trim(quality_trim(rows, "r1", "q1", **trim), "r2", "q2", **trim)
    longest = sheet.agg((F.max(F.length("adriftreadlinkerseq")) + 1).alias("least"))
    rows = rows.join(F.broadcast(longest)).where((F.length("r1") >= F.col("least")) & (F.length("r2") >= F.col("least"))).drop("least")
    linker = lambda k: F.regexp_extract("linker", r"^([^N]*)(N*)(.*)$", k)
    fits = rows.join(pairs, "i1").join(barcodes, "barcode")
    left, umi, right = F.length(linker(1)), F.length(linker(2)), F.length(linker(3))
    part = lambda start, size: F.when(umi > 0, F.substring("r1", start, size))
    fits = fits.withColumn("linker1", F.substring("r1", F.lit(1), left)).withColumn("umi", part(left + 1, umi)).withColumn("linker2", part(left + umi + 1, right))
    if o.adrift_linkers:
        fits = fits.where(within(F.col("linker1"), linker(1), o.linker_mismatches))
    if o.post_umi_linker:
        fits = fits.where((umi == 0) | within(F.col("linker2"), linker(3), o.linker_mismatches))
    tidy = trim_poly_g if o.poly_g else (lambda c: c)
    fits = fits.withColumn("adriftreadseq", tidy(F.expr("substring(r1, length(linker) + 1)"))).withColumn("anchorreadseq", tidy(F.col("r2")))
    fits = fits.where("adriftreadseq <> '' and anchorreadseq <> ''").select(*GROUP, "rec_idx", "readid", "linker1", "umi", "linker2", "anchorreadseq", "adriftreadseq")
    fits = Workspace.settle(fits, work, "fits")
    single = fits.groupBy("readid").agg(F.count("*").alias("_n")).where("_n = 1").select("readid")
    kept = fits.join(single, "readid", "left_semi").withColumn("umi", F.col("umi") if o.capture_umis else F.lit(MASKED_UMI))
    if not o.collapse:
        return collapse_duplicates(kept, [*GROUP, "readid"], "rec_idx", ["umi", "anchorreadseq", "adriftreadseq", "linker1", "linker2"])
    return collapse_duplicates(kept, [*GROUP, "umi", "anchorreadseq", "adriftreadseq"], "rec_idx", ["readid", "linker1", "linker2"])


def sample_report(sheet: DataFrame, demultiplexed: DataFrame) -> DataFrame:
    """The sheet with its reads per row, zero where there are none."""
    key = ["trial", "subject", "sample", "replicate"]
    counts = demultiplexed.groupBy(*key).agg(F.sum("n_reads").alias("demultiplexed_reads"))
    return sheet.join(counts, key, "left").withColumn("demultiplexed_reads", F.coalesce("demultiplexed_reads", F.lit(0)))


def hmm_gate(hits: DataFrame, parameters: DataFrame) -> DataFrame:
    """hits that satisfy their profile's limits on strand, start, score and, if asked for, the match end.

    parameters: queryName, minStart, maxStart, minScore, maxScore, matchEnd, endRadius, hmmLength (read_hmm_parameters).
    """
    ok = (F.col("strand") == "+") & F.col("targetStart").between(F.col("minStart"), F.col("maxStart")) & F.col("fullScore").between(F.col("minScore"), F.col("maxScore"))
    end = ~F.col("matchEnd") | (F.abs(F.col("hmmLength") - F.col("hmmEnd")) <= F.col("endRadius"))
    return hits.join(F.broadcast(parameters), "queryName").where(ok & end)


def profile_limits(stats: DataFrame, parameters: DataFrame, hmm: str = "leaderseqhmm") -> DataFrame:
    """Every sample's figures beside the limits of its profile (queryName of read_hmm_parameters); several rows of one
    profile give several rows, a sample without a known profile none."""
    return stats.join(parameters.withColumnRenamed("queryName", hmm), hmm)


def terminal_motif(anchor: Column, target_end: Column, motif: Column, radius: Column) -> Column:
    """F7, §2.13 e: the hit's end moved behind the first motif found around it; null where there is none."""
    start = F.greatest(target_end - (F.length(motif) - 1) - radius, F.lit(1))
    at = F.call_function("instr", F.substring(anchor, start, target_end + radius - start + 1), motif)
    return F.when(at > 0, start + at - 1 + F.length(motif) - 1)


def split_leader(reads: DataFrame, target_end: str) -> DataFrame:
    """Leader and rest of the anchor read; reads with an empty part are dropped."""
    rows = reads.withColumn("leaderseq", F.substring("anchorreadseq", F.lit(1), F.col(target_end))).withColumn("anchorreadseq", F.expr(f"substring(anchorreadseq, {target_end} + 1)"))
    return rows.where("leaderseq <> '' and anchorreadseq <> ''").drop(target_end)


def trim_overread(reads: DataFrame, width: int = 8, rate: float = 0.10, min_length: int = 30, overhang: bool = True) -> DataFrame:
    """F8, §2.13 e: mates cut where they run into the other end's adapter; pairs with a mate that is then too short are left out.

    The anchor read is cut before the last place of the first `width` letters of the reversed linker2, the adrift
    read before that of the reversed leaderseq, but not at the first letter. A linker2 or leaderseq that is
    null or shorter than width is an error.
    """
    short = F.coalesce(F.least(F.length("linker2"), F.length("leaderseq")), F.lit(0)) < width  # least skips nulls
    short = short | F.col("linker2").isNull() | F.col("leaderseq").isNull()
    rows = reads.withColumn("_short", short)
    for read, other in (("anchorreadseq", "linker2"), ("adriftreadseq", "leaderseq")):
        at = last_match(F.col(read), F.substring(revcomp(F.col(other)), 1, width), math.ceil(width * rate), overhang)
        rows = rows.withColumn("_at", at).withColumn(read, F.when(F.col("_at") > 1, F.substring(read, F.lit(1), F.col("_at") - 1)).otherwise(F.col(read))).drop("_at")
    # the error stands behind the filter, so that no predicate raises it for a row that an earlier filter removes
    kept = rows.where(F.col("_short") | ((F.length("anchorreadseq") >= min_length) & (F.length("adriftreadseq") >= min_length)))
    text = f"over-read trimming needs linker2 and leaderseq of at least {width} letters"
    return kept.withColumn("anchorreadseq", F.when(F.col("_short"), F.raise_error(F.lit(text))).otherwise(F.col("anchorreadseq"))).drop("_short")


def vector_filter(reads: DataFrame, hits: DataFrame, width: int = 25, min_identity: float = 90, min_coverage: float = 90) -> tuple[DataFrame, DataFrame]:
    """Reads without and with a vector hit in the last `width` bases of the anchor read.

    hits: qseqid (the tested sequence), pident, qstart, qend. Each different sequence has to be searched once.
    """
    tested = reads.withColumn("_test", F.expr(f"right(anchorreadseq, {width})"))
    strong = hits.where((F.col("pident") >= min_identity) & (F.lit(100.0) * (F.col("qend") - F.col("qstart") + 1) / F.length("qseqid") >= min_coverage))
    vector = strong.select(F.col("qseqid").alias("_test")).distinct()
    return tested.join(vector, "_test", "left_anti").drop("_test"), tested.join(vector, "_test", "left_semi").drop("_test")


def sequences_to_align(reads: DataFrame, genome: str, seq: str) -> DataFrame:
    """Each sequence of a genome once; attach_alignments brings its hits back to all reads that have it."""
    return reads.select(genome, seq).where(F.col(seq).isNotNull()).distinct()


def attach_alignments(reads: DataFrame, alignments: DataFrame, genome: str, seq: str) -> DataFrame:
    """Every read with every alignment of its sequence; reads without one are left out."""
    return reads.join(alignments, [genome, seq])


def build_sites(fragments: DataFrame, work: Workspace, reach: int = 6, distance: int = 2, duals: bool = True, orient: bool = True) -> DataFrame:
    """Standardized fragments to sites: dual detection, orientation, roll-up, leaders, abundance (§2.13 k, P4, P5, A8-A12).

    fragments: trial, subject, sample, refgenome, mode, leaderseqhmm, vectorfastafile, chrom, strand, pos, replicate,
    width, reads, umi, leader. One row per sample, genome, mode and position with distinct UMIs (null in all
    columns if the input has no real one), break lengths summed over replicates and over the sample, reads, leader,
    replicates seen (null for dual detections), relative abundance in the sample and the columns of every replicate.
    Rows with a null among scope, mode, chrom, strand or pos belong to no site.
    """
    scope = ["trial", "subject", "sample", "refgenome"]
    rows = label_duals(fragments, scope, reach, distance, work) if duals else fragments
    rows = orient_sites(rows, distance) if orient else rows
    site = [*scope, "mode", "posid"]
    rows = work.write(rows.withColumn("posid", posid(F.col("chrom"), F.col("strand"), F.col("pos"))).dropna(subset=site), "fragments")
    sites = site_rollup(rows, site, "replicate", "width", "reads")
    real = rows.agg(F.coalesce(F.bool_or(F.col("umi") != MASKED_UMI), F.lit(False)).alias("_real"))  # one row
    umis = rows.groupBy(*site).agg(F.count_distinct("umi").alias("umis"))
    leaders = consensus_leader(rows.where("leader is not null"), site, "leader", "width", "reads")
    wide = replicate_columns(rows, site, "replicate", replicate_range(rows, "replicate"), "width", "reads", "umi", "leader")
    out = sites.join(umis, site).join(leaders, site, "left").join(wide, site)
    for label in ("leaderseqhmm", "vectorfastafile"):
        out = out.join(joined_labels(rows, site, label, label), site, "left")
    out = relative_abundance(out, scope, "sonic_lengths").withColumn("n_reps_obs", F.when(F.col("mode") != DUAL, F.col("n_reps_obs"))).join(F.broadcast(real))
    masked = [c for c in out.columns if c == "umis" or re.fullmatch(r"rep-?[0-9]+_umis", c)]
    return out.withColumns({c: F.when(F.col("_real"), F.col(c)) for c in masked}).drop("_real")


def in_site_order(sites: DataFrame) -> DataFrame:
    """Sites by falling number of break lengths, equal ones by their keys."""
    return sites.orderBy(F.desc("sonic_lengths"), "trial", "subject", "sample", "mode", "refgenome", "posid")


def standardized_sites(fragments: DataFrame, pool: list[str], sample: list[str]) -> DataFrame:
    """Fragments to sites: snap integration positions pooled over a subject, then breaks per sample, then roll up.

    fragments: pool and sample columns, replicate, chrom, frag_strand, frag_start, frag_end, readid, n_reads.
    """
    plus = F.col("frag_strand") == "+"
    ends = fragments.withColumn("site", F.when(plus, F.col("frag_start")).otherwise(F.col("frag_end"))).withColumn("break", F.when(plus, F.col("frag_end")).otherwise(F.col("frag_start")))
    moved = standardize_positions(ends, [*pool, "chrom", "frag_strand"], "site", "n_reads", 8, 4, 4).drop("site").withColumnRenamed("corrected", "site")
    keyed = moved.withColumn("posid", F.concat("chrom", "frag_strand", F.col("site").cast("string")))
    keys = list(dict.fromkeys([*pool, *sample, "replicate", "posid"]))
    done = standardize_breakpoints(keyed, keys, "break", "n_reads", "readid", 5, 2, 4).withColumn("width", F.abs(F.col("corrected") - F.col("site")) + 1)
    group = list(dict.fromkeys([*pool, *sample]))
    return relative_abundance(site_rollup(done, [*group, "posid"], "replicate", "width", "n_reads"), group, "sonic_lengths")


def reads_to_sites(anchors: DataFrame, adrift: DataFrame, pool: list[str], sample: list[str]) -> DataFrame:
    """J1 to A12 in one plan: mate alignments, concordant fragments, standardized sites with abundance."""
    frags = build_fragments(anchors, adrift).withColumnRenamed("strand", "frag_strand").drop("start", "end")
    return standardized_sites(frags, pool, sample)
