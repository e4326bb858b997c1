"""Queries on the reads, fragments, sites and sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.genome import posid, revcomp, trim_poly_g, with_positions
from sitewright.functions.text import normalize_id, strip_blanks, valid_id
from sitewright.operators.components import connected_components
from sitewright.operators.fragments import anchor_competition, position_counts, rescue_reads, shortest_fragment
from sitewright.operators.rangejoin import band_join, fill_down, nearest_edge, nearest_join, overlap_join
from sitewright.operators.rollup import collapse_duplicates, consensus_leader, display_range, dominant_class, fragment_rollup, joined_labels, relative_abundance, replicate_columns, replicate_range, site_rollup, site_umis, weighted_histogram
from sitewright.operators.sequences import assign_reads, binned_consensus, golay_correct, orientation_vote, quality_trim
from sitewright.operators.sites import annotate_nearest, annotate_repeats, dual_detections, oriented_strand, reciprocal_pairs, recovery_metrics, shifted_position
from sitewright.session import Workspace, table
from sitewright.sources.lake import merge_history, replace_scope

SAMPLE = ["trial", "subject", "sample"]
SCOPE = [*SAMPLE, "refgenome", "mode"]
SITE = [*SCOPE, "posid"]
FRAGMENT = [*SITE, "replicate", "fragstart", "fragend"]


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "buildstdfragments").withColumn("width", F.col("fragend") - F.col("fragstart") + 1)


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct chromosome and coordinate of the known sites."""
    return with_positions(table(spark, sf_dir, "known_sites"), "posid", "nreads", *SAMPLE).drop("posid")


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "buildstdfragments").select(F.col("fragchromosome").alias("chrom"), F.col("fragstart").cast("long").alias("start"), F.col("fragend").cast("long").alias("end"), F.col("fragstrand").alias("strand"), F.col("posid").alias("gene"))
    return rows.where("start <= end").distinct()


def dup_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))
    return collapse_duplicates(docs.withColumn("first_doc", F.col("doc_id")), ["lang", "source", "text_md5"], "doc_id", ["first_doc"])


def id_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "samples").select("sample_id", *[normalize_id(F.col(c)).alias(c) for c in SAMPLE])
    return rows.withColumn("is_valid", valid_id(F.col("trial")) & valid_id(F.col("subject")) & valid_id(F.col("sample")))


def revcomp_polyg(spark: SparkSession, sf_dir: str) -> DataFrame:
    leader = F.upper(strip_blanks(F.col("leaderseq")))
    rows = table(spark, sf_dir, "known_sites").select(leader.alias("leader")).where("leader is not null").groupBy("leader").agg(F.count("*").alias("n"))
    return rows.select("leader", "n", revcomp(F.col("leader")).alias("rc"), trim_poly_g(F.col("leader"), "G{3,}[ATCN]?G{2,}.*$").alias("trimmed"))


def barcode_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per sheet barcode, by their UMI as the index sequence."""
    sheet = table(spark, sf_dir, "sampledata").select(F.upper("index1seq").alias("barcode"))
    reads = table(spark, sf_dir, "buildstdfragments").select("readid", F.col("umi").alias("seq"))
    return assign_reads(reads, "readid", "seq", sheet, "barcode").groupBy("barcode").agg(F.count("*").alias("n_reads"))


def unique_multi_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _fragments(spark, sf_dir)
    n = position_counts(reads, "readid", "posid")
    return reads.select("readid", *SAMPLE).distinct().join(n, "readid").groupBy(*SAMPLE).agg(F.count_if(F.col("n_positions") == 1).alias("n_unique"), F.count_if(F.col("n_positions") > 1).alias("n_multi"), F.max("n_positions").alias("most_positions"))


def multihit_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fragments(spark, sf_dir).withColumn("region", F.concat_ws(":", "fragchromosome", F.floor(F.col("fragstart") / 1_000_000).cast("string")))
    return rescue_reads(rows, "readid", "region", ["refgenome"])


def fuzzy_break_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fragments(spark, sf_dir).select("readid", "posid", "fragstart", "fragend", "width")
    return shortest_fragment(rows.where("posid is not null"), ["readid", "posid"], F.col("width"), "fragstart").select("readid", "posid", "fragstart", "fragend")


def multihit_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.13 g: networks of reads with several positions, per sample: component label, reads, positions and reads' sum."""
    rows = _fragments(spark, sf_dir)
    multi = rows.join(position_counts(rows, "readid", "posid").where("n_positions > 1"), "readid", "left_semi").select(*SCOPE, "readid", "posid", "nreads").where("posid is not null")
    vertex = lambda kind, c: F.struct(*[F.xxhash64(F.lit(seed), F.lit(kind), *[F.coalesce(F.col(k), F.lit("\0")) for k in [*SCOPE, c]]) for seed in (1, 2)])
    labels = connected_components(multi.select(vertex("pos", "posid").alias("u"), vertex("read", "readid").alias("v")), Workspace(spark, "multihit"))
    named = multi.withColumn("id", vertex("pos", "posid")).join(labels, "id")
    per = named.groupBy(*SCOPE, "root").agg(F.min("readid").alias("cluster"), F.count_distinct("readid").alias("n_reads"), F.count_distinct("posid").alias("n_positions"), F.sum("nreads").alias("reads"))
    return per.drop("root")


def multihit_cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads, UMIs, positions and their fragment lengths of every recorded cluster."""
    rows = _fragments(spark, sf_dir).withColumn("cluster", strip_blanks(F.col("clusterid"))).where("cluster not in ('', 'NA')")
    per = rows.groupBy(*SCOPE, "cluster", "posid").agg(F.count_distinct("width").alias("lengths"), F.count_distinct("readid").alias("reads"))
    nodes = per.groupBy(*SCOPE, "cluster").agg(F.count("posid").alias("n_positions"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "posid", "lengths", "reads"))), ",").alias("nodes"))
    sums = rows.groupBy(*SCOPE, "cluster").agg(F.count_distinct("readid").alias("n_reads"), F.count_distinct("umi").alias("n_umis"), F.sum("nreads").alias("reads"))
    return sums.join(nodes, [*SCOPE, "cluster"])


def anchor_competition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fragments(spark, sf_dir).withColumn("anchor", F.col("repleaderseq")).where("anchor is not null and posid is not null")
    return anchor_competition(rows, ["sample", "anchor"], ["trial", "subject", "refgenome", "mode", "posid"], "fragstart", "fragend", 2, 3)


def fragment_rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragment_rollup(_fragments(spark, sf_dir).where("posid is not null"), FRAGMENT, "nreads", "readid", "repleaderseq")


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fragments(spark, sf_dir).where("posid is not null")


def site_rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_abundance(site_rollup(_sites(spark, sf_dir), SITE, "replicate", "width", "nreads"), [*SAMPLE, "refgenome"], "sonic_lengths")


def site_rollup_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _sites(spark, sf_dir)
    return replicate_columns(sites, SITE, "replicate", replicate_range(sites, "replicate"), "width", "nreads")


def consensus_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus_leader(_sites(spark, sf_dir).where("repleaderseq is not null"), SITE, "repleaderseq", "width", "nreads")


def metadata_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_labels(_sites(spark, sf_dir), SCOPE, "vectorfastafile", "vectors")


def orientation_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position ids shifted by the overhang and turned by mode."""
    rows = with_positions(_fragments(spark, sf_dir).where("mode in ('U3', 'U5')"), "posid", "mode")
    new = posid(F.col("chrom"), oriented_strand(F.col("mode"), F.col("strand")), shifted_position(F.col("strand"), F.col("pos")))
    return rows.groupBy("mode", new.alias("posid")).agg(F.count("*").alias("n"))


def _ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fragments(spark, sf_dir).where("mode in ('U3', 'U5')")
    return with_positions(rows, "posid", "subject", "refgenome", "mode", F.col("repleaderseq").alias("leader"), F.col("nreads").alias("reads"), "replicate", "width").drop("posid")


def dual_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reciprocal one-to-one pairs of U5 and U3 positions within 5,000 bases on opposite strands."""
    work = Workspace(spark, "pairs")
    rows = work.write(_ends(spark, sf_dir).select("chrom", "strand", "pos", "mode").distinct(), "ends")
    u5 = rows.where("mode = 'U5'").select("chrom", F.when(F.col("strand") == "+", "-").otherwise("+").alias("strand"), F.col("pos").alias("u5_pos")).distinct()
    u3 = rows.where("mode = 'U3'").select("chrom", "strand", F.col("pos").alias("u3_pos")).distinct()
    return reciprocal_pairs(u5, u3, ["chrom", "strand"], "u5_pos", "u3_pos", 5000, work)


def dual_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_detections(_ends(spark, sf_dir), ["refgenome"], 2000, work=Workspace(spark, "dual"))


def nearest_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_join(_positions(spark, sf_dir), _intervals(spark, sf_dir).select("chrom", "start", "end").distinct(), ["chrom"], "pos", "start", "end", work=Workspace(spark, "nearest"))


def nearest_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8, J9, J11 with the fragments as genes and those over 300 bases as exons."""
    work = Workspace(spark, "genes")
    genes = work.write(_intervals(spark, sf_dir), "genes")
    return annotate_nearest(_positions(spark, sf_dir), genes, genes.where("end - start > 300"), ["chrom"], work)


def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = _positions(spark, sf_dir).select("chrom", "pos").distinct()
    return overlap_join(spots, _intervals(spark, sf_dir).select("chrom", "start", "end").distinct(), ["chrom"], "pos", "start", "end", 1 << 11)


def repeat_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and classes over each known position."""
    rows = table(spark, sf_dir, "buildstdfragments").where("fragstart <= fragend").groupBy(F.col("fragchromosome").alias("chrom"), F.col("fragstart").cast("long").alias("start"), F.col("fragend").cast("long").alias("end"), F.col("vectorfastafile").alias("name"), F.col("mode").alias("class")).agg(F.count("*").alias("n"))
    return annotate_repeats(_positions(spark, sf_dir), rows.withColumn("ord", F.concat_ws(":", "name", "class")), ["chrom"])


def dominant_class_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fragments(spark, sf_dir).withColumn("cluster", strip_blanks(F.col("clusterid"))).where("cluster not in ('', 'NA') and posid is not null")
    return dominant_class(rows, [*SCOPE, "cluster"], "posid", "leaderseqhmm")


def score_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_histogram(_fragments(spark, sf_dir), ["leaderseqhmm"], F.col("width"), F.col("nreads"), 25, 3, F.col("nreads")).where("leaderseqhmm is not null")


def heatmap_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of score_heatmap with at least two percent of a profile's reads."""
    return display_range(score_heatmap(spark, sf_dir), ["leaderseqhmm"], 2.0)


def sequence_consensus_genomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A21, T8 with the second key: bases 50 to 60."""
    rows = table(spark, sf_dir, "known_sites").select(F.upper(strip_blanks(F.col("leaderseq"))).alias("seq"))
    return binned_consensus(rows, "seq", 50, 1, None, Workspace(spark, "consensus"), (50, 60))


def sequence_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "known_sites").select(F.upper(strip_blanks(F.col("leaderseq"))).alias("seq"))
    return binned_consensus(rows, "seq", 50, 1, None, Workspace(spark, "consensus"))


def topk_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent barcodes and barcode:linker pairs side by side by rank."""
    sheet = table(spark, sf_dir, "sampledata").select(F.upper("index1seq").alias("i"), F.upper("adriftreadlinkerseq").alias("l"))

    def top(key, name):
        counts = sheet.groupBy(key.alias(name)).agg(F.count("*").alias(f"{name}_n")).orderBy(F.desc(f"{name}_n"), name).limit(10)
        ranked = counts.agg(F.array_sort(F.collect_list(F.struct((-F.col(f"{name}_n")).alias("o"), name))).alias("x"))
        return ranked.select(F.posexplode("x").alias("rank", "y")).select((F.col("rank") + 1).alias("rank"), F.col(f"y.{name}").alias(name), (-F.col("y.o")).alias(f"{name}_n"))

    return top(F.col("i"), "barcode").join(top(F.concat_ws(":", "i", "l"), "pair"), "rank", "full")


def stage_attrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each stage counts per sample, as one full outer join."""
    counts = {
        "samples": ("n_registered", F.sum("demultiplexed_reads")),
        "sampledata": ("n_sheet_rows", F.count("*")),
        "buildstdfragments": ("n_fragments", F.count("*")),
        "multihit_clusters": ("n_clusters", F.sum("total_clusters")),
        "known_sites": ("n_sites", F.count("*")),
    }
    out = None
    for name, (column, agg) in counts.items():
        part = table(spark, sf_dir, name).where("subject is not null and sample is not null").groupBy("subject", "sample").agg(agg.cast("long").alias(column))
        out = part if out is None else out.join(part, ["subject", "sample"], "full")
    return out


def subject_history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming keys win over archived ones (J17): batch 0 is the archive, the latest batch of a key comes in."""
    key = [*SAMPLE, "replicate", "ref_genome", "mode"]
    rows = table(spark, sf_dir, "samples").select(*key, "batch", "sample_id").where(" and ".join(f"{c} is not null" for c in key))
    incoming = rows.where("batch > 0").groupBy(*key).agg(F.max("sample_id").alias("sample_id"))
    archive = rows.where("batch = 0").groupBy(*key).agg(F.max("sample_id").alias("sample_id"))
    return merge_history(incoming.withColumn("origin", F.lit("incoming")), archive.withColumn("origin", F.lit("archive")), key)


def scope_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.13 o: groups that were processed again lose all their old rows, also where nothing survives."""
    rows = table(spark, sf_dir, "buildstdfragments").select(*SCOPE, "posid", "replicate", "nreads")
    group = [*SAMPLE, "refgenome"]
    processed = rows.where("replicate >= 3").select(*group).distinct()
    work = Workspace(spark, "scope")
    old, new = rows.where("replicate < 3").withColumn("state", F.lit("kept")), rows.where("replicate >= 3 and nreads > 1").withColumn("state", F.lit("new"))
    old.repartition(*group).write.partitionBy(*group).parquet(work.path("table"))
    replace_scope(spark, new, processed, work.path("table"), group)
    return spark.read.schema(old.schema).parquet(work.path("table")).groupBy(*SCOPE, "state").agg(F.count("*").alias("n"), F.sum("nreads").alias("reads"))


def truth_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each known position the closest site of the fragments within 5 bases, then the one with most reads."""
    truth = _positions(spark, sf_dir).groupBy("chrom", "strand", F.col("pos").alias("true_pos")).agg(F.count("*").alias("n_rows"))
    seen = with_positions(_fragments(spark, sf_dir), "posid", "nreads").groupBy("chrom", "strand", F.col("pos").alias("site_pos")).agg(F.sum("nreads").alias("site_reads"))
    near = band_join(truth, seen, ["chrom", "strand"], "true_pos", "site_pos", 5)
    best = near.groupBy("chrom", "strand", "true_pos").agg(F.min(F.struct(F.abs(F.col("true_pos") - F.col("site_pos")).alias("d"), (-F.col("site_reads")).alias("r"), "site_pos")).alias("b"))
    rows = truth.join(best, ["chrom", "strand", "true_pos"], "left")
    return rows.select("chrom", "strand", "true_pos", "n_rows", F.col("b.site_pos").alias("site_pos"), F.col("b.d").alias("distance"), (-F.col("b.r")).alias("site_reads"))


def recovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A26 over the same tables and the same reach as truth_recovery."""
    return recovery_metrics(_positions(spark, sf_dir), with_positions(_fragments(spark, sf_dir), "posid", "nreads"), ["chrom", "strand"], 5, Workspace(spark, "recovery"))


def spacing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between neighbouring known positions of a chromosome."""
    spots = _positions(spark, sf_dir).select("chrom", "pos").distinct()
    following = nearest_edge(spots.select("chrom", (F.col("pos") + 1).alias("pos")), spots.select("chrom", F.col("pos").alias("edge")), ["chrom"], False, 1 << 20)
    gaps = following.where("edge is not null").select("chrom", (F.col("edge") - F.col("pos") + 1).alias("gap"))
    return gaps.groupBy("chrom").agg(F.count("*").alias("n"), F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"), F.round(F.avg("gap"), 4).alias("mean_gap"), F.median("gap").alias("median_gap"))


def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog records per sample: distinct fragments, sites and clusters."""
    rows = _fragments(spark, sf_dir).withColumn("cluster", F.nullif(strip_blanks(F.col("clusterid")), F.lit("NA")))
    frags = rows.select(*SCOPE, "fragchromosome", "fragstrand", "fragstart", "fragend").distinct().groupBy(*SCOPE).agg(F.count("*").alias("total_fragments"))
    sites = rows.select(*SCOPE, "posid").where("posid is not null").distinct().groupBy(*SCOPE).agg(F.count("*").alias("total_sites"))
    clusters = rows.where("cluster <> ''").select(*SCOPE, "cluster").distinct().groupBy(*SCOPE).agg(F.count("*").alias("total_clusters"))
    out = frags.join(sites, SCOPE, "left").join(clusters, SCOPE, "left")
    return out.select(*SCOPE, "total_fragments", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_sites", "total_clusters")])


def index_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many index reads are a barcode as they are, and how many reversed; the greater count decides."""
    sheet = table(spark, sf_dir, "sampledata").select(F.upper("index1seq").alias("seq")).distinct()
    reads = table(spark, sf_dir, "buildstdfragments").select(F.col("umi").alias("seq"))
    return orientation_vote(reads, "seq", sheet, "seq")


def site_umi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct UMIs of every site; null throughout where all UMIs of the table are masked."""
    return site_umis(_sites(spark, sf_dir), SITE, "umi")


def header_fill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sheet line with the line number of the header above it."""
    lines = table(spark, sf_dir, "sampledata_lines").select("line_id", "sheet", F.col("line_no").cast("long").alias("pos"))
    above = fill_down(lines.select("sheet", "pos"), lines.where("pos = 1").select("sheet", F.col("pos").alias("edge")), ["sheet"])
    return lines.join(above, ["sheet", "pos"]).select("line_id", "sheet", F.col("edge").alias("header_no"))


def golay_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.13 m on the sheets' barcodes."""
    rows = table(spark, sf_dir, "sampledata").groupBy(F.upper("index1seq").alias("barcode")).agg(F.count("*").alias("n"))
    return golay_correct(rows, "barcode")


def quality_trim_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W10 with the read names' hashes as quality strings."""
    rows = table(spark, sf_dir, "buildstdfragments").groupBy("readid").agg(F.min("repleaderseq").alias("seq")).where("seq is not null")
    quality = F.substring(F.concat(F.translate(F.md5("readid"), "0123456789abcdef", "#%')+-/13579;=?A"), F.md5("seq")), F.lit(1), F.length("seq"))
    return quality_trim(rows.withColumn("quality", quality), "seq", "quality")


QUERIES = {
    "dup_collapse": dup_collapse,
    "id_normalize": id_normalize,
    "revcomp_polyg": revcomp_polyg,
    "barcode_assign": barcode_assign,
    "unique_multi_split": unique_multi_split,
    "multihit_rescue": multihit_rescue,
    "fuzzy_break_pick": fuzzy_break_pick,
    "multihit_components": multihit_components,
    "multihit_cluster_summary": multihit_cluster_summary,
    "anchor_competition": anchor_competition_query,
    "fragment_rollup": fragment_rollup_query,
    "site_rollup": site_rollup_query,
    "site_rollup_pivot": site_rollup_pivot,
    "consensus_leaders": consensus_leaders,
    "metadata_collapse": metadata_collapse,
    "orientation_correct": orientation_correct,
    "dual_pairs": dual_pairs,
    "dual_detect": dual_detect,
    "nearest_interval": nearest_interval,
    "nearest_genes": nearest_genes,
    "interval_overlap": interval_overlap,
    "repeat_annotate": repeat_annotate,
    "dominant_class": dominant_class_query,
    "score_heatmap": score_heatmap,
    "heatmap_range": heatmap_range,
    "sequence_consensus": sequence_consensus,
    "sequence_consensus_genomic": sequence_consensus_genomic,
    "topk_barcodes": topk_barcodes,
    "stage_attrition": stage_attrition,
    "subject_history_merge": subject_history_merge,
    "scope_replace": scope_replace,
    "truth_recovery": truth_recovery,
    "recovery_summary": recovery_summary,
    "spacing_stats": spacing_stats,
    "catalog_counts": catalog_counts,
    "index_orientation": index_orientation,
    "site_umi_counts": site_umi_counts,
    "header_fill_down": header_fill_down,
    "golay_decode": golay_decode,
    "quality_trim": quality_trim_query,
}

from sitewright.plans.site_sql import SQL  # noqa: E402

__all__ = ["QUERIES", "SQL"]
