"""Site orientation, dual detection and annotation (P4, P5, J8-J11, J16, A16, A17, §2.13 k, l)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.operators.rangejoin import band_join, nearest_join, overlap_join
from sitewright.operators.rollup import modal_value
from sitewright.session import Workspace


def shifted_position(strand: Column, pos: Column, distance: int = 2) -> Column:
    """The position moved downstream by the integrase's overhang."""
    return F.when(strand == "+", pos + distance).otherwise(pos - distance)


def oriented_strand(mode: Column, strand: Column) -> Column:
    """P5: U3 reads turn the strand round, U5 reads keep it."""
    return F.when(mode.contains("U3"), F.when(strand == "+", "-").otherwise("+")).otherwise(strand)


def reciprocal_pairs(left: DataFrame, right: DataFrame, keys: list[str], left_pos: str, right_pos: str, reach: int = 6, work: Workspace | None = None) -> DataFrame:
    """Pairs within reach that are the only partner of each other.

    left and right: distinct (keys, position). Degrees are grouped counts joined back.
    """
    pairs = band_join(left, right, keys, left_pos, right_pos, reach).select(*keys, left_pos, right_pos).distinct()
    pairs = Workspace.settle(pairs, work, "near")
    one = lambda side: pairs.groupBy(*keys, side).agg(F.count("*").alias("_n")).where("_n = 1").select(*keys, side)
    return pairs.join(one(left_pos), [*keys, left_pos], "left_semi").join(one(right_pos), [*keys, right_pos], "left_semi")


#: The mode of a site that is seen from both ends.
DUAL = "dual detect"


def label_duals(df: DataFrame, scope: list[str], reach: int = 6, distance: int = 2, work: Workspace | None = None) -> DataFrame:
    """§2.13 k: df with the rows of sites seen from both ends moved to one site; no row is added or lost.

    df: scope columns, chrom, strand, pos, mode, leader and any others. A U5 and a U3 position on opposite
    strands of a chromosome, at most reach apart and only partners of each other, are one site: at the modal
    shifted position (ties: the least as a string), on the opposite of the U3 strand, with the modal leaders
    of U3 and U5 (ties: the least) joined by a slash, of mode DUAL. Rows with a null in scope, chrom, strand
    or pos stay as they are. With a work folder df and the pairs are written there once.
    """
    turned = F.when(F.col("strand") == "+", "-").when(F.col("strand") == "-", "+")
    sided = Workspace.settle(df.withColumn("u3_strand", F.when(F.col("mode") == "U5", turned).otherwise(F.col("strand"))), work, "ends")
    keys = [*scope, "chrom", "u3_strand"]
    side = lambda mode, name: sided.where(F.col("mode") == mode).select(*keys, F.col("pos").alias(name)).distinct()
    pairs = Workspace.settle(reciprocal_pairs(side("U5", "u5_pos"), side("U3", "u3_pos"), keys, "u5_pos", "u3_pos", reach), work, "pairs")
    pair = [*keys, "u5_pos", "u3_pos"]
    ends = pairs.select(*pair, F.inline(F.array(*[F.struct(F.lit(m).alias("mode"), F.col(c).alias("pos")) for m, c in (("U5", "u5_pos"), ("U3", "u3_pos"))])))
    rows = sided.join(ends, [*keys, "mode", "pos"]).select(*pair, "mode", "leader", shifted_position(F.col("strand"), F.col("pos"), distance).cast("string").alias("_at"))
    rows = Workspace.settle(rows, work, "pair-rows")
    at = modal_value(rows, pair, "_at", "_site_pos")
    leaders = modal_value(rows, [*pair, "mode"], "leader", "leader").groupBy(*pair).agg(F.max(F.when(F.col("mode") == "U3", F.col("leader"))).alias("_l3"), F.max(F.when(F.col("mode") == "U5", F.col("leader"))).alias("_l5"))
    labels = ends.join(at, pair).join(leaders, pair, "left").select(*keys, "mode", "pos", "_site_pos", F.concat_ws("/", "_l3", "_l5").alias("_leader"))
    out = sided.join(labels, [*keys, "mode", "pos"], "left").withColumn("_dual", F.col("_site_pos").isNotNull())
    opposite = F.when(F.col("u3_strand") == "+", "-").otherwise("+")
    new = {"mode": F.lit(DUAL), "strand": opposite, "pos": F.col("_site_pos").cast("long"), "leader": F.col("_leader")}
    return out.select(*[F.when(F.col("_dual"), new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in df.columns])


def dual_detections(df: DataFrame, scope: list[str], reach: int = 6, distance: int = 2, work: Workspace | None = None) -> DataFrame:
    """The sites seen from both ends (see label_duals) with their reads and break lengths, distinct per replicate."""
    site = [*scope, "chrom", "strand", "pos", "leader"]
    rows = label_duals(df.select(*scope, "chrom", "strand", "pos", "mode", "leader", "reads", "replicate", "width"), scope, reach, distance, work).where(F.col("mode") == DUAL)
    per_rep = rows.groupBy(*site, "replicate").agg(F.sum("reads").alias("r"), F.count_distinct("width").alias("w"))
    return per_rep.groupBy(*site).agg(F.sum("r").alias("reads"), F.sum("w").alias("sonic_lengths"))


def orient_sites(df: DataFrame, distance: int = 2) -> DataFrame:
    """Df (mode, strand, pos) with U5 and U3 rows shifted and U3 rows turned; rows of mode DUAL stay.

    A mode is of an end if it contains its name. Once a row of the input has the mode U5 or U3, rows of any other
    mode (a null one included) are left out; without such a row nothing changes.
    """
    seen = df.agg(F.coalesce(F.bool_or(F.col("mode").isin("U3", "U5")), F.lit(False)).alias("_any"))  # one row
    ended = F.col("mode").contains("U3") | F.col("mode").contains("U5")
    rows = df.join(F.broadcast(seen)).where(~F.col("_any") | (F.col("mode") == DUAL) | ended)
    moved = F.col("_any") & (F.col("mode") != DUAL)
    new = {"strand": oriented_strand(F.col("mode"), F.col("strand")), "pos": shifted_position(F.col("strand"), F.col("pos"), distance)}
    return rows.select(*[F.when(moved, new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in df.columns])


def annotate_nearest(sites: DataFrame, genes: DataFrame, exons: DataFrame, keys: list[str], work: Workspace | None = None) -> DataFrame:
    """J8, J9, J11, §2.13 l: in_gene, in_exon, nearest_gene, nearest_dist, nearest_strand, before_nearest per distinct site.

    sites: keys, pos. genes, exons: keys, start, end, strand, gene (inclusive intervals; strand is
    ignored in distances). All nearest genes are joined by commas in order of start, end, gene. A site on a
    chromosome without genes keeps in_gene false and null nearest columns. With a work folder, sites and genes
    are written there once.
    """
    spots = Workspace.settle(sites.select(*keys, F.col("pos").cast("long").alias("pos")).distinct(), work, "sites")
    genes = genes.select(*keys, "start", "end", F.col("strand").alias("gene_strand"), "gene")
    near = nearest_join(spots, genes, keys, "pos", "start", "end", work=work)
    named = near.groupBy(*keys, "pos").agg(
        F.min("distance").alias("nearest_dist"), F.min("start").alias("_first"), F.array_sort(F.collect_set(F.struct("start", "end", "gene", "gene_strand"))).alias("_hits")
    )
    unique = F.array_distinct(F.transform("_hits", lambda h: F.struct(h["gene"].alias("gene"), h["gene_strand"].alias("strand"))))
    named = named.select(
        *keys, "pos", "nearest_dist", F.array_join(unique["gene"], ",").alias("nearest_gene"), F.array_join(unique["strand"], ",").alias("nearest_strand"), (F.col("pos") < F.col("_first")).alias("before_nearest")
    )
    exonic = overlap_join(spots, exons.select(*keys, "start", "end"), keys, "pos", "start", "end", how="left_semi").select(*keys, "pos", F.lit(True).alias("in_exon"))
    out = spots.join(named, [*keys, "pos"], "left").join(exonic, [*keys, "pos"], "left")
    return out.select(*keys, "pos", F.coalesce(F.col("nearest_dist") == 0, F.lit(False)).alias("in_gene"), F.coalesce("in_exon", F.lit(False)).alias("in_exon"), "nearest_gene", "nearest_dist", "nearest_strand", "before_nearest")


def annotate_repeats(sites: DataFrame, repeats: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct names and classes of the repeats over each distinct site, in order of the repeat table.

    repeats: keys, start, end, ord, name, class. Sites outside repeats have nulls.
    """
    spots = sites.select(*keys, F.col("pos").cast("long").alias("pos")).distinct()
    hits = overlap_join(spots, repeats.select(*keys, "start", "end", "ord", "name", "class"), keys, "pos", "start", "end")
    listed = hits.groupBy(*keys, "pos").agg(F.array_sort(F.collect_set(F.struct("ord", "name", "class"))).alias("_h"))
    text = lambda field: F.array_join(F.array_distinct(F.transform("_h", lambda h: h[field])), ",")
    return spots.join(listed.select(*keys, "pos", text("name").alias("repeat_name"), text("class").alias("repeat_class")), [*keys, "pos"], "left")


def recovery_metrics(truth: DataFrame, seen: DataFrame, keys: list[str], reach: int, work: Workspace) -> DataFrame:
    """One row with the known positions expected, recovered and missing, the positions seen and those of them that no
    known one explains, and the percentage recovered (null without known positions).

    truth and seen: keys and pos; repeats count once, rows with a null not at all. Two positions at most reach apart are one.
    """
    sides = [work.write(df.select(*keys, F.col("pos").alias(name)).dropna().distinct(), name) for df, name in ((truth, "true_pos"), (seen, "site_pos"))]
    near = work.write(band_join(*sides, keys, "true_pos", "site_pos", reach).select(*keys, "true_pos", "site_pos"), "near")
    counts = {"n_expected": sides[0], "n_sites": sides[1], "n_recovered": near.select(*keys, "true_pos").distinct(), "n_explained": near.select(*keys, "site_pos").distinct()}
    tally = reduce(DataFrame.union, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in counts.items()])
    row = tally.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in counts])
    percent = F.round(F.try_divide(F.lit(100.0) * F.col("n_recovered"), F.col("n_expected")), 2)
    return row.select("n_expected", "n_recovered", (F.col("n_expected") - F.col("n_recovered")).alias("n_missing"), "n_sites", (F.col("n_sites") - F.col("n_explained")).alias("n_imagined"), percent.alias("percent_recovered"))
