"""Queries of the training-data problems 2, 3 and 5 to 8, and the SQL that can express some of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.text import strip_blanks
from sitewright.llm.corpus_encoding import encode_corpus
from sitewright.llm.groups import group_records
from sitewright.llm.incremental import deduplicate
from sitewright.llm.leakage import leaked_items, reparameterised_items
from sitewright.llm.near_duplicates import SketchPlan, similar_pairs
from sitewright.llm.sql import SQL
from sitewright.llm.truncation import cut_documents, cut_rates, prefix_matches
from sitewright.session import Workspace, table

SCOPE = ["trial", "subject", "sample", "mode", "refgenome"]

#: Sketches of DNA strings and of read names (see the README for recall and candidates).
LEADERS = SketchPlan()
READS = SketchPlan()


def _clustered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    cluster = strip_blanks(F.col("clusterid"))
    return table(spark, sf_dir, "buildstdfragments").select("readid", *SCOPE, cluster.alias("cluster")).where("cluster not in ('', 'NA')")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_records(_clustered_reads(spark, sf_dir), "readid", [*SCOPE, "cluster"], Workspace(spark, "p2"))


def p2_cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked groups that touch each sample, beside the count that the pipeline recorded."""
    groups = p2_found(spark, sf_dir)
    touched = _clustered_reads(spark, sf_dir).select("readid", *SCOPE).distinct().join(groups, "readid").groupBy(*SCOPE).agg(F.count_distinct("groupid").alias("n_groups"))
    recorded = table(spark, sf_dir, "multihit_clusters").groupBy("trial", "subject", "sample", F.col("ref_genome").alias("refgenome"), "mode").agg(F.max("total_clusters").alias("total_clusters"))
    return recorded.join(touched, SCOPE, "left").select(*SCOPE, F.coalesce("n_groups", F.lit(0)).alias("n_groups"), "total_clusters")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "p3")
    leader = table(spark, sf_dir, "known_sites").select(F.upper(strip_blanks(F.col("leaderseq"))).alias("value"))
    read = table(spark, sf_dir, "buildstdfragments").select(strip_blanks(F.col("readid")).alias("value"))
    parts = [similar_pairs(values, plan, work, name).select(F.lit(name).alias("field"), "key_a", "key_b") for name, values, plan in (("leaderseq", leader, LEADERS), ("readid", read, READS))]
    return parts[0].union(parts[1])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "samples"), Workspace(spark, "p5")).links.select("accepted_id", "sample_id")


def p5_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The representative of every record after the last batch."""
    return deduplicate(table(spark, sf_dir, "samples"), Workspace(spark, "p5")).representatives


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_reparameterised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reparameterised_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_documents(table(spark, sf_dir, "documents")).select("doc_id")


def p8_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_matches(table(spark, sf_dir, "documents"), Workspace(spark, "p8"))


def p8_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_rates(table(spark, sf_dir, "documents"), Workspace(spark, "p8"))


QUERIES = {
    "p2_found": p2_found,
    "p2_cluster_counts": p2_cluster_counts,
    "p3_found": p3_found,
    "p5_found": p5_found,
    "p5_clusters": p5_clusters,
    "p6_ids": p6_ids,
    "p7_found": p7_found,
    "p7_reparameterised": p7_reparameterised,
    "p8_found": p8_found,
    "p8_prefixes": p8_prefixes,
    "p8_sources": p8_sources,
}

__all__ = ["QUERIES", "SQL"]
