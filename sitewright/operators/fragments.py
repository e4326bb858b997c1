"""From alignments to fragments and to reads with one or several positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.operators.sequences import global_row_number
from sitewright.session import Workspace


def build_fragments(anchors: DataFrame, adrift: DataFrame, min_width: int = 40, max_width: int = 100_000) -> DataFrame:
    """Concordant mate pairs as fragments.

    anchors, adrift: readid, chrom, strand, start, end (anchors may have more columns). Chromosome
    equality is part of the equi-join, strand and width are its residual. Null values pair with nothing.
    """
    mate = adrift.select("readid", "chrom", F.col("strand").alias("_strand"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    plus = F.col("strand") == "+"
    low, high = F.when(plus, F.col("start")).otherwise(F.col("_start")), F.when(plus, F.col("_end")).otherwise(F.col("end"))
    pairs = anchors.join(mate, ["readid", "chrom"]).where(F.col("strand") != F.col("_strand"))
    rows = pairs.withColumn("frag_start", low).withColumn("frag_end", high).withColumn("frag_width", high - low + 1)
    return rows.where(F.col("frag_width").between(min_width, max_width)).drop("_strand", "_start", "_end")


def alignment_filter(df: DataFrame, min_identity: float = 95, min_coverage: float = 95, max_inserts: int = 1, max_bases: int = 1) -> DataFrame:
    """alignments that are good enough."""
    return df.where((F.col("percent_id") >= min_identity) & (F.col("coverage") >= min_coverage) & (F.greatest("t_inserts", "q_inserts") <= max_inserts) & (F.greatest("t_bases", "q_bases") <= max_bases))


def position_counts(df: DataFrame, read: str, position: str) -> DataFrame:
    """Number of distinct positions of every read."""
    return df.groupBy(read).agg(F.count_distinct(position).alias("n_positions"))


def shortest_fragment(df: DataFrame, keys: list[str], width: Column, order: str) -> DataFrame:
    """The shortest fragment per key, the first by order on ties."""
    best = df.withColumn("_width", width).groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct("_width", order)).alias("_row"))
    return best.select(*keys, "_row.*")


def rescue_reads(df: DataFrame, read: str, position: str, scope: list[str]) -> DataFrame:
    """Read, scope and position of each multi-position read that has exactly one position supported by unique reads of its scope.

    Support is taken from reads with one distinct position and computed once.
    """
    n = position_counts(df, read, position)
    unique = df.join(n.where("n_positions = 1"), read, "left_semi").select(*scope, position).distinct()
    several = df.join(n.where("n_positions > 1"), read, "left_semi").select(read, *scope, position).distinct()
    supported = several.join(unique, [*scope, position], "left_semi")
    return supported.groupBy(read, *scope).agg(F.count("*").alias("_n"), F.min(position).alias(position)).where("_n = 1").select(read, *scope, position)


def anchor_competition(df: DataFrame, cluster: list[str], row_keys: list[str], start: str, end: str, min_difference: int = 5, min_multiple: int = 10) -> DataFrame:
    """A13, §2.13 i: the winner of every cluster with more than one row of row_keys, and how it won.

    `fragments`: at least min_difference more distinct (start, end) than the second; `reads`: at least
    min_multiple times its records; otherwise `removed` without a winner. Clusters of one row are `single`.
    Ties are ordered by row_keys. Only the two best rows of a cluster are ever compared.
    """
    rows = df.groupBy(*cluster, *row_keys).agg(F.count_distinct(start, end).alias("frags"), F.count("*").alias("reads"))
    orders = {"_f": F.struct((-F.col("frags")).alias("a"), (-F.col("reads")).alias("b"), *row_keys), "_r": F.struct((-F.col("reads")).alias("a"), (-F.col("frags")).alias("b"), *row_keys)}
    rows = rows.select(*cluster, *[order.alias(name) for name, order in orders.items()])
    first = rows.groupBy(*cluster).agg(F.min("_f").alias("_f1"), F.min("_r").alias("_r1"))
    # the second best of each order is the best of what is left, again by aggregates with partial results
    left = rows.join(first, cluster)
    second = left.groupBy(*cluster).agg(*[F.min(F.when(F.col(o) != F.col(f"{o}1"), F.col(f"{o}.a"))).alias(f"{o}2") for o in orders])
    top = first.join(second, cluster)
    by = F.when(F.col("_f2").isNull(), "single").when(F.col("_f2") - F.col("_f1.a") >= min_difference, "fragments").when(F.col("_r1.a") <= F.col("_r2") * min_multiple, "reads").otherwise("removed")
    who = lambda k: F.when(F.col("decision") == "reads", F.col(f"_r1.{k}")).when(F.col("decision") != "removed", F.col(f"_f1.{k}"))
    return top.withColumn("decision", by).select(*cluster, "decision", *[who(k).alias(k) for k in row_keys])


def dominant_umis(df: DataFrame, fragment: list[str], umi: str, record: str, read: str, work: Workspace, min_reads: int = 10, min_percent: float = 20) -> DataFrame:
    """§2.13 j, A14, W9: the UMI that each record of a fragment keeps.

    Fragments with fewer than min_reads distinct reads, or with at most one UMI of at least min_percent of
    the records, take their most frequent UMI. Otherwise the UMIs that reach it share the records: their
    percentages are raised evenly to 100, floored to counts, and handed out in record order; the most
    frequent one gets what remains. Ties are alphabetical. The UMIs of a fragment are ranked by a window;
    its records, which may be many, are numbered over the sorted table. Columns: fragment, record, umi.
    """
    counts = df.groupBy(*fragment, umi).agg(F.count("*").alias("n"))
    total = df.groupBy(*fragment).agg(F.count("*").alias("total"), F.count_distinct(read).alias("reads"))
    strong = F.col("n") * 100 >= F.col("total") * min_percent
    ranked = counts.join(total, fragment).withColumn("strong", strong).withColumn("rank", F.row_number().over(W.partitionBy(*fragment).orderBy(F.desc("n"), umi)))
    sums = ranked.where("strong").groupBy(*fragment).agg(F.count("*").alias("k"), F.sum("n").alias("held"))
    shared = ranked.join(sums, fragment, "left").withColumn("split", (F.col("reads") >= min_reads) & (F.coalesce("k", F.lit(0)) > 1))
    kept = shared.where(F.when(F.col("split"), F.col("strong")).otherwise(F.col("rank") == 1))
    # the raised percentage of the records, floored: n + (total - held) / k in whole numbers
    quota = F.when(F.col("split"), F.col("n") + F.floor((F.col("total") - F.col("held")) / F.col("k"))).otherwise(F.col("total"))
    quotas = kept.select(*fragment, F.col(umi).alias("new_umi"), "rank", "total", quota.alias("quota"))
    others = quotas.groupBy(*fragment).agg(F.sum(F.when(F.col("rank") > 1, F.col("quota")).otherwise(0)).alias("others"))
    fixed = quotas.join(others, fragment).withColumn("quota", F.when(F.col("rank") == 1, F.col("total") - F.col("others")).otherwise(F.col("quota")))
    to = F.sum("quota").over(W.partitionBy(*fragment).orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    spans = fixed.withColumn("to", to).withColumn("from", F.col("to") - F.col("quota")).select(*fragment, "new_umi", "from", "to")
    numbered = global_row_number(df.select(*fragment, record), [*map(F.col, fragment), F.col(record)], work)
    begins = numbered.groupBy(*fragment).agg((F.min("row_number") - 1).alias("_before"))
    numbered = numbered.join(begins, fragment).withColumn("_at", F.col("row_number") - F.col("_before"))
    return numbered.join(spans, fragment).where((F.col("_at") > F.col("from")) & (F.col("_at") <= F.col("to"))).select(*fragment, record, F.col("new_umi").alias(umi))
