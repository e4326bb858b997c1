"""Roll-ups from reads to fragments to sites, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.session import Workspace


def collapse_duplicates(df: DataFrame, keys: list[str], order: str, first: list[str]) -> DataFrame:
    """A1: one row per key with the number of rows and, of the others, the values of the first row by order. Null keys group together."""
    picked = F.min_by(F.struct(*first), order)
    rows = df.groupBy(*keys).agg(F.count("*").alias("n_reads"), picked.alias("_first"))
    return rows.select(*keys, "n_reads", *[F.col(f"_first.{c}").alias(c) for c in first])


def modal_value(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value per key by number of rows; ties give the least value. Nulls do not count.

    Two aggregates with partial results; no group is gathered or sorted.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = counts.groupBy(*keys).agg(F.max("_n").alias("_n"))
    return counts.join(best, [*keys, "_n"]).groupBy(*keys).agg(F.min(value).alias(name))


def fragment_rollup(df: DataFrame, keys: list[str], reads: str, read: str, leader: str, min_reads: int = 1, first: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """Reads, number of records and of distinct reads and the modal leader of every fragment with enough reads.

    first: columns taken from the first row by order. The reads and UMIs themselves are in fragment_members.
    """
    rest = [F.min_by(F.struct(*first), order).alias("_first")] if first else []
    sums = df.groupBy(*keys).agg(F.sum(reads).alias("reads"), F.count("*").alias("n_records"), F.count_distinct(read).alias("n_distinct_reads"), *rest).where(F.col("reads") >= min_reads)
    sums = sums.select(*keys, "reads", "n_records", "n_distinct_reads", *[F.col(f"_first.{c}").alias(c) for c in first])
    return sums.join(modal_value(df, keys, leader, "rep_leader"), keys, "left")


def fragment_members(df: DataFrame, keys: list[str], members: dict[str, str]) -> DataFrame:
    """What a fragment consists of, one row per kind (read, UMI), fragment and distinct value, with its records.

    members: kind -> column. Rows instead of lists, for one fragment may hold a third of all reads. Nulls are no member.
    """
    spread = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in members.items()])))
    return spread.where("value is not null").groupBy(*keys, "kind", "value").agg(F.count("*").alias("n_records"))


def site_rollup(df: DataFrame, keys: list[str], replicate: str, width: str, reads: str, work: Workspace | None = None) -> DataFrame:
    """Reads, replicates seen, and break lengths distinct per replicate (summed) and over the whole site."""
    per_width = Workspace.settle(df.groupBy(*keys, replicate, width).agg(F.sum(reads).alias("_reads")), work, "widths")
    per_rep = per_width.groupBy(*keys, replicate).agg(F.sum("_reads").alias("_reads"), F.count(width).alias("_widths"))
    sites = per_rep.groupBy(*keys).agg(F.sum("_reads").alias("reads"), F.sum("_widths").alias("sonic_lengths"), F.count("*").alias("n_reps_obs"))
    across = per_width.select(*keys, width).distinct().groupBy(*keys).agg(F.count(width).alias("sonic_lengths_sample"))
    return sites.join(across, keys)


def site_umis(df: DataFrame, keys: list[str], umi: str, masked: str = "AAAAAAAAAAAA") -> DataFrame:
    """Number of distinct UMIs per site; null for all sites if no UMI of the whole input is a real one."""
    distinct = df.groupBy(*keys).agg(F.count_distinct(umi).alias("n_umis"))
    real = df.agg(F.coalesce(F.bool_or(F.col(umi) != masked), F.lit(False)).alias("_real"))  # one row
    return distinct.join(F.broadcast(real)).withColumn("n_umis", F.when(F.col("_real"), F.col("n_umis"))).drop("_real")


#: Replicates for which columns are made at most.
MOST_REPLICATES = 500


def replicate_range(df: DataFrame, replicate: str) -> list[int]:
    """Every replicate from the least to the greatest of the whole input, gaps included; too many are an error."""
    low, high = df.agg(F.min(replicate), F.max(replicate)).first()
    if low is None:
        return []
    if high - low >= MOST_REPLICATES:
        raise ValueError(f"replicates from {low} to {high}: more than {MOST_REPLICATES} columns")
    return list(range(low, high + 1))


def replicate_columns(df: DataFrame, keys: list[str], replicate: str, replicates: list[int], width: str, reads: str, umi: str | None = None, leader: str | None = None) -> DataFrame:
    """rep<N>_reads and rep<N>_sonic_lengths for every replicate in the list (see replicate_range), null where it is missing.

    With umi and leader also rep<N>_umis (distinct ones) and rep<N>_rep_leader (see consensus_leader).
    """
    if not replicates:
        return df.select(*keys).distinct()
    columns = ["reads", "sonic_lengths", *(["umis"] if umi else []), *(["rep_leader"] if leader else [])]
    per_rep = df.groupBy(*keys, replicate).agg(F.sum(reads).alias("reads"), F.count_distinct(width).alias("sonic_lengths"), *([F.count_distinct(umi).alias("umis")] if umi else []))
    if leader:
        per_rep = per_rep.join(consensus_leader(df.where(F.col(leader).isNotNull()), [*keys, replicate], leader, width, reads), [*keys, replicate], "left")
    wide = per_rep.groupBy(*keys).pivot(replicate, replicates).agg(*[F.first(c).alias(c) for c in columns])
    return wide.select(*keys, *[F.col(f"`{n}_{c}`").alias(f"rep{n}_{c}") for n in replicates for c in columns])


def relative_abundance(sites: DataFrame, group: list[str], amount: str, name: str = "percent_rel_abund") -> DataFrame:
    """Percentage of the amount within the group, two decimals.

    The totals are a grouped aggregate joined back, so a group with a third of all sites is no single task.
    """
    totals = sites.groupBy(*group).agg(F.sum(amount).alias("_total"))
    return sites.join(totals, group).withColumn(name, F.round(F.lit(100.0) * F.col(amount) / F.col("_total"), 2)).drop("_total")


def consensus_leader(df: DataFrame, keys: list[str], leader: str, width: str, reads: str) -> DataFrame:
    """The leader with the most distinct widths, then the most reads, then the least one."""
    per = df.groupBy(*keys, leader).agg(F.count_distinct(width).alias("_w"), F.sum(reads).alias("_r"))
    most = per.groupBy(*keys).agg(F.max(F.struct("_w", "_r")).alias("_best"))
    tied = per.join(most, keys).where((F.col("_w") == F.col("_best._w")) & (F.col("_r") == F.col("_best._r")))
    return tied.groupBy(*keys).agg(F.min(leader).alias("rep_leader"))


def joined_labels(df: DataFrame, keys: list[str], label: str, name: str, separator: str = ";") -> DataFrame:
    """Sorted distinct non-blank labels of a group in one string."""
    return df.where(F.trim(label) != "").groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(label)), separator).alias(name))


def dominant_class(votes: DataFrame, keys: list[str], member: str, label: str) -> DataFrame:
    """The class most members of a group have, its share, and the classes that tie for the lead.

    Each member votes once for each of its distinct classes; no class is the class `none`. With more
    than one leader the dominant class is `tie`.
    """
    named = votes.select(*keys, member, F.coalesce(F.col(label), F.lit("none")).alias("_class")).distinct()
    counts = named.groupBy(*keys, "_class").agg(F.count("*").alias("_n"))
    size = named.select(*keys, member).distinct().groupBy(*keys).agg(F.count("*").alias("_members"))
    best = counts.groupBy(*keys).agg(F.max("_n").alias("_n"))
    leads = counts.join(best, [*keys, "_n"]).groupBy(*keys).agg(F.array_sort(F.collect_set("_class")).alias("_leads"), F.first("_n").alias("_n"))
    tie = F.size("_leads") > 1
    return leads.join(size, keys).select(
        *keys,
        F.when(tie, "tie").otherwise(F.col("_leads")[0]).alias("dominant_class"),
        F.round(F.lit(100.0) * F.col("_n") / F.col("_members"), 2).alias("dominant_percent"),
        F.when(tie, F.array_join("_leads", ",")).alias("tied_classes"),
    )


def weighted_histogram(df: DataFrame, keys: list[str], x: Column, y: Column, x_width: int, y_width: int, weight: Column) -> DataFrame:
    """Weight and percentage of the group in each bin of a two-dimensional histogram."""
    bins = df.groupBy(*keys, (F.floor(x / x_width) * x_width).alias("x_bin"), (F.floor(y / y_width) * y_width).alias("y_bin")).agg(F.sum(weight).alias("weight"))
    total = bins.groupBy(*keys).agg(F.sum("weight").alias("_total"))
    return bins.join(total, keys).withColumn("percent", F.round(F.lit(100.0) * F.col("weight") / F.col("_total"), 4)).drop("_total")


def display_range(histogram: DataFrame, keys: list[str], least: float) -> DataFrame:
    """Per group the range of the bins of weighted_histogram that hold at least `least` percent of it; a group without
    such a bin is left out."""
    shown = histogram.where(F.col("percent") >= least).groupBy(*keys)
    return shown.agg(*[f(f"{axis}_bin").alias(f"{axis}_{name}") for axis in "xy" for name, f in (("from", F.min), ("to", F.max))], F.sum("weight").alias("weight_shown"))


def whole_percentages(counts: DataFrame, keys: list[str], label: str, n: str) -> DataFrame:
    """Percentages of a group as whole numbers that add up to 100 (largest remainders, ties by label)."""
    w = W.partitionBy(*keys)
    exact = counts.withColumn("_scaled", F.col(n) * 100).withColumn("_sum", F.sum(n).over(w))
    floors = exact.withColumn("_floor", F.floor(F.col("_scaled") / F.col("_sum"))).withColumn("_rest", F.col("_scaled") % F.col("_sum"))
    ranked = floors.withColumn("_rank", F.row_number().over(w.orderBy(F.desc("_rest"), F.asc(label)))).withColumn("_left", F.lit(100) - F.sum("_floor").over(w))
    return ranked.select(*keys, label, n, (F.col("_floor") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0)).cast("long").alias("percent"))
