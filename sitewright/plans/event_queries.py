"""Queries on the star-schema tables: standardization, UMI dominance, roll-up arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.genome import psl_percent_identity, psl_score
from sitewright.operators.fragments import alignment_filter, build_fragments, dominant_umis
from sitewright.operators.rollup import relative_abundance, site_rollup, whole_percentages
from sitewright.operators.standardize import local_maxima, standardize_breakpoints, standardize_positions
from sitewright.session import Workspace, table


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as reads on a coordinate: chromosome = event type, coordinate = hour."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("chrom"), F.when(F.col("user_id") % 2 == 0, "+").otherwise("-").alias("strand"),
        F.floor(F.unix_micros(ts) / 3_600_000_000).cast("long").alias("coord"), F.lit(1).alias("reads"), F.floor("value").cast("long").alias("width"), (F.col("user_id") % 4).alias("replicate"),
    )


_HITS = """hits AS (SELECT event_id, user_id, event_type AS chrom, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS coord, 1 AS reads, CAST(floor(value) AS BIGINT) AS width, user_id % 4 AS replicate FROM events)"""


def _corrected_sql(source: str, keys: list[str], window: int, radius: int, shrink: int) -> str:
    k = ", ".join(keys)
    same = " AND ".join(f"x.{c} = y.{c}" for c in keys)
    spread = 2 * (window / shrink) ** 2
    return f"""w AS (SELECT {k}, coord, sum(reads) AS w FROM {source} GROUP BY {k}, coord),
  a AS (SELECT *, max(w) OVER (PARTITION BY {k} ORDER BY coord RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING) AS top FROM w),
  b AS (SELECT {", ".join(f"x.{c}" for c in keys)}, x.coord, y.coord AS moved,
          row_number() OVER (PARTITION BY {", ".join(f"x.{c}" for c in keys)}, x.coord ORDER BY y.w * exp(-((x.coord - y.coord) * (x.coord - y.coord)) / {spread}) DESC, y.coord) AS rn
        FROM w x JOIN a y ON {same} AND y.coord BETWEEN x.coord - {window} AND x.coord + {window} AND y.w >= y.top),
  s AS (SELECT {", ".join(f"w.{c}" for c in keys)}, w.coord, w.w, coalesce(moved, w.coord) AS corrected
        FROM w LEFT JOIN b ON {" AND ".join(f"w.{c} = b.{c}" for c in keys)} AND w.coord = b.coord AND rn = 1)"""


def site_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: standardize, roll up to sites, relative abundance (a, A9, A10, A12)."""
    work = Workspace(spark, "pipeline")
    moved = standardize_positions(_hits(spark, sf_dir), ["chrom", "strand"], "coord", "reads", 8, 4, 4, work)
    sites = site_rollup(moved.withColumn("posid", F.concat("chrom", "strand", F.col("corrected").cast("string"))), ["chrom", "posid"], "replicate", "width", "reads", work)
    return relative_abundance(work.write(sites, "sites"), ["chrom"], "sonic_lengths")


def position_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_positions(_hits(spark, sf_dir), ["chrom", "strand"], "coord", "reads", 8, 4, 4, Workspace(spark, "positions")).groupBy("chrom", "strand", "coord", "corrected").agg(F.count("*").alias("reads"))


def anchor_local_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_maxima(_hits(spark, sf_dir), ["chrom", "strand"], "coord", "reads", 4)


def _breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", F.datediff("l_shipdate", F.lit("1970-01-01")).alias("coord"), F.lit(1).alias("reads"))


def breakpoint_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_breakpoints(_breaks(spark, sf_dir), ["l_partkey"], "coord", "reads", "l_orderkey", work=Workspace(spark, "breaks")).groupBy("l_partkey", "coord", "corrected").agg(F.count("*").alias("reads"))


_GATED = "SELECT l_partkey FROM breaks GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1 AND count(DISTINCT coord) > 1"
_BREAKS = """breaks AS (SELECT l_partkey, l_orderkey, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS coord, 1 AS reads FROM lineitem)"""


def umi_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("umi"), F.col("event_id").alias("readid"))
    return dominant_umis(rows, ["user_id"], "umi", "event_id", "readid", Workspace(spark, "umis"))


def mate_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as mates: odd lines are anchors, even ones adrift."""
    start = F.datediff("l_shipdate", F.lit("1970-01-01"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("readid"), "l_linenumber", F.col("l_linestatus").alias("chrom"), F.when(F.col("l_returnflag") == "N", "+").otherwise("-").alias("strand"),
        start.alias("start"), (start + F.col("l_quantity").cast("int")).alias("end"),
    )
    return build_fragments(lines.where("l_linenumber % 2 = 1"), lines.where("l_linenumber % 2 = 0"), 2, 60).select("readid", "l_linenumber", "chrom", "strand", "frag_start", "frag_end", "frag_width")


def alignment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8, P12, F10 on integer counters: score, identity and how many alignments pass."""
    q = F.col("l_quantity").cast("int")
    n = F.col("l_linenumber")
    rep, ins = (F.col("l_suppkey") % 5).cast("int"), (F.col("l_partkey") % 3).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", psl_score(q * 3, n, rep, ins, ins).alias("score"), psl_percent_identity(q * 3, n, rep, ins, q * 3 + n, q * 3).alias("percent_id"),
        F.lit(100.0).alias("coverage"), ins.alias("t_inserts"), ins.alias("q_inserts"), F.lit(0).alias("t_bases"), F.lit(0).alias("q_bases"),
    )
    key = ["l_linenumber", "score", "percent_id"]
    passed = alignment_filter(rows).groupBy(*key).agg(F.count("*").alias("n_pass"))
    return rows.groupBy(*key).agg(F.count("*").alias("n")).join(passed, key, "left").select(*key, "n", F.coalesce("n_pass", F.lit(0)).alias("n_pass"))


def largest_remainder_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return whole_percentages(counts, ["user_id"], "event_type", "n")


QUERIES = {
    "site_pipeline": site_pipeline,
    "position_standardize": position_standardize,
    "anchor_local_maxima": anchor_local_maxima,
    "breakpoint_standardize": breakpoint_standardize,
    "umi_dominance": umi_dominance,
    "mate_fragments": mate_fragments,
    "alignment_scores": alignment_scores,
    "largest_remainder_pct": largest_remainder_pct,
}

SQL = {
    "site_pipeline": f"""WITH {_HITS}, {_corrected_sql("hits", ["chrom", "strand"], 8, 4, 4)},
  r AS (SELECT h.chrom, h.chrom || h.strand || s.corrected AS posid, h.replicate, h.width, h.reads FROM hits h JOIN s USING (chrom, strand, coord)),
  pr AS (SELECT chrom, posid, replicate, sum(reads) AS reads, count(DISTINCT width) AS widths FROM r GROUP BY ALL),
  t AS (SELECT chrom, posid, CAST(sum(reads) AS BIGINT) AS reads, CAST(sum(widths) AS BIGINT) AS sonic_lengths, count(*) AS n_reps_obs FROM pr GROUP BY ALL),
  u AS (SELECT chrom, posid, count(DISTINCT width) AS sonic_lengths_sample FROM r GROUP BY ALL)
  SELECT t.*, sonic_lengths_sample, round(100.0 * sonic_lengths / sum(sonic_lengths) OVER (PARTITION BY chrom), 2) AS percent_rel_abund FROM t JOIN u USING (chrom, posid)""",
    "position_standardize": f"WITH {_HITS}, {_corrected_sql('hits', ['chrom', 'strand'], 8, 4, 4)} SELECT chrom, strand, coord, corrected, CAST(w AS BIGINT) AS reads FROM s",
    "anchor_local_maxima": f"WITH {_HITS}, w AS (SELECT chrom, strand, coord, CAST(sum(reads) AS BIGINT) AS w FROM hits GROUP BY ALL) SELECT chrom, strand, coord, w, w >= max(w) OVER (PARTITION BY chrom, strand ORDER BY coord RANGE BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS anchor FROM w",
    "breakpoint_standardize": f"""WITH {_BREAKS}, gated AS (SELECT * FROM breaks WHERE l_partkey IN ({_GATED})), {_corrected_sql("gated", ["l_partkey"], 5, 2, 4)}
  SELECT b0.l_partkey, b0.coord, coalesce(s.corrected, b0.coord) AS corrected, count(*) AS reads FROM breaks b0 LEFT JOIN s USING (l_partkey, coord) GROUP BY ALL""",
    "umi_dominance": """WITH c AS (SELECT user_id, event_type AS umi, count(*) AS n FROM events GROUP BY ALL),
  t AS (SELECT user_id, count(*) AS total FROM events GROUP BY ALL),
  r AS (SELECT c.*, total, n * 100 >= total * 20 AS strong, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, umi) AS rk FROM c JOIN t USING (user_id)),
  s AS (SELECT user_id, count(*) AS k, CAST(sum(n) AS BIGINT) AS held FROM r WHERE strong GROUP BY 1),
  x AS (SELECT r.*, k, held, total >= 10 AND coalesce(k, 0) > 1 AS split FROM r LEFT JOIN s USING (user_id)),
  q AS (SELECT user_id, umi, rk, total, CASE WHEN split THEN n + (total - held) // k ELSE total END AS quota FROM x WHERE CASE WHEN split THEN strong ELSE rk = 1 END),
  f AS (SELECT user_id, umi, rk, CASE WHEN rk = 1 THEN total - sum(CASE WHEN rk > 1 THEN quota ELSE 0 END) OVER (PARTITION BY user_id) ELSE quota END AS quota FROM q),
  g AS (SELECT *, sum(quota) OVER (PARTITION BY user_id ORDER BY rk) AS upto FROM f),
  e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events)
  SELECT e.user_id, e.event_id, g.umi FROM e JOIN g ON e.user_id = g.user_id AND place > upto - quota AND place <= upto""",
    "mate_fragments": """WITH l AS (SELECT l_orderkey AS readid, l_linenumber, l_linestatus AS chrom, CASE WHEN l_returnflag = 'N' THEN '+' ELSE '-' END AS strand,
    date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS INTEGER) AS e FROM lineitem),
  p AS (SELECT a.readid, a.l_linenumber, a.chrom, a.strand, CASE WHEN a.strand = '+' THEN a.s ELSE b.s END AS frag_start, CASE WHEN a.strand = '+' THEN b.e ELSE a.e END AS frag_end
    FROM l a JOIN l b ON a.readid = b.readid AND a.chrom = b.chrom AND a.strand <> b.strand WHERE a.l_linenumber % 2 = 1 AND b.l_linenumber % 2 = 0)
  SELECT *, frag_end - frag_start + 1 AS frag_width FROM p WHERE frag_end - frag_start + 1 BETWEEN 2 AND 60""",
    "alignment_scores": """WITH c AS (SELECT l_linenumber, CAST(l_quantity AS INTEGER) * 3 AS m, l_linenumber AS mis, l_suppkey % 5 AS rep, l_partkey % 3 AS ins FROM lineitem),
  d AS (SELECT l_linenumber, m + (rep >> 1) - mis - ins - ins AS score,
    round(100 - 0.1::DOUBLE * floor((1000 * (mis + ins + round(3 * ln(1 + greatest(0, mis))))) / (m + rep + mis)::DOUBLE), 2) AS percent_id, ins FROM c)
  SELECT l_linenumber, score, percent_id, count(*) AS n, count(*) FILTER (WHERE percent_id >= 95 AND ins <= 1) AS n_pass FROM d GROUP BY ALL""",
    "largest_remainder_pct": """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
  d AS (SELECT *, CAST(sum(n) OVER (PARTITION BY user_id) AS BIGINT) AS t FROM c),
  e AS (SELECT *, (n * 100) // t AS fl, (n * 100) % t AS rest FROM d),
  f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rest DESC, event_type) AS rk, 100 - sum(fl) OVER (PARTITION BY user_id) AS spare FROM e)
  SELECT user_id, event_type, n, CAST(fl + CASE WHEN rk <= spare THEN 1 ELSE 0 END AS BIGINT) AS percent FROM f""",
}
