"""Readers of sequence, alignment and annotation files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.operators.rangejoin import fill_down


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 0) and value of every line, in file order.

    Splits are read in parallel: a line's number is its place in the split plus the lines of the file's
    earlier splits, of which there is one count each.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return lines.join(blocks.select("file", "block", "first", before.alias("before")), ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line_no"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """rec_idx, readid (up to the first blank), seq, quality. Plain or compressed; a compressed file is one split.

    A record whose header does not begin with @ or whose sequence and quality differ in length is an error.
    """
    lines = numbered_lines(spark, path)
    part = lambda i: F.max(F.when(F.col("line_no") % 4 == i, F.col("value")))
    rec = lines.groupBy("file", F.floor(F.col("line_no") / 4).alias("rec_idx")).agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("quality"))
    sound = F.col("head").startswith("@") & (F.length("seq") == F.length("quality"))
    readid = F.when(sound, F.regexp_extract("head", r"^@(\S*)", 1)).otherwise(F.raise_error(F.concat(F.lit("broken record "), F.col("rec_idx").cast("string"))))
    return rec.select("rec_idx", readid.alias("readid"), "seq", "quality")


def read_fastq_triplet(spark: SparkSession, index: str, adrift: str, anchor: str) -> DataFrame:
    """The three files of a run joined by record; differing ids or record counts are an error."""
    sides = [read_fastq(spark, p).select("rec_idx", *[F.col(c).alias(f"{n}_{c}") for c in ("readid", "seq", "quality")]) for n, p in (("i1", index), ("r1", adrift), ("r2", anchor))]
    rows = sides[0].join(sides[1], "rec_idx", "full").join(sides[2], "rec_idx", "full")
    same = F.coalesce((F.col("i1_readid") == F.col("r1_readid")) & (F.col("i1_readid") == F.col("r2_readid")), F.lit(False))
    readid = F.when(same, F.col("i1_readid")).otherwise(F.raise_error(F.concat(F.lit("read ids differ in record "), F.col("rec_idx").cast("string"))))
    return rows.select("rec_idx", readid.alias("readid"), F.col("i1_seq").alias("i1"), F.col("r1_seq").alias("r1"), F.col("r1_quality").alias("q1"), F.col("r2_seq").alias("r2"), F.col("r2_quality").alias("q2"))


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated sheet whose identifiers stay text, whatever they look like."""
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    return rows.withColumn("replicate", F.col("replicate").cast("int"))


# The columns of the external programs' tables.
PSL_COLUMNS = "matches int, misMatches int, repMatches int, nCount int, qNumInsert int, qBaseInsert int, tNumInsert int, tBaseInsert int, strand string, qName string, qSize int, qStart int, qEnd int, tName string, tSize int, tStart int, tEnd int, blockCount int, blockSizes string, qStarts string, tStarts string"
BLAST_COLUMNS = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double"
TBLOUT_COLUMNS = ("targetName", "targetAcc", "queryName", "queryAcc", "hmmStart", "hmmEnd", "targetStart", "targetEnd", "envStart", "envEnd", "seqLength", "strand", "fullEval", "fullScore", "bias", "desc")
REPEAT_COLUMNS = ("SW_score", "percent_div", "percent_del", "percent_ins", "query_seq", "query_start", "query_end", "query_after", "strand", "repeat_name", "repeat_class", "repeat_start", "repeat_end", "repeat_after", "ID", "alt")
GENEPRED_COLUMNS = "bin string, name string, chrom string, strand string, txStart int, txEnd int, cdsStart int, cdsEnd int, exonCount int, exonStarts string, exonEnds string, score int, name2 string, cdsStartStat string, cdsEndStat string, exonFrames string"


def read_psl(spark: SparkSession, path: str) -> DataFrame:
    """Alignments without header, starts counted from 1, with the widths."""
    rows = spark.read.csv(path, sep="\t", schema=PSL_COLUMNS)
    return rows.withColumn("qStart", F.col("qStart") + 1).withColumn("tStart", F.col("tStart") + 1).withColumn("qWidth", F.col("qEnd") - F.col("qStart") + 1).withColumn("tWidth", F.col("tEnd") - F.col("tStart") + 1)


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits, 11 columns."""
    return spark.read.csv(path, sep="\t", schema=BLAST_COLUMNS)


def _fields(spark: SparkSession, path: str, names: tuple[str, ...], keep: Column) -> DataFrame:
    cells = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(keep).select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_tblout(spark: SparkSession, path: str) -> DataFrame:
    """Profile hits; comment lines start with #."""
    rows = _fields(spark, path, TBLOUT_COLUMNS, ~F.col("value").startswith("#") & (F.trim("value") != ""))
    whole = ("hmmStart", "hmmEnd", "targetStart", "targetEnd", "envStart", "envEnd", "seqLength")
    return rows.withColumns({c: F.col(c).cast("int") for c in whole} | {c: F.col(c).cast("double") for c in ("fullEval", "fullScore", "bias")})


def best_hits(hits: DataFrame, read: str, score: str, order: str) -> DataFrame:
    """One hit per read, the best score and of equal ones the first by order."""
    best = F.max_by(F.struct(*[c for c in hits.columns if c != read]), F.struct(F.col(score), -F.col(order)))
    return hits.groupBy(read).agg(best.alias("_h")).select(read, "_h.*")


# The keys of a profile's parameter file.
HMM_KEYS = ("HMMminStartPos", "HMMmaxStartPos", "HMMminFullBitScore", "HMMmaxFullBitScore", "HMMmatchEnd", "HMMmatchTerminalSeq", "HMMmatchEndRadius")


def read_hmm_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """One row per profile NAME.cfg / NAME.hmm of a folder, with the columns that hmm_gate takes.

    A file without exactly the seven keys, with values of the wrong type or empty ranges, or without a
    length in its profile is an error.
    """
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[a-z]+$", 1).alias("queryName")
    cells = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(f"{folder}/*.cfg").where(F.trim("value") != "").select(stem, F.get(cells, F.lit(0)).alias("key"), F.get(cells, F.lit(1)).alias("x"))
    lengths = spark.read.text(f"{folder}/*.hmm").where(F.col("value").rlike(r"^LENG\s+\d+")).select(stem, F.regexp_extract("value", r"^LENG\s+(\d+)", 1).cast("int").alias("hmmLength"))
    value = lambda key: F.max(F.when(F.col("key") == key, F.col("x")))
    raw = lines.groupBy("queryName").agg(F.count("*").alias("n"), *[value(k).alias(k) for k in HMM_KEYS]).join(lengths, "queryName", "left")
    whole = lambda c: F.when(F.col(c).rlike(r"^[+-]?\d+(\.0*)?$"), F.col(c).cast("double").cast("int"))
    score = lambda c: F.expr(f"try_cast({c} as double)")
    rows = raw.select(
        "queryName", "n", "hmmLength", whole(HMM_KEYS[0]).alias("minStart"), whole(HMM_KEYS[1]).alias("maxStart"), score(HMM_KEYS[2]).alias("minScore"), score(HMM_KEYS[3]).alias("maxScore"),
        F.when(F.upper(HMM_KEYS[4]).isin("TRUE", "FALSE"), F.upper(HMM_KEYS[4]) == "TRUE").alias("matchEnd"), F.upper(HMM_KEYS[5]).alias("motif"), whole(HMM_KEYS[6]).alias("endRadius"),
    )
    sound = (F.col("n") == len(HMM_KEYS)) & (F.col("minStart") >= 1) & (F.col("maxStart") >= F.col("minStart")) & (F.col("maxScore") >= F.col("minScore")) & F.col("matchEnd").isNotNull()
    sound = sound & F.col("motif").rlike("^(NONE|[ACGTN]+)$") & (F.col("endRadius") >= 0) & F.col("hmmLength").isNotNull()
    name = F.when(F.coalesce(sound, F.lit(False)), F.col("queryName")).otherwise(F.raise_error(F.concat(F.lit("unusable parameters of profile "), "queryName")))
    return rows.select(name.alias("queryName"), *[c for c in rows.columns if c not in ("queryName", "n")])


def read_repeats(spark: SparkSession, path: str) -> DataFrame:
    """A RepeatMasker table; its three header lines have no whole number first. Strand C is -."""
    rows = _fields(spark, path, REPEAT_COLUMNS, F.col("value").rlike(r"^\s*\d+\s"))
    rows = rows.withColumns({c: F.col(c).cast("int") for c in ("SW_score", "query_start", "query_end")})
    return rows.withColumn("strand", F.when(F.col("strand") == "C", "-").otherwise(F.col("strand"))).where("strand in ('+', '-')")


def _genepred_rows(spark: SparkSession, path: str) -> DataFrame:
    """The lines of gene predictions as columns, with the first fault of a line as reason (null for a sound one)."""
    fields = [f.split() for f in GENEPRED_COLUMNS.split(", ")]
    cells = F.split("value", "\t", -1)
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", cells.alias("c"), F.size(cells).alias("n"))

    def cell(i: int, name: str, kind: str) -> Column:
        # 16 columns with a bin, 15 without, 10 without what follows the exons either
        text = F.when(F.col("n") == 16, F.get("c", F.lit(i))).when((F.col("n") == 15) | (i <= 10), F.get("c", F.lit(i - 1)))
        return (text.try_cast("int") if kind == "int" else text).alias(name)

    rows = lines.select("value", "n", *[cell(i, name, kind) for i, (name, kind) in enumerate(fields)])
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.try_cast("int"))
    rows = rows.withColumn("score", F.when(F.col("n") == 10, 0).otherwise(F.col("score"))).withColumn("exonStarts", numbers("exonStarts")).withColumn("exonEnds", numbers("exonEnds"))
    exons = F.forall(F.arrays_zip("exonStarts", "exonEnds"), lambda e: (e["exonStarts"] < e["exonEnds"]) & (e["exonStarts"] >= F.col("txStart")) & (e["exonEnds"] <= F.col("txEnd")))
    checks = {
        "columns": F.col("n").isin(10, 15, 16),
        "strand": F.col("strand").isin("+", "-"),
        "transcript": (F.col("txStart") >= 0) & (F.col("txStart") < F.col("txEnd")),
        "coding": (F.col("cdsStart") >= F.col("txStart")) & (F.col("cdsEnd") <= F.col("txEnd")),
        "exon count": (F.size("exonStarts") == F.col("exonCount")) & (F.size("exonEnds") == F.col("exonCount")),
        "exons": exons,
    }
    return rows.withColumn("reason", F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def read_genepred(spark: SparkSession, path: str) -> DataFrame:
    """The sound lines of gene predictions of 10, 15 or 16 columns; name2 is null where there are 10, bin where
    there are fewer than 16. rejected_genepred has the others."""
    return _genepred_rows(spark, path).where("reason is null").drop("value", "n", "reason")


def rejected_genepred(spark: SparkSession, path: str) -> DataFrame:
    """Value and reason of the lines that read_genepred leaves out: columns, strand, transcript, coding, exon count, exons."""
    return _genepred_rows(spark, path).where("reason is not null").select("value", "reason")


def select_chromosomes(df: DataFrame, column: str, pattern: str | None = None, listed: DataFrame | None = None) -> DataFrame:
    """F16: the rows of the chromosomes in listed (one column of the same name) or, without it, of those that pattern
    matches; all rows without either. A listed chromosome that df does not have is an error; null is no chromosome."""
    if listed is None:
        return df if pattern is None else df.where(F.col(column).rlike(pattern))
    names = listed.select(column).where(F.col(column).isNotNull()).distinct()
    missing = names.join(df.select(column).distinct(), column, "left_anti").take(5)
    if missing:
        raise ValueError(f"chromosomes not present: {', '.join(r[0] for r in missing)}")
    return df.join(names, column, "left_semi")


def transcripts(genes: DataFrame) -> DataFrame:
    """Transcription units, 1-based."""
    return genes.select("chrom", (F.col("txStart") + 1).alias("start"), F.col("txEnd").alias("end"), "strand", "name", F.col("name2").alias("gene"))


def exons(genes: DataFrame) -> DataFrame:
    """One row per exon, named by its place, 1-based."""
    e = genes.select("chrom", "strand", F.col("name2").alias("gene"), F.posexplode(F.arrays_zip("exonStarts", "exonEnds")).alias("k", "e"))
    return e.select("chrom", (F.col("e.exonStarts") + 1).alias("start"), F.col("e.exonEnds").alias("end"), "strand", F.concat(F.lit("exon "), (F.col("k") + 1).cast("string")).alias("name"), "gene")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster, readid, is_rep and cluster_size of a greedy clustering's report.

    A header's cluster holds for the lines after it. The header before a line is found by bucketed
    windows, not by one window over the file.
    """
    lines = numbered_lines(spark, path)
    heads = lines.where(F.col("value").startswith(">")).select("file", F.col("line_no").alias("edge"), F.trim(F.regexp_replace("value", "^>Cluster", "")).cast("int").alias("cluster"))
    members = lines.where(~F.col("value").startswith(">")).withColumnRenamed("line_no", "pos")
    above = fill_down(members, heads.select("file", "edge"), ["file"])
    rows = members.join(above, ["file", "pos"]).join(heads, ["file", "edge"])
    named = rows.select("file", "cluster", F.regexp_extract("value", r">(.*?)\.\.\.", 1).alias("readid"), F.rtrim("value").endswith("*").alias("is_rep"))
    return named.join(named.groupBy("file", "cluster").agg(F.count("*").alias("cluster_size")), ["file", "cluster"]).drop("file")
