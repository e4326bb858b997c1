"""Operators on DNA strings: barcodes, quality trimming, Golay correction, consensus (F1-F4, W5, W10, A21, A22, §2.13 b-d, m)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.functions.genome import revcomp
from sitewright.session import Workspace


def mismatches(a: Column, b: Column) -> Column:
    """Number of differing letters of two strings of one length; null for different lengths. N is a letter."""
    letters = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.when(F.length(a) == F.length(b), F.aggregate(letters, F.lit(0), lambda s, x: s + x))


def within(a: Column, b: Column, most: int) -> Column:
    """Whether two strings have one length and at most `most` differing letters; null for a null."""
    if most <= 1:  # for strings of one length a Levenshtein distance up to 1 is the number of substitutions
        return (F.length(a) == F.length(b)) & (F.levenshtein(a, b, most) >= 0)
    return (F.length(a) == F.length(b)) & (mismatches(a, b) <= most)


def match_barcodes(reads: DataFrame, seq: str, barcodes: DataFrame, barcode: str, most: int = 1) -> DataFrame:
    """each distinct read sequence with every distinct barcode of its length at most `most` substitutions away.

    Two such strings agree in one of most + 1 equal segments, so the theta join is an equi-join on the length
    and the segments, whose candidates are then counted exactly. Barcodes may have several lengths. Columns:
    seq, barcode, mismatches.
    """
    cut = lambda c, i: F.floor((F.length(c) * i + (most + 1) // 2) / (most + 1)).cast("int")
    segment = lambda c, i: F.struct(F.length(c).alias("n"), F.lit(i).alias("i"), F.substring(c, cut(c, i) + 1, cut(c, i + 1) - cut(c, i)).alias("s"))
    listed = lambda df, c: df.select(c).where(F.length(c) > 0).distinct().withColumn("_seg", F.explode(F.array(*[segment(F.col(c), i) for i in range(most + 1)])))
    both = listed(reads, seq).join(listed(barcodes, barcode), "_seg")
    if most == 1:  # for strings of one length a Levenshtein distance up to 1 is the number of substitutions
        near = F.levenshtein(seq, barcode, 1)
        return both.where(near >= 0).select(seq, barcode, near.alias("mismatches")).distinct()
    return both.withColumn("mismatches", mismatches(F.col(seq), F.col(barcode))).where(F.col("mismatches") <= most).select(seq, barcode, "mismatches").distinct()


def match_anywhere(reads: DataFrame, seq: str, patterns: DataFrame, pattern: str, most: int = 1, overhang: bool = False) -> DataFrame:
    """F1, §2.13 b: each distinct sequence with the first place (from 1) at which a pattern lies in it, at most `most` substitutions away.

    overhang: the pattern may reach over either end of the sequence, and the letters beyond count as substitutions.
    A pattern of n letters with few substitutions has one of most + 1 segments unchanged, so that each window is
    an equi-join on the segment and its place. Columns: seq, pattern, place, mismatches.
    """
    pad = most if overhang else 0
    wide = patterns.select(pattern).where(F.length(pattern) > most).distinct()
    cut = lambda i: F.floor(F.length(pattern) * i / (most + 1)).cast("int")
    parts = wide.withColumn("_seg", F.explode(F.array(*[F.struct(cut(i).alias("from"), F.substring(F.col(pattern), cut(i) + 1, cut(i + 1) - cut(i)).alias("s")) for i in range(most + 1)])))
    sizes = [r[0] for r in parts.select(F.length("_seg.s")).distinct().limit(1000).collect()]  # lengths, not patterns
    padded = reads.select(seq).where(F.col(seq).isNotNull()).distinct().withColumn("_text", F.concat(F.repeat(F.lit("\0"), F.lit(pad)), seq, F.repeat(F.lit("\0"), F.lit(pad))))
    grams = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("_text") - n + 1, F.lit(1))), lambda p: F.struct(p.alias("p"), F.substring(F.col("_text"), p, F.lit(n)).alias("s")))
    windows = padded.withColumn("_w", F.explode(F.concat(*[grams(n) for n in sizes]))) if sizes else padded.limit(0).withColumn("_w", F.struct(F.lit(1).alias("p"), F.lit("").alias("s")))
    near = windows.join(parts, F.col("_w.s") == F.col("_seg.s")).withColumn("_at", F.col("_w.p") - F.col("_seg.from"))
    inside = near.where((F.col("_at") >= 1) & (F.col("_at") + F.length(pattern) - 1 <= F.length("_text")))
    hits = inside.withColumn("mismatches", mismatches(F.substring(F.col("_text"), F.col("_at"), F.length(pattern)), F.col(pattern))).where(F.col("mismatches") <= most)
    return hits.groupBy(seq, pattern).agg(F.min(F.struct((F.col("_at") - pad).alias("place"), "mismatches")).alias("_h")).select(seq, pattern, "_h.place", "_h.mismatches")


def assign_reads(reads: DataFrame, read: str, seq: str, barcodes: DataFrame, barcode: str, most: int = 1) -> DataFrame:
    """read and barcode of the reads that match exactly one barcode; all others are left out.

    Sequences are matched once, however many reads have them.
    """
    matched = match_barcodes(reads, seq, barcodes, barcode, most)
    single = matched.groupBy(seq).agg(F.count("*").alias("_n"), F.min(barcode).alias(barcode)).where("_n = 1").select(seq, barcode)
    per_read = reads.select(read, seq).distinct().join(single, seq)
    once = per_read.groupBy(read).agg(F.count("*").alias("_n"), F.min(barcode).alias(barcode)).where("_n = 1")
    return once.select(read, barcode)


def last_starts(seqs: pa.Array, patterns: pa.Array, most: int, overhang: bool) -> np.ndarray:
    """For each pair of ASCII strings the start (from 1) of the pattern's last place with at most `most` substitutions, 0 for none."""
    flat = lambda x: pa.concat_arrays([x.fill_null("").cast(pa.large_string()), pa.array([], pa.large_string())])
    offsets = lambda x: np.frombuffer(x.buffers()[1], np.int64, len(x) + 1)
    letters = lambda x, n: np.append(np.frombuffer(x.buffers()[2] or b"", np.uint8)[:n], np.uint8(0))
    seqs, patterns = flat(seqs), flat(patterns)
    so, po = offsets(seqs), offsets(patterns)
    text, probe = letters(seqs, so[-1]), letters(patterns, po[-1])
    size, width = np.diff(so), np.diff(po)
    places = np.where(width > 0, np.maximum(size + (most if overhang else 0) - width + 1, 0), 0)
    row = np.repeat(np.arange(len(seqs)), places)
    place = np.arange(len(row)) - (np.cumsum(places) - places)[row]
    wrong = np.zeros(len(row), np.int32)
    for j in range(int(width.max(initial=0))):
        at = so[row] + place + j
        same = (at < so[row + 1]) & (text[np.minimum(at, len(text) - 1)] == probe[np.minimum(po[row] + j, len(probe) - 1)])
        wrong += (j < width[row]) & ~same
    last = np.zeros(len(seqs), np.int32)
    np.maximum.at(last, row[wrong <= most], (place[wrong <= most] + 1).astype(np.int32))
    return last


def last_match(seq: Column, pattern: Column, most: int = 1, overhang: bool = True) -> Column:
    """§2.10: start (from 1) of the last place in seq at which pattern lies with at most `most` substitutions.

    overhang: the pattern may reach over the end of seq, and the letters beyond count as substitutions. 0
    without such a place, for a null and for an empty pattern.
    """

    @F.pandas_udf("int")
    def start(s: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series(last_starts(pa.array(s, pa.string(), from_pandas=True), pa.array(p, pa.string(), from_pandas=True), most, overhang))

    return start(seq, pattern)


def orientation_vote(reads: DataFrame, seq: str, barcodes: DataFrame, barcode: str) -> DataFrame:
    """One row with how many reads are a barcode as they are, how many reversed, and whether the latter are more."""
    listed = barcodes.select(F.col(barcode).alias(seq)).distinct()
    counts = reads.groupBy(seq).agg(F.count("*").alias("n"))
    hits = lambda c, name: counts.withColumn(seq, c).join(listed, seq, "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))
    both = hits(F.col(seq), "n_forward").join(hits(revcomp(F.col(seq)), "n_reverse"))  # one row each
    return both.withColumn("reverse", F.col("n_reverse") > F.col("n_forward"))


def trim_lengths(quality: pa.Array, least: int = 10, events: int = 2, half_width: int = 3) -> np.ndarray:
    """How many bases each Phred+33 string keeps.

    A base is low if its quality is at most `least`. The string is cut before the first base around which
    a window of 2 * half_width + 1 bases (the end bases repeated) has `events` low ones.
    """
    array = pa.concat_arrays([quality.fill_null("").cast(pa.large_string()), pa.array([], pa.large_string())])
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1)
    size = np.diff(offsets)
    if not size.sum():
        return size
    data = np.frombuffer(array.buffers()[2], np.uint8)[: offsets[-1]]
    low = (data <= 33 + least).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(low)])
    row = np.repeat(np.arange(len(array)), size)
    at = np.arange(len(data))
    first, last = offsets[:-1][row], offsets[1:][row] - 1
    a, b = np.maximum(at - half_width, first), np.minimum(at + half_width, last)
    count = total[b + 1] - total[a] + (half_width - (at - a)) * low[first] + (half_width - (b - at)) * low[last]
    bad = np.flatnonzero(count >= events)
    keep = size.copy()
    np.minimum.at(keep, row[bad], bad - offsets[:-1][row[bad]])
    return keep


def quality_trim(df: DataFrame, seq: str, quality: str, **settings: int) -> DataFrame:
    """Df with seq and quality cut; null or empty strings stay as they are."""

    @F.pandas_udf("int")
    def kept(q: pd.Series) -> pd.Series:
        return pd.Series(trim_lengths(pa.array(q, pa.string()), **settings).astype(np.int32))

    cut = df.withColumn("_keep", kept(F.col(quality)))
    return cut.withColumn(seq, F.substring(seq, F.lit(1), F.col("_keep"))).withColumn(quality, F.substring(quality, F.lit(1), F.col("_keep"))).drop("_keep")


# The parity part of the (24,12) code, row by row, and the bits of the bases (N reads as A).
GOLAY_PARITY = (
    "011111111111",
    "111011100010",
    "110111000101",
    "101110001011",
    "111100010110",
    "111000101101",
    "110001011011",
    "100010110111",
    "100101101110",
    "101011011100",
    "110110111000",
    "101101110001",
)
GOLAY_BITS = {"A": (1, 1), "C": (0, 0), "T": (1, 0), "G": (0, 1), "N": (1, 1)}


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Parity-check matrix (12 x 24) and, for each of the 4096 syndromes, the error pattern of at most three bits, or -1."""
    parity = np.array([[int(x) for x in row] for row in GOLAY_PARITY], np.int64)
    check = np.concatenate([np.eye(12, dtype=np.int64), parity.T], axis=1)
    powers = 1 << np.arange(12)
    column = powers @ check
    error = np.full(4096, -1, np.int64)
    error[0] = 0
    for i in range(24):
        error[column[i]] = 1 << i
        for j in range(i):
            error[column[i] ^ column[j]] = 1 << i | 1 << j
            for k in range(j):
                error[column[i] ^ column[j] ^ column[k]] = 1 << i | 1 << j | 1 << k
    return column, error


def golay_correct(df: DataFrame, barcode: str, name: str = "corrected") -> DataFrame:
    """§2.13 m: df with the corrected 12-letter barcode; null where it cannot be corrected.

    Up to three wrong bits are repaired. Any other length, a letter outside ACGTN or null gives null.
    """
    column, error = golay_tables()
    code = np.full(256, 255, np.uint8)
    for letter, (a, b) in GOLAY_BITS.items():
        code[ord(letter)] = a | b << 1
    letters = np.zeros(4, np.uint8)
    for letter in "ACTG":
        letters[GOLAY_BITS[letter][0] | GOLAY_BITS[letter][1] << 1] = ord(letter)

    @F.pandas_udf("string")
    def correct(values: pd.Series) -> pd.Series:
        fits = values.notna() & (values.str.len() == 12)
        out = pd.Series([None] * len(values), dtype=object)
        texts = [v.encode("ascii", "replace") for v in values[fits]]
        if not texts:
            return out
        two = code[np.frombuffer(b"".join(texts), np.uint8).reshape(-1, 12)].astype(np.int64)
        known = (two < 255).all(1)
        bits = np.stack([two & 1, two >> 1 & 1], 2).reshape(len(two), 24)
        syndrome = np.bitwise_xor.reduce(np.where(bits > 0, column[None], 0), axis=1)
        flip = np.where(known, error[syndrome], -1)
        fixed = bits ^ (np.maximum(flip, 0)[:, None] >> np.arange(24) & 1)
        back = letters[fixed[:, 0::2] | fixed[:, 1::2] << 1]
        out[np.flatnonzero(fits)] = [bytes(b).decode() if ok else None for b, ok in zip(back, flip >= 0)]
        return out

    return df.withColumn(name, correct(F.col(barcode)))


def global_row_number(df: DataFrame, order: list[Column], work: Workspace, name: str = "row_number") -> DataFrame:
    """df with a row number over a total order, without a single-task window.

    Rows are range-partitioned by the order and written once; the driver sees one count per partition.
    """
    ordered = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = work.write(ordered, name)
    counts = parts.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before, at = [], 0
    for r in counts:
        before.append((r["_part"], at))
        at += r["n"]
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before long") if before else df.sparkSession.createDataFrame([], "_part int, _before long")
    numbered = parts.withColumn("_n", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    return numbered.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_n") + F.col("_before")).drop("_part", "_n", "_before")


def binned_consensus(df: DataFrame, seq: str, bins: int, first: int, last: int | None, work: Workspace, second: tuple[int, int] | None = None) -> DataFrame:
    """Per bin and sequence position the most frequent base and its share.

    Sequences are ordered by their first 20 letters, then by the letters from..to of second (the genomic part) if given,
    and then whole; bin b ends at row floor(b * n / bins).
    Positions first..last, a report window; without last, to the end of each sequence. Ties go to A, C, G, T in this order; N counts in the denominator only.
    """
    rows = df.where(F.length(seq) > 0).select(seq)
    n = rows.count()
    numbered = global_row_number(rows, [F.substring(seq, 1, 20), *([F.substring(seq, second[0], second[1] - second[0] + 1)] if second else []), F.col(seq)], work)
    binned = numbered.select(seq, F.ceil(F.col("row_number") * bins / F.lit(max(n, 1))).cast("int").alias("bin"))
    # equal sequences of a bin are counted once before their letters are spread
    window = F.substring(F.col(seq), F.lit(first), F.length(seq) if last is None else F.lit(last - first + 1))
    letters = binned.groupBy("bin", seq).agg(F.count("*").alias("k")).select("bin", "k", F.posexplode(F.split(window, "")).alias("at", "base"))
    votes = letters.where("base <> ''").groupBy("bin", "at", "base").agg(F.sum("k").alias("n"))
    total = votes.groupBy("bin", "at").agg(F.sum("n").alias("total"), F.max_by("base", F.when(F.col("base").isin("A", "C", "G", "T"), F.struct(F.col("n"), -F.ascii("base")))).alias("base"), F.max(F.when(F.col("base").isin("A", "C", "G", "T"), F.col("n"))).alias("best"))
    return total.select("bin", (F.col("at") + first).alias("position"), "base", F.round(F.col("best") / F.col("total"), 6).alias("agreement"))
