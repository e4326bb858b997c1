"""Column expressions on positions, strands, DNA strings and alignment scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions.text import bind, strip_blanks


def revcomp(c: Column) -> Column:
    """Reverse complement over the alphabet ACGTN."""
    return F.reverse(F.translate(c, "ACGTNacgtn", "TGCANtgcan"))


def trim_poly_g(c: Column, pattern: str = "G{5,}[ATCN]?G{5,}.*$") -> Column:
    """Remove the first poly-G run and everything after it."""
    return F.regexp_replace(c, pattern, "")


def posid(chrom: Column, strand: Column, pos: Column) -> Column:
    """Chromosome, strand and coordinate as one string, e.g. chr1+123456."""
    return F.concat(chrom, strand, pos.cast("string"))


def parsed_position(c: Column) -> Column:
    """Chrom, strand, pos and posid of a position id as one struct, from one pass over the string.

    One spelling for a position, whatever the outer blanks, letter case or number format: the coordinate may be
    in scientific notation (1.1e+02). Null and blank give a null posid; a string that is no position keeps its
    trimmed lower-case form as posid, so that it stays a key of its own, and has no parts.
    """

    def parts(t: Column, sign: Column, number: Column) -> Column:
        plain = (F.translate(number, "0123456789", "") == "") & F.length(number).between(1, 15)
        whole = F.when(plain, number.try_cast("long")).when(number.rlike(r"^\d+(?:\.\d*)?(?:e[+-]?\d+)?\z"), F.round(number.try_cast("double")).cast("long"))
        chrom = F.substring(t, F.lit(1), sign - 1)
        chrom = F.when(chrom.startswith("chr"), F.concat(F.lit("chr"), F.upper(F.substring(t, F.lit(4), sign - 4)))).otherwise(chrom)
        named = lambda w, found: F.struct(
            F.when(found, chrom).alias("chrom"),
            F.when(found, F.substring(t, sign, F.lit(1))).alias("strand"),
            F.when(found, w).alias("pos"),
            F.when(found, F.concat(chrom, F.substring(t, sign, F.lit(1)), w.cast("string"))).when(t != "", t).alias("posid"),
        )
        return bind(whole, lambda w: named(w, (sign > 1) & w.isNotNull()))

    first = lambda t: F.coalesce(F.least(F.nullif(F.instr(t, "+"), F.lit(0)), F.nullif(F.instr(t, "-"), F.lit(0))), F.lit(0))
    return bind(F.lower(strip_blanks(c)), lambda t: bind(first(t), lambda sign: bind(F.substring(t, sign + 1, F.length(t)), lambda number: parts(t, sign, number))))


def with_positions(df: DataFrame, column: str, *keep: Column | str) -> DataFrame:
    """The kept columns and chrom, strand, pos, posid of the rows whose column is a position."""
    return df.select(*keep, F.inline(F.filter(F.array(parsed_position(F.col(column))), lambda x: x["pos"].isNotNull())))


def canonical_posid(c: Column) -> Column:
    """The one spelling of a position (see parsed_position)."""
    return parsed_position(c)["posid"]


def psl_size_factor(strand: Column, last_start: Column, last_size: Column, t_start: Column, t_end: Column, t_size: Column) -> Column:
    """3 for a translated alignment, else 1. Such a one has two strands, and its last block, at three letters a residue,
    ends the target's range (on the second strand -, counted from the target's end, begins it)."""
    end = last_start + 3 * last_size
    second = F.substring(strand, 2, 1)
    return F.when((second == "+") & (t_end == end), 3).when((second == "-") & (t_start == t_size - end), 3).otherwise(1)


def psl_percent_identity(matches: Column, mismatches: Column, rep: Column, q_ins: Column, q_ali: Column, t_ali: Column, factor: Column | int = 1) -> Column:
    """Percent identity of a transcript alignment to two decimals (target inserts are not counted).

    factor: psl_size_factor. An alignment without any extent in query or target has 100 percent.
    """
    m = factor if isinstance(factor, Column) else F.lit(factor)
    total = m * (matches + rep + mismatches)
    gap = F.greatest(F.lit(0), m * q_ali - t_ali)
    bad = F.floor((F.lit(1000) * (m * mismatches + q_ins + F.round(F.lit(3) * F.log(F.lit(1) + gap)))) / total)
    return F.when((q_ali <= 0) | (t_ali <= 0), F.lit(100.0)).when(total > 0, F.round(F.lit(100) - F.lit(0.1) * bad, 2)).otherwise(F.lit(0.0))


def psl_score(matches: Column, mismatches: Column, rep: Column, q_inserts: Column, t_inserts: Column, factor: Column | int = 1) -> Column:
    """Alignment score; factor: psl_size_factor."""
    m = factor if isinstance(factor, Column) else F.lit(factor)
    return m * (matches + F.shiftright(rep, 1)) - m * mismatches - q_inserts - t_inserts
