"""Texts that were cut by a field limit or in transfer (problem 8).

Two kinds of evidence are combined per document. The end of a text tells whether it is finished, by fixed
rules over column expressions. And a text that is a strict prefix of a longer text elsewhere was cut from
it: the different texts are sorted, and all that continue a text follow it directly, so that each has to be
compared with its successor only, however many share a beginning. A text whose original is lost shows
the first kind only, so the rules decide what is found; the sorted values add which copy a cut text can be
completed from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.functions.text import BLANKS, strip_blanks
from sitewright.session import Workspace

# How a text may end. Fixed values.
_CLOSERS = r"""["'”’»)\]}*_\s\x{00a0}]*\z"""
_STOP = r"[.!?…。！？]"
# An emoji may carry a variation selector, which belongs to it.
_SMILEY = r"[:;]-?[)(DP]|(?:[\x{2600}-\x{27bf}]|[\x{1f300}-\x{1faff}])[\x{fe0e}\x{fe0f}]?"
_CLOSING_TAG = r"</[^<>\n]{1,60}>|\[/[^\[\]\n]{1,60}\]|<br\s*/?>"
_NEVER = "|".join(
    [
        r"\x{fffd}\z",
        r"[\[(](?:\.\.\.|…)[\])]\z",
        r"[\[<][^\]>\n\r]{0,60}\z",
        r"&#?\w{0,9}\z",
    ]
)


def _ends_finished(text: Column) -> Column:
    last = F.substring_index(text, "\n", -1)
    earlier = F.slice(F.reverse(F.split(text, "\n")), 2, 3)
    separator = F.exists(earlier, lambda x: F.regexp_replace(x, r"^[\s\x{00a0}>]+|[\s\x{00a0}>]+$", "").rlike(r"^(?:--|[_~]{4,})\z"))
    ending = text.rlike(rf"(?i)(?:{_CLOSING_TAG}){_CLOSERS}") | text.rlike(rf"(?:{_SMILEY}|{_STOP}){_CLOSERS}")
    line = F.regexp_replace(last, rf"^(?:>|{BLANKS})+|{BLANKS}+$", "")
    link = line.rlike(r"(?i)^(?:https?://|www\.)\S+\z")
    short = (F.size(F.split(line, rf"{BLANKS}+")) <= 4) & (F.char_length(line) <= 30)
    return separator | ending | link | short


def text_end(text: Column) -> Column:
    """`empty`, `cut` or `finished`; a null or blank text is empty."""
    t = F.regexp_replace(text, f"{BLANKS}+$", "")
    return F.when(t.isNull() | (t == ""), "empty").when(t.rlike(f"(?U)(?:{_NEVER})"), "cut").when(_ends_finished(t), "finished").otherwise("cut")


def prefix_matches(documents: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, whole_id: each document whose text is a strict prefix of a longer one.

    Texts are compared without trailing blanks; null and empty ones are left out. Equal texts are one
    value, held by its least doc_id; whole_id is that of the next longer text in the order of code points.
    The values are range-partitioned and sorted once; the last of a partition is compared with the first
    of the next, of which there is one row per partition.
    """
    texts = documents.select("doc_id", F.regexp_replace("text", f"{BLANKS}+$", "").alias("text")).where("text <> ''")
    values = texts.groupBy("text").agg(F.min("doc_id").alias("value_id")).repartitionByRange("text").withColumn("part", F.spark_partition_id())
    ordered = work.write(values, "values")
    inside = W.partitionBy("part").orderBy("text")
    firsts = ordered.groupBy("part").agg(F.min(F.struct("text", "value_id")).alias("first"))
    following = firsts.select("part", F.lead("first").over(W.orderBy("part")).alias("after"))  # one row per partition
    here = ordered.select("text", "part", F.lead(F.struct("text", "value_id")).over(inside).alias("next")).join(following, "part").withColumn("next", F.coalesce("next", "after"))
    hashes = (F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    cut = here.where(F.expr("startswith(next.text, text)")).select(*hashes, F.col("next.value_id").alias("whole_id"))
    return texts.select("doc_id", *hashes).join(cut, ["h1", "h2"]).select("doc_id", "whole_id")


def cut_documents(documents: DataFrame) -> DataFrame:
    """doc_id and source of each document whose text was cut."""
    return documents.where(text_end(F.col("text")) == "cut").select("doc_id", "source")


def cut_rates(documents: DataFrame, work: Workspace) -> DataFrame:
    """source, n_docs, n_cut, n_prefix: how often each source cuts, and how many of its texts have a longer copy.

    A null source is a source of its own. Empty texts count as documents only.
    """
    source = strip_blanks(F.col("source"))
    with_copy = prefix_matches(documents, work).select("doc_id", F.lit(1).alias("has_copy"))
    rows = documents.select("doc_id", source.alias("source"), (text_end(F.col("text")) == "cut").alias("is_cut")).join(with_copy, "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("is_cut").alias("n_cut"), F.count("has_copy").alias("n_prefix"))
