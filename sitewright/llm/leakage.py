"""Evaluation passages inside training text (problem 7).

Texts are cut into words and every word is canonicalised on its own: numbers, names and units become typed
placeholders. Windows of words are hashed over the canonical words and joined with the windows of the test
items, so that a passage meets its item even where its numbers or names were exchanged. The slots of a
joined window then tell a verbatim leak (all slots equal) from a re-parameterised one (slots exchanged one
for one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Words of a window.
RUN = 13
#: Item windows up to which their hashes are shipped to the scan (8 bytes each); beyond, all windows are
#: shuffled instead.
SHIPPED_WINDOWS = 2_000_000
#: Words of a window that must not be slots for a re-parameterised match.
FIXED_WORDS = 8

_DROPPED = dict.fromkeys([0x200B, 0x200C, 0x200D, 0xAD, 0xFEFF])
_MARKUP = regex.compile(r"<[^<>\n]{1,200}>|\[[^\[\]\n]{1,80}\]|&#?\w{1,10};")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_NUMBER = regex.compile(r"\p{N}+(?:st|nd|rd|th)?")
_CAPITAL = regex.compile(r"(?<=[\p{Ll}\p{N},;] )\p{Lu}[\p{L}\p{N}]+")

#: Words that count as units of measure.
UNITS = frozenset(
    """mm cm m km inch inches foot feet mile miles g kg mg ton tons lb oz l ml litre litres liter liters hour hours hr
    minute minutes min second seconds sec day days week weeks month months year years percent degree degrees volt volts
    watt watts kw hz eur euro euros usd dollar dollars""".split()
)


def words(text: str) -> list[str]:
    """The words of a text, without markup, entities and invisible characters."""
    return _WORD.findall(_MARKUP.sub(" ", text.lower().translate(_DROPPED)))


def item_names(texts: list[str]) -> frozenset[str]:
    """Words that the items capitalise inside sentences and never write in lower case."""
    upper, lower = set(), set()
    for t in texts:
        upper.update(w.lower() for w in _CAPITAL.findall(t))
        lower.update(w for w in _WORD.findall(t) if w.islower())
    return frozenset(upper - lower)


def foreign_names(text: str, known: frozenset[str]) -> set[str]:
    """Words outside known that a document capitalises and never writes in lower case: its own names.

    Within an exchanged passage only such words can stand for a name of the item, be it inside or at the start
    of a sentence; the words of the items, which are known, are names or not as the items have them.
    """
    written = set(_WORD.findall(_MARKUP.sub(" ", text.translate(_DROPPED))))
    return {w.lower() for w in written if len(w) > 1 and w[0].isupper()} - known - written


def _placeholder(word: str, names: frozenset[str]) -> str | None:
    if _NUMBER.fullmatch(word):
        return "\0number"
    if word in UNITS:
        return "\0unit"
    return "\0name" if word in names else None


def _roll(h: np.ndarray) -> np.ndarray:
    out = np.zeros(max(len(h) - RUN + 1, 0), np.uint64)
    for j in range(RUN):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
    out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _windows(wanted_ids: list[int], texts: list[str], names: frozenset[str], wanted: np.ndarray | None, known: frozenset[str] | None):
    """id, template hash, exact hash and slot words of each window (of those in wanted only).

    known: if given, the words beyond which a text's own names count as names, too.
    """
    place: dict[tuple[str, bool], int] = {}
    own = [foreign_names(t, known) if known is not None else () for t in texts]
    lists = [[place.setdefault((w, w in o), len(place)) for w in words(t)] for t, o in zip(texts, own)]
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((w for x in lists for w in x), np.int64, int(size.sum()))
    vocabulary = [w for w, _ in place]
    holders = [_placeholder(w, names) or ("\0name" if o else None) for w, o in place]
    number = lambda s: xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass"))
    exact = np.fromiter(map(number, vocabulary), np.uint64, len(vocabulary))
    canonical = np.fromiter((number(h or w) for h, w in zip(holders, vocabulary)), np.uint64, len(vocabulary))
    template, verbatim = _roll(canonical[flat]), _roll(exact[flat])
    owner = np.repeat(np.arange(len(lists)), size)[: len(template)]
    good = np.arange(len(template)) + RUN <= np.cumsum(size)[owner]
    if wanted is not None:
        good &= np.isin(template, wanted)
    at = np.flatnonzero(good)
    slots = [[vocabulary[w] for w in flat[i : i + RUN] if holders[w]] for i in at]
    ids = np.asarray(wanted_ids, np.int64)[owner[at]] if len(at) else np.zeros(0, np.int64)
    return ids, template[at], verbatim[at], slots


_SCHEMA = "id long, template long, verbatim long, slots array<string>"


def template_windows(texts: DataFrame, id_column: str, names: frozenset[str], wanted: np.ndarray | None = None, known: frozenset[str] | None = None) -> DataFrame:
    """The windows of all texts, or of those whose template hash is in wanted; known as in foreign_names."""

    shipped = texts.sparkSession.sparkContext.broadcast((wanted, known, names))  # at most SHIPPED_WINDOWS, and words of the items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, known, names = shipped.value
        for b in batches:
            ids, rows = b.column("id").to_pylist(), b.column("text").to_pylist()
            for s in range(0, len(rows), 512):
                i, t, v, slots = _windows(ids[s : s + 512], rows[s : s + 512], names, wanted, known)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(t), pa.array(v), pa.array(slots, pa.list_(pa.string()))], ["id", "template", "verbatim", "slots"])

    rows = texts.where(F.col("text").isNotNull()).select(F.col(id_column).cast("long").alias("id"), "text")
    return rows.mapInArrow(run, _SCHEMA)


def leaked_windows(documents: DataFrame, items: DataFrame, exchanged: bool = True) -> DataFrame:
    """doc_id, item_id, template, found, verbatim, consistent: each pair of windows with one template.

    documents: doc_id, text; items: item_id, text (the fixed test set; its capitalised words give the
    names). A null or short text has no window. The items' window hashes are shipped to the scan of the
    documents while there are at most SHIPPED_WINDOWS; otherwise both sides are shuffled by the hash.
    found: the hash of the document's own window. consistent: the slots of the two windows correspond one for one.
    exchanged: names of the documents that no item has are names, too. No verbatim window holds one, so where only
    these count it can be left off.
    """
    texts = [r.text for r in items.select("text").where("text is not null").toLocalIterator()]
    names = item_names(texts)
    item_words = frozenset(w for t in texts for w in words(t)) if exchanged else None
    known = template_windows(items, "item_id", names).distinct()
    wanted = None
    if known.count() <= SHIPPED_WINDOWS:
        wanted = np.unique(known.select("template").toArrow()["template"].to_numpy())
    found = template_windows(documents, "doc_id", names, wanted, item_words)
    item = known.select("template", F.col("id").alias("item_id"), F.col("verbatim").alias("item_verbatim"), F.col("slots").alias("item_slots"))
    both = found.distinct().join(item, "template")
    zipped = F.size(F.array_distinct(F.arrays_zip("slots", "item_slots")))
    one_for_one = (F.size("slots") == F.size("item_slots")) & (zipped == F.size(F.array_distinct("slots"))) & (zipped == F.size(F.array_distinct("item_slots")))
    same = (F.col("verbatim") == F.col("item_verbatim")) & (F.col("slots") == F.col("item_slots"))
    consistent = one_for_one & (F.lit(RUN) - F.size("slots") >= FIXED_WORDS)
    return both.select(F.col("id").alias("doc_id"), "item_id", "template", F.col("verbatim").alias("found"), same.alias("verbatim"), consistent.alias("consistent"))


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id: each document and item with a run of RUN equal words in common, once."""
    return leaked_windows(documents, items, exchanged=False).where("verbatim").select("doc_id", "item_id").distinct()


def reparameterised_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, windows: what documents hold of items only with other numbers, names or units.

    A window that some item has word for word is a leak of that item and no exchange of another one's slots. Every
    other window counts for the item with most consistent windows in that document, and for each of several that
    have equally many; windows counts those of an item. So a passage is not reported for every item made from a
    part of its template, and a document with passages of several templates is reported for each of them. A pair with
    a verbatim window is left to leaked_items, with all windows that count for it.
    """
    place = ["doc_id", "template", "found"]
    pairs = leaked_windows(documents, items).groupBy(*place, "item_id").agg(F.max("verbatim").alias("verbatim"), F.max("consistent").alias("consistent"))
    # one shuffle by document serves all windows; a document's rows are bounded by its length and the fixed items
    pairs = pairs.repartition("doc_id").withColumn("leaked", F.max("verbatim").over(W.partitionBy("doc_id", "item_id"))).withColumn("explained", F.max("verbatim").over(W.partitionBy(*place)))
    counted = pairs.where("consistent").withColumn("n", F.count("*").over(W.partitionBy("doc_id", "item_id")))
    best = counted.withColumn("most", F.max("n").over(W.partitionBy(*place))).where("n = most and not leaked and not explained")
    return best.groupBy("doc_id", "item_id").agg(F.count("*").alias("windows"))
