"""Deduplication of new batches against all history (problem 5).

The state lives in one folder and can be opened again by another process: for every accepted text one row with
its blocking keys, for every record the accepted ones that it repeats, the union-find mapping of clusters that
later records joined, and a small file with the batches and the learned weights. A batch probes the blocking
keys; candidates are scored field by field with the learned weights, and what the score does not exclude is
verified exactly. The accepted history is read for the probe but never keyed, compared or rewritten again.

Blocking keys. Two strings at most two edits apart differ in at most 2*GRAM of their character grams, so
under any fixed order the first 2*GRAM + 1 grams of each have one in common. The order puts grams that are
frequent in the history last, which makes the keys selective. Strings too short for that are keyed by what
is left of them after up to two deletions. No pair within two edits is lost, and nothing is capped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.text import normalize_id
from sitewright.llm.near_duplicates import features
from sitewright.operators.components import connected_components
from sitewright.session import Workspace, free_driver_memory

EDITS = 2
GRAM = 5
#: From here on a string has enough grams; up to two characters more it is keyed both ways.
SHORT = GRAM - 1 + EDITS * GRAM + 1
#: A gram of the history is frequent from this share of the records on: at most 1/share times the grams of
#: a record are.
FREQUENT = 0.0005
#: Rows of two numbers (16 MB) up to which the keys of a batch are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Labelled candidate pairs on which the weights are fitted.
FIT_ROWS = 20_000

FIELDS = ("trial", "subject", "sample")
TEXTS = "sample_id long, replicate int, text string, keys array<long>"
DECISIONS = "sample_id long, accepted_id long, score double"
MERGES = "root long, current long, version int"


def keyed_records(samples: DataFrame) -> DataFrame:
    """sample_id, batch, replicate and the normalised text of the records that can repeat another one.

    A null in trial, subject, sample or replicate repeats nothing and is left out.
    """
    parts = [normalize_id(F.col(c)) for c in FIELDS]
    text = F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2])
    return samples.select("sample_id", "batch", "replicate", text.alias("text")).where("text is not null and replicate is not null")


def told_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each gram, in order of row and hash; the second and later occurrences of one are told apart."""
    row, h = features(texts, GRAM)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    at = np.arange(len(h))
    again = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return row, ((h + again * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)).astype(np.int64)


def block_keys(texts: list[str], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and blocking key of each text, in order of row. frequent: sorted."""
    row, h = told_grams([t if len(t) >= SHORT else "" for t in texts])
    rare = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] != h if len(frequent) else np.ones(len(h), bool)
    order = np.lexsort((h, ~rare, row))
    row, h = row[order], h[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    first = place <= EDITS * GRAM
    rows, keys = [row[first]], [h[first]]
    for i in (i for i, t in enumerate(texts) if len(t) < SHORT + EDITS):
        t = texts[i]
        left = {"".join(ch for j, ch in enumerate(t) if j not in gone) for d in range(EDITS + 1) for gone in combinations(range(len(t)), min(d, len(t)))}
        rows.append(np.full(len(left), i))
        keys.append(np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 1 << 32) >> 1 for x in left), np.int64, len(left)))
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    return row[order], key[order]


def block_hashes(text: str, frequent: frozenset[int]) -> set[int]:
    """The blocking keys of one text."""
    return set(block_keys([text], np.array(sorted(frequent), np.int64))[1].tolist())


def with_keys(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """One row per text with its keys; the replicate is part of a key."""
    shipped = texts.sparkSession.sparkContext.broadcast(frequent)  # bounded by FREQUENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, key = block_keys(b.column("text").to_pylist(), shipped.value)
            ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(key))], [*b.schema.names, "grams"])

    rows = texts.select("sample_id", "replicate", "text").mapInArrow(run, "sample_id long, replicate int, text string, grams array<long>")
    return rows.select("sample_id", "replicate", "text", F.array_distinct(F.transform("grams", lambda g: F.xxhash64("replicate", g))).alias("keys"))


def frequent_grams(records: DataFrame) -> np.ndarray:
    """Grams with at least the share FREQUENT of the records, counted over all of them; sorted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.sort(told_grams(b.column("text").to_pylist())[1])
            at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(np.diff(np.append(at, len(h))))], ["gram", "n"])

    counts = records.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = records.agg(F.count("*").alias("total"))  # one row
    return np.sort(counts.join(F.broadcast(total)).where(F.col("n") >= F.greatest(F.lit(20), F.col("total") * FREQUENT)).select("gram").toArrow()["gram"].to_numpy())


def field_distances(pairs: DataFrame) -> DataFrame:
    """Edit distance of each field of a candidate pair, up to EDITS + 1, as columns d0..d2.

    odd: a separator may have been edited, so that the fields say little. One alone changes their number; one
    removed and one added leave the length of the text as it was, and not that of every field.
    """
    fields = lambda c: F.split(c, r"\|", -1)
    rows = pairs.withColumn("_a", fields(F.col("text"))).withColumn("_b", fields(F.col("other_text")))
    for i in range(3):
        d = F.levenshtein(F.get("_a", F.lit(i)), F.get("_b", F.lit(i)), EDITS)
        rows = rows.withColumn(f"d{i}", F.when(d < 0, EDITS + 1).otherwise(d))
    moved = reduce(Column.__or__, [F.length(F.get("_a", F.lit(i))) != F.length(F.get("_b", F.lit(i))) for i in range(3)])
    return rows.withColumn("odd", (F.size("_a") != 3) | (F.size("_b") != 3) | ((F.length("text") == F.length("other_text")) & moved)).drop("_a", "_b")


def repeats() -> Column:
    """The exact rule."""
    return F.levenshtein("text", "other_text", EDITS) >= 0


def fit_weights(labelled: pd.DataFrame) -> list[float]:
    """Logistic weights of the three field distances and a constant, by gradient steps; no distance speaks for a repeat."""
    x = np.c_[labelled[["d0", "d1", "d2"]].to_numpy(float) / (EDITS + 1), np.ones(len(labelled))]
    y = labelled["repeats"].to_numpy(float)
    w = np.zeros(4)
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += 4 * (x.T @ (y - p) / max(len(y), 1) - 1e-4 * w)
        w[:3] = np.minimum(w[:3], 0)
    return w.tolist()


#: Weights of a state that has seen no batch yet.
FIRST_WEIGHTS = [-3.0, -3.0, -3.0, 3.0]


def score(w: list[float]) -> Column:
    z = reduce(Column.__add__, [F.col(f"d{i}") / (EDITS + 1) * float(w[i]) for i in range(3)], F.lit(float(w[3])))
    return F.round(1 / (1 + F.exp(-z)), 6)


def least_score(w: list[float]) -> float:
    """The lowest score that a repeat can have whose separators were not edited: its fields differ by EDITS in sum at most."""
    z = min(w[3] + sum(w[i] * d[i] / (EDITS + 1) for i in range(3)) for d in product(range(EDITS + 2), repeat=3) if sum(d) <= EDITS)
    return float(1 / (1 + np.exp(-z)))


class BatchDeduplicator:
    """Accepts batches in order; each is held against the persisted state of all before it.

    texts: the accepted texts with their keys. decisions: every record with the accepted ones it repeats, or null.
    merges: the current root of each cluster that was joined to another, by version. One folder per batch each;
    state.json names the batches that are complete, so that a batch cut short is done anew.
    """

    def __init__(self, spark: SparkSession, work: Workspace):
        self.spark, self.work = spark, work
        self.frequent = np.zeros(0, np.int64)
        self.weights: list[float] | None = None
        self.batches: list[str] = []
        self.merged: list[str] = []

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BatchDeduplicator:
        """The state that another process left at path."""
        state = cls(spark, Workspace(spark, "p5", path))
        text = state.work.read_text("state.json")
        if text is None:
            raise ValueError(f"no state at {path}")
        kept = json.loads(text)
        state.batches, state.merged, state.weights = kept["batches"], kept["merged"], kept["weights"]
        state.frequent = np.sort(spark.read.schema("gram long").parquet(state.work.path("frequent")).toArrow()["gram"].to_numpy())
        return state

    def _commit(self, batch: str) -> None:
        self.batches.append(batch)
        self.work.write_text("state.json", json.dumps({"batches": self.batches, "merged": self.merged, "weights": self.weights}))
        free_driver_memory(self.spark)

    def _table(self, name: str, schema: str, batches: list[str]) -> DataFrame:
        paths = [self.work.path(f"{name}/{b}") for b in batches]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @property
    def texts(self) -> DataFrame:
        return self._table("texts", TEXTS, self.batches)

    @property
    def decisions(self) -> DataFrame:
        return self._table("decisions", DECISIONS, self.batches)

    @property
    def links(self) -> DataFrame:
        """accepted_id, sample_id, score of every repeat so far."""
        return self.decisions.where("accepted_id is not null").select("accepted_id", "sample_id", "score")

    @property
    def merges(self) -> DataFrame:
        """root, current: where the clusters that were joined to others are now."""
        return self._table("merges", MERGES, self.merged).groupBy("root").agg(F.max_by("current", "version").alias("current"))

    @property
    def representatives(self) -> DataFrame:
        """sample_id, cluster_id of every record: an accepted record founds a cluster and a repeat belongs to that of
        the least record it repeats, unless the mapping has moved it."""
        own = self.decisions.groupBy("sample_id").agg(F.min("accepted_id").alias("least")).select("sample_id", F.coalesce("least", "sample_id").alias("root"))
        return own.join(self.merges, "root", "left").select("sample_id", F.coalesce("current", "root").alias("cluster_id"))

    def accept_history(self, records: DataFrame) -> None:
        """Take records as accepted without a check; they are keyed once, here."""
        self.frequent = frequent_grams(records)
        self.work.write(self.spark.createDataFrame(pd.DataFrame({"gram": self.frequent}), "gram long"), "frequent")
        self.work.write(with_keys(records, self.frequent), "texts/history")
        self.work.write(records.select("sample_id", F.lit(None).cast("long").alias("accepted_id"), F.lit(None).cast("double").alias("score")), "decisions/history")
        self._commit("history")

    def _inside(self, pairs: DataFrame, tag: str) -> DataFrame:
        """sample_id of the texts that are rejected because they repeat an accepted text of their batch.

        pairs: sample_id, accepted_id (earlier), both not rejected by the state. Each is an edge (x, r, flip): x is
        rejected if r is accepted (or, with flip, rejected). An r without an edge of its own is accepted. An r
        that is open and has one edge left is replaced by that edge's r, so that chains shorten by half in
        every round; every round decides at least the first open text.
        """
        no = F.lit(None).cast("boolean")
        edges = pairs.select(F.col("sample_id").alias("x"), F.col("accepted_id").alias("r"), F.lit(False).alias("flip"), no.alias("taken"))

        def state_of(edges: DataFrame) -> DataFrame:
            """x, accepted (null: open) and, of an open one with a single open edge, that edge."""
            seen = edges.groupBy("x").agg(F.bool_or(F.col("taken") != F.col("flip")).alias("hit"), F.count_if(F.col("taken").isNull()).alias("n"), F.min(F.when(F.col("taken").isNull(), F.struct("r", "flip"))).alias("one"))
            hit = F.coalesce("hit", F.lit(False))
            return seen.select("x", F.when(hit, False).when(F.col("n") == 0, True).alias("accepted"), F.when((F.col("n") == 1) & ~hit, F.col("one")).alias("one"))

        decided, step = [], 0
        while True:
            now = state_of(edges)
            known = reduce(DataFrame.union, [*decided, now]).select(F.col("x").alias("r"), "accepted", "one", F.lit(True).alias("there"))
            open_edges = edges.where("taken is null").join(now.where("accepted is null").select("x"), "x", "left_semi").select("x", "r", "flip") if decided else edges
            seen = open_edges.select("x", "r", "flip").join(known, "r", "left")
            jump = F.col("accepted").isNull() & F.col("one").isNotNull()
            following = seen.select("x", F.when(jump, F.col("one.r")).otherwise(F.col("r")).alias("r"), F.when(jump, F.col("one.flip") == F.col("flip")).otherwise(F.col("flip")).alias("flip"), F.when(F.col("there").isNull(), True).otherwise(F.col("accepted")).alias("taken"))
            decided.append(now.where("accepted is not null"))
            step += 1
            count = Observation()
            edges = self.work.write(following.distinct().observe(count, F.count_if(F.col("taken").isNull()).alias("n")), f"{tag}/edges-{step}")
            if not count.get["n"]:
                decided.append(state_of(edges))
                break
        return reduce(DataFrame.union, decided).where("not accepted").select(F.col("x").alias("sample_id"))

    def accept(self, batch: DataFrame, number: int) -> None:
        """Find the repeats of one batch, accept the others and update the state.

        Records come in order of sample_id. One is accepted unless it repeats an accepted record before
        it, of the state or of this batch. Copies of one text are decided once: the first may be accepted,
        every later copy repeats it, or repeats what the first repeats and whatever like it was accepted in between.
        """
        work, tag = self.work, f"batch-{number}"
        first = batch.groupBy("replicate", "text").agg(F.min("sample_id").alias("sample_id"), F.count("*").alias("n"))
        size, records, rows = Observation(), Observation(), Observation()
        texts = work.write(with_keys(first.observe(records, F.sum("n").alias("n")), self.frequent).observe(size, F.sum(F.size("keys")).alias("n")), f"{tag}/texts")
        probe = texts.select(F.explode("keys").alias("key"), "sample_id")
        if (size.get["n"] or 0) <= BROADCAST_ROWS:
            probe = F.broadcast(probe)
        held = self.texts.withColumn("old", F.lit(True)).unionByName(texts.withColumn("old", F.lit(False)))
        met = held.select(F.explode("keys").alias("key"), F.col("sample_id").alias("accepted_id"), F.col("replicate").alias("other_replicate"), F.col("text").alias("other_text"), "old")
        met = met.join(probe, "key").where("accepted_id <> sample_id").select("sample_id", "accepted_id", "other_replicate", "other_text", "old").distinct()
        close = (F.col("replicate") == F.col("other_replicate")) & (F.abs(F.length("text") - F.length("other_text")) <= EDITS)
        compared = field_distances(met.join(texts.select("sample_id", "replicate", "text"), "sample_id").where(close))
        w = self.weights or FIRST_WEIGHTS
        likely = F.col("odd") | (F.col("score") >= least_score(w) - 1e-6)
        found = compared.withColumn("score", score(w)).where(likely).withColumn("back", F.expr("not old and accepted_id > sample_id"))
        seen = Observation()
        found = found.where(repeats()).select("sample_id", "accepted_id", "old", "back", "score").observe(seen, F.count_if(~F.col("old")).alias("inside"))
        near = work.write(found, f"{tag}/pairs")
        if self.weights is None:
            labelled = compared.withColumn("repeats", repeats()).select("d0", "d1", "d2", "repeats").limit(FIT_ROWS).toPandas()
            self.weights = fit_weights(labelled) if len(labelled) else None
        lost = near.where("old").select("sample_id").distinct()
        if seen.get["inside"]:
            gone = [lost.withColumnRenamed("sample_id", c) for c in ("sample_id", "accepted_id")]
            undecided = near.where("not old and not back").select("sample_id", "accepted_id").join(gone[0], "sample_id", "left_anti").join(gone[1], "accepted_id", "left_anti")
            lost = work.write(lost.union(self._inside(undecided, tag)), f"{tag}/lost")
            near = near.join(lost.withColumnRenamed("sample_id", "accepted_id"), "accepted_id", "left_anti")
        # what is left of near are the rejected texts, each with the accepted records that it repeats; those
        # that come after its first copy (back) are repeated by the later copies only
        found = near.select(F.col("sample_id").alias("near_id"), "accepted_id", "score", "back")
        copies = batch.join(first.withColumnRenamed("sample_id", "first_id"), ["replicate", "text"]).select("sample_id", "first_id")
        later = F.col("sample_id") > F.col("first_id")
        decided = copies.join(found, F.expr("first_id = near_id and (not back or accepted_id < sample_id)"), "left").select("sample_id", F.coalesce("accepted_id", F.when(later, F.col("first_id"))).alias("accepted_id"), F.coalesce("score", F.when(later, 1.0)).alias("score"))
        work.write(texts.join(lost, "sample_id", "left_anti"), f"texts/{number}")
        decisions = work.write(decided.observe(rows, F.count(F.lit(1)).alias("n")), f"decisions/{number}")
        if rows.get["n"] > (records.get["n"] or 0):  # some record has several rows
            self._join_clusters(decisions, number)
        self._commit(str(number))

    def _join_clusters(self, decisions: DataFrame, number: int) -> None:
        """Where a record repeats several accepted ones, their clusters become one, at the least root.

        Only the roots that are joined, and those that were at one of them, get a row of the new version.
        """
        merges = self.merges
        several = decisions.where("accepted_id is not null").select("sample_id", F.col("accepted_id").alias("root")).join(merges, "root", "left").select("sample_id", F.coalesce("current", "root").alias("root"))
        ends = several.groupBy("sample_id").agg(F.min("root").alias("u"), F.max("root").alias("most")).where("u < most")
        edges = self.work.write(several.join(ends, "sample_id").where("root > u").select("u", F.col("root").alias("v")).distinct(), f"batch-{number}/joined")
        if edges.isEmpty():
            return
        moved = connected_components(edges, self.work, f"batch-{number}/components").where("id <> root").select(F.col("id").alias("was"), F.col("root").alias("current"))
        before = merges.withColumnRenamed("current", "was").join(moved, "was").select("root", "current")
        self.work.write(moved.select(F.col("was").alias("root"), "current").union(before).withColumn("version", F.lit(len(self.merged))), f"merges/{number}")
        self.merged.append(str(number))


def deduplicate(samples: DataFrame, work: Workspace) -> BatchDeduplicator:
    """Feed a whole table batch by batch: batch 0 is the history, the others follow in order."""
    keyed_records(samples).repartitionByRange("batch", "sample_id").write.partitionBy("batch").parquet(work.path("records"))
    numbers = [r[0] for r in samples.select("batch").where("batch > 0").distinct().orderBy("batch").collect()]
    records = samples.sparkSession.read.schema("sample_id long, replicate int, text string, batch int").parquet(work.path("records"))
    state = BatchDeduplicator(samples.sparkSession, work)
    state.accept_history(records.where("batch = 0"))
    for number in numbers:
        state.accept(records.where(F.col("batch") == number), number)
    return state
