"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 6).

Texts are cut into chunks where a rolling hash of the content says so, so that a passage shared by many
documents gives the same chunks in all of them. Each different chunk is encoded once. Chunks may be cut
anywhere, so the joins are repaired: the text between the last safe boundary of one chunk and the first
of the next is put together and encoded again, over as many chunks as it takes to reach a safe boundary.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters the rolling hash sees, the mean distance of its cuts and the least length of a chunk.
WINDOW, MEAN, LEAST = 16, 192, 48


def default_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_encoder(path: str):
    """A tiktoken encoding of a rank file; one a worker process."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_points(text: str) -> list[int]:
    """Where the content cuts a text: after each window whose hash is a multiple of MEAN."""
    if len(text) <= LEAST:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    n = len(codes) - WINDOW + 1
    h = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        h = h * np.uint64(0x100000001B3) + mixed[i : i + n]
    h ^= h >> np.uint64(31)
    points, last = [], 0
    for p in (np.flatnonzero(h % np.uint64(MEAN) == 0) + WINDOW).tolist():
        if p - last >= LEAST and p < len(text):
            points.append(p)
            last = p
    return points


def safe_span(chunk: str) -> tuple[int, int] | None:
    """The first and last safe boundary in a chunk, or None.

    A boundary before a blank or line feed that follows a character which is no white space is safe: no
    pre-token of the vocabulary's pattern reaches over it, whatever stands on either side. White space is
    taken in Python's sense, which includes the pattern's.
    """
    first = last = None
    p = -1
    while True:
        spots = [x for x in (chunk.find(" ", p + 1), chunk.find("\n", p + 1)) if x >= 0]
        if not spots:
            break
        p = min(spots)
        if p > 0 and not chunk[p - 1].isspace():
            first = p
            break
    if first is None:
        return None
    p = len(chunk)
    while True:
        p = max(chunk.rfind(" ", 0, p), chunk.rfind("\n", 0, p))
        if p > 0 and not chunk[p - 1].isspace():
            last = p
            break
    return first, last


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ids, places, chunks = [], [], []
        for doc, text in zip(b["doc_id"], b["text"]):
            edges = [0, *cut_points(text), len(text)]
            for i in range(len(edges) - 1):
                ids.append(doc)
                places.append(i)
                chunks.append(text[edges[i] : edges[i + 1]])
        yield pd.DataFrame({"doc_id": np.array(ids, np.int64), "place": np.array(places, np.int32), "chunk": chunks})


def _encode_chunks(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load_encoder(path)
        for b in batches:
            heads, bodies, tails = [], [], []
            for chunk in b["chunk"]:
                span = safe_span(chunk)
                heads.append(chunk[: span[0]] if span else chunk)
                bodies.append(encoder.encode_ordinary(chunk[span[0] : span[1]]) if span else None)
                tails.append(chunk[span[1] :] if span else None)
            yield pd.DataFrame({"k1": b["k1"], "k2": b["k2"], "head": heads, "body": bodies, "tail": tails})

    return run


def _join_chunks(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load_encoder(path)
        for b in batches:
            out = []
            for parts in b["parts"]:
                ids: list[int] = []
                loose = ""
                for part in parts:
                    loose += part["head"]
                    if part["body"] is not None:
                        ids += encoder.encode_ordinary(loose)
                        ids += part["body"].tolist()
                        loose = part["tail"]
                ids += encoder.encode_ordinary(loose)
                out.append(ids)
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": out})

    return run


def encode_corpus(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids of every document; an empty list for an empty and for a null text.

    documents: doc_id (unique) and text; other columns are ignored. Whole texts are encoded, without
    special tokens (their spelling in a text is ordinary text). Chunks are told apart by 128 bits of
    hash. A chunk of many documents is encoded once; in the join back to the documents it is a skewed
    key of an equi-join, which adaptive execution splits.
    """
    path = vocabulary or default_vocabulary()
    keys = (F.xxhash64("chunk").alias("k1"), F.xxhash64(F.lit(1), "chunk").alias("k2"))
    cut = documents.where("text <> ''").select("doc_id", "text").mapInPandas(_cut, "doc_id long, place int, chunk string")
    distinct = cut.select(*keys, "chunk").groupBy("k1", "k2").agg(F.first("chunk").alias("chunk"))
    encoded = distinct.mapInPandas(_encode_chunks(path), "k1 long, k2 long, head string, body array<int>, tail string")
    placed = cut.select("doc_id", "place", *keys).join(encoded, ["k1", "k2"])
    whole = placed.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "head", "body", "tail"))).alias("parts"))
    texts = whole.mapInPandas(_join_chunks(path), "doc_id long, ids array<int>")
    none = documents.where("text is null or text = ''").select("doc_id", F.array().cast("array<int>").alias("ids"))
    return texts.union(none)
