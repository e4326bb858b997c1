import random

import pytest

from sitewright.llm.corpus_encoding import cut_points, default_vocabulary, encode_corpus, load_encoder, safe_span
from sitewright.session import table

TEXTS = ["", None, " ", "\n\n  \n", "a", "don't  stop", "x" * 30_000, "日本語の文章です。" * 200, "👍🏽 é​ 　 end", "<|endoftext|> is text", "tab\tand \x1c odd \x85 space " * 40, "1234567890" * 300, " lead and trail ", "It's we'll I'M " * 50, "".join(chr(c) for c in range(1, 3000))]


def whole(texts):
    encoder = load_encoder(default_vocabulary())
    return {i: encoder.encode_ordinary(t or "") for i, t in enumerate(texts)}


def encoded(spark, texts):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids int, chunk string")
    return {r.doc_id: r.ids for r in encode_corpus(df).collect()}


def test_odd_texts(spark):
    assert encoded(spark, TEXTS) == whole(TEXTS)


def test_shared_passages(spark):
    rng = random.Random(1)
    words = ["alpha", "beta,", "Gamma", "'s", " ", "\n", "12", "é", "…", "\t", "0x"]
    passages = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(5)]
    texts = ["".join(rng.choice(passages)[rng.randrange(9) :] + rng.choice(["", " ", "\n"]) for _ in range(4)) for _ in range(150)] + [passages[0]] * 100
    assert encoded(spark, texts) == whole(texts)
    chunks = lambda t: {t[a:b] for a, b in zip([0, *cut_points(t)], [*cut_points(t), len(t)])}
    assert chunks("prefix " * 3 + passages[1] * 3) & chunks(passages[1] * 3)


def test_tables(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    encoder = load_encoder(default_vocabulary())
    assert {r.doc_id: r.ids for r in encode_corpus(table(spark, sf, "documents")).collect()} == {r.doc_id: encoder.encode_ordinary(r.text or "") for r in docs}


@pytest.mark.parametrize(("chunk", "span"), [("", None), ("abc", None), (" abc", None), ("a b", (1, 1)), ("a  b\nc", (1, 4)), ("　 a", None)])
def test_safe_span(chunk, span):
    assert safe_span(chunk) == span


def test_empty(spark):
    assert encoded(spark, [None]) == {0: []} and encode_corpus(spark.createDataFrame([], "doc_id long, text string")).count() == 0
