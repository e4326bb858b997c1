import pytest
from pyspark.sql import functions as F

from sitewright.llm.truncation import cut_documents, cut_rates, prefix_matches, text_end
from sitewright.session import Workspace, table


def brute(docs):
    """docs: doc_id -> stripped text. The next value in order, where it continues the text."""
    ids = {}
    for i, t in docs.items():
        if t:
            ids[t] = min(i, ids.get(t, i))
    order = sorted(ids)
    after = {t: u for t, u in zip(order, order[1:]) if u.startswith(t)}
    return {i: ids[after[t]] for i, t in docs.items() if t in after}

LONG = "this is a long enough last line without any stop at all"
CASES = [
    (None, "empty"), ("", "empty"), (" \n ", "empty"),
    (LONG, "cut"), (LONG + ".", "finished"), (LONG + '."  ', "finished"), (LONG + " �", "cut"), (LONG + " [...]", "cut"), (LONG + " (…)", "cut"),
    (LONG + "...", "finished"), (LONG + "。", "finished"), (LONG + " :-)", "finished"), (LONG + " \U0001f600", "finished"), (LONG + " \U0001f6e0\ufe0f", "finished"), (LONG + " \u2764\ufe0e) ", "finished"), (LONG + " \ufe0f", "cut"), (LONG + " <br>", "finished"), (LONG + "</quote>", "finished"),
    (LONG + "[/quote]", "finished"), (LONG + ". <b", "cut"), (LONG + ". [url=abc", "cut"), (LONG + ".&am", "cut"), (LONG + ". &", "cut"), (LONG + ". <" + "a" * 61, "cut"), (LONG + ".\n<" + "a" * 61, "cut"),
    (LONG + "\nBob", "finished"), (LONG + "\n> > many thanks Bob", "finished"), (LONG + "\none two three four five", "cut"), (LONG + "\nhttp://example.org/" + "a" * 60, "finished"),
    ("--\n" + LONG, "finished"), ("--\na\nb\n" + LONG, "finished"), ("--\na\nb\nc\n" + LONG, "cut"), ("> ____ \n" + LONG, "finished"), ("___\n" + LONG, "cut"), ("~~~~\nx\n" + LONG, "finished"),
    ("x" * 100_000, "cut"), ("x" * 30, "finished"), ("x" * 31, "cut"),
]


def test_rules(spark):
    rows = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(CASES)], "doc_id long, text string, want string")
    assert [(r.text, r.want, r.got) for r in rows.withColumn("got", text_end(F.col("text"))).collect() if r.want != r.got] == []


def test_prefixes(spark):
    base = "".join(chr(97 + i * 7 % 26) for i in range(3000))
    texts = {1: base, 2: base[:10], 3: base[:64], 4: base[:127], 5: base[:128], 6: base[:2999], 7: base, 8: base[:500] + "Z", 9: None, 10: "", 11: base[:500] + "Z more", 12: base[:10] + "\n", 13: "q"}
    rows = spark.createDataFrame([(i, t, "s", 1) for i, t in texts.items()], "doc_id long, text string, source string, size int")
    strip = {i: (t or "").rstrip() for i, t in texts.items()}
    assert dict(map(tuple, prefix_matches(rows, Workspace(spark, "t")).collect())) == brute(strip)
    assert prefix_matches(rows.limit(0), Workspace(spark, "t")).count() == 0


def test_many_with_one_beginning(spark):
    texts = {i: "the same beginning " * 5 + f"{i:04}"[: i % 5] for i in range(400)}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert dict(map(tuple, prefix_matches(rows, Workspace(spark, "t")).collect())) == brute({i: t.rstrip() for i, t in texts.items()})


def test_rates(spark):
    rows = spark.createDataFrame([(1, LONG, "a"), (2, LONG + ".", "a "), (3, None, "a"), (4, LONG, None)], "doc_id long, text string, source string")
    assert {tuple(r) for r in cut_rates(rows, Workspace(spark, "t")).collect()} == {("a", 3, 1, 1), (None, 1, 1, 1)}
    assert {r.doc_id for r in cut_documents(rows).collect()} == {1, 4} and cut_rates(rows.limit(0), Workspace(spark, "t")).count() == 0


@pytest.mark.parametrize("name", ["documents"])
def test_table(spark, sf, name):
    docs = {r.doc_id: (r.text or "").rstrip() for r in table(spark, sf, name).collect()}
    assert dict(map(tuple, prefix_matches(table(spark, sf, name), Workspace(spark, "t")).collect())) == brute(docs)
