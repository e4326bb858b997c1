import re

import regex

from sitewright.llm import leakage as lk
from sitewright.session import table

ITEM = "When the crimson tide reaches Zufalja ferries to Belosard wait 26 minutes so that crates of hemp stay dry"


def slow_words(t):
    t = re.sub("[​-‍­﻿]", "", t.lower())
    for p in (r"<[^<>\n]{1,200}>", r"\[[^\[\]\n]{1,80}\]", r"&#?\w{1,10};"):
        t = re.sub(p, " ", t)
    return regex.findall(r"[\p{L}\p{N}]+", t)


def brute(docs, items):
    out = set()
    for i, t in items:
        runs = {tuple(w[k : k + 13]) for w in [slow_words(t or "")] for k in range(len(w) - 12)}
        out |= {(d, i) for d, x in docs for w in [slow_words(x or "")] if any(tuple(w[k : k + 13]) in runs for k in range(len(w) - 12))}
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, item_id int"), spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")


def test_cases(spark):
    part = " ".join(ITEM.split()[2:15])
    docs = [(1, ITEM.upper()), (2, f"see <b>{part}</b>, ok"), (3, " ".join(ITEM.split()[2:14])), (4, part.replace(" ", "&nbsp;­[b]\n")), (5, None), (6, ""), (7, ITEM.replace("26", "31").replace("Zufalja", "Belosard", 1)), (8, ITEM.replace("26", "31")), (9, "x " * 100_000 + part), (8, "again"), (11, ITEM.replace("wait", "stall"))]
    items = [(1, ITEM), (2, ITEM + " for long"), (3, "short"), (4, None), (5, "nothing of the sort is to be found in any of these posts at all today")]
    d, i = frames(spark, docs, items)
    got = {tuple(r) for r in lk.leaked_items(d, i).collect()}
    assert got == brute(docs, items) == {(x, y) for x in (1, 2, 4, 9) for y in (1, 2)}
    changed = {tuple(r)[:2] for r in lk.reparameterised_items(d, i).collect()}
    assert {(8, 1), (8, 2)} <= changed and not changed & got and (11, 1) not in changed


def test_big_item_side_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(lk, "SHIPPED_WINDOWS", 0)
    docs, items = [(1, ITEM), (2, "other " * 20)], [(1, ITEM)]
    assert {tuple(r) for r in lk.leaked_items(*frames(spark, docs, items)).collect()} == {(1, 1)}


def test_empty(spark):
    d, i = frames(spark, [(1, ITEM)], [(1, ITEM)])
    assert lk.leaked_items(d.limit(0), i).count() == 0 and lk.leaked_items(d, i.limit(0)).count() == 0


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "eval_items").collect()]
    assert {tuple(r) for r in lk.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items")).collect()} == brute(docs, items)


def test_names_that_no_item_has(spark):
    dense = "Tell Zufalja and Belosard that near Mirganth the nine crates of Oldavor hemp went with Kelmori to Pranwick by dawn"
    swaps = {"Zufalja": "Qorvexa", "Belosard": "Hintrel", "Mirganth": "Sabwick", "Oldavor": "Umtarre", "Kelmori": "Wexholm", "Pranwick": "Yarrobin"}
    renamed = dense
    for a, b in swaps.items():
        renamed = renamed.replace(a, b)
    one = ITEM.replace("26", "31").replace("Zufalja", "Belosard", 1)
    mixed = renamed.replace("Hintrel", "Qorvexa")
    docs = [(1, renamed), (2, "x. " + renamed.replace("Qorvexa", "<b>Qorvexa</b>")), (3, dense), (4, renamed.lower()), (5, renamed.replace("crates", "boxes")), (6, mixed), (7, one), (9, ITEM.replace("Zufalja", "Qorvexa").replace("Belosard", "Hintrel"))]
    d, i = frames(spark, docs, [(1, ITEM), (2, dense)])
    pairs = {tuple(r)[:2]: r.windows for r in lk.reparameterised_items(d, i).collect()}
    assert {(1, 2), (2, 2), (7, 1), (9, 1)} <= set(pairs) and not {(3, 2), (4, 2), (5, 2)} & set(pairs)
    assert pairs[9, 1] == 7 and pairs[1, 2] > pairs.get((6, 2), 0)
    assert {tuple(r) for r in lk.leaked_items(d, i).collect()} == {(3, 2)}


def test_a_passage_counts_for_its_best_items(spark):
    family = [f"When the {c} tide reaches Zufal{e} ferries to Belos{e} wait {n} minutes so that crates of hemp stay dry" for c, e, n in (("crimson", "ja", 26), ("crimson", "mo", 48), ("crimson", "vey", 71))]
    other = "Each winter Cortolgen sends 73 singers to Mirstebel where the narrow choir is paid in rare linen rather than 8 coins or bread"
    asked = family[0].replace("26", "33").replace("Zufalja", "Qorvexa").replace("Belosja", "Hintrel")
    docs = [(1, asked), (2, family[1]), (3, asked + ". " + other.replace("73", "12").replace("Mirstebel", "Onvark").replace("8", "6")), (4, other), (4, other), (5, None), (6, "")]
    d, i = frames(spark, docs, [*enumerate(family, 1), (9, other), (9, other)])
    # equals are all named; a copy of item 2 (document 2) is no exchange of items 1 and 3
    assert {tuple(r)[:2] for r in lk.reparameterised_items(d, i).collect()} == {(x, y) for x in (1, 3) for y in (1, 2, 3)} | {(3, 9)}
    assert {tuple(r) for r in lk.leaked_items(d, i).collect()} == {(2, 2), (4, 9)}


def test_planted_exchanges(spark):
    """Every item once with all its names and numbers exchanged, among all documents: held-out recall and precision."""
    sf = "/root/testdata/sf0.01"
    items = table(spark, sf, "eval_items")
    texts = [(r.item_id, r.text) for r in items.collect()]
    names = lk.item_names([t for _, t in texts])

    def exchanged(text, item):
        new = lambda m: "Q" + m[0][::-1].lower() + "x" if m[0].lower() in names else m[0]
        return regex.sub(r"\p{N}+", lambda m: str(int(m[0]) + 7 + item), regex.sub(r"\p{L}+", new, text))

    planted = [(10**12 + i, f"My own question. {exchanged(t, i)} Any idea?") for i, t in texts]
    docs = table(spark, sf, "documents").select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    verbatim = {r.doc_id for r in lk.leaked_items(docs, items).collect() if r.doc_id - 10**12 == r.item_id}
    wanted = {(d, d - 10**12) for d, _ in planted if d not in verbatim}  # about half; the others keep 13 equal words
    rows = {(r.doc_id, r.item_id) for r in lk.reparameterised_items(docs, items).collect()}
    ours = {r for r in rows if r[0] >= 10**12}
    print("wanted", len(wanted), "found", len(wanted & rows), "rows of planted documents", len(ours), "of others", len(rows - ours))
    assert wanted <= rows and len(ours) <= 1.2 * len(wanted) and len(rows - ours) <= 0.1 * len(wanted)
