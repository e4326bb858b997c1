import random
import re

from sitewright.llm import incremental
from sitewright.llm.incremental import BatchDeduplicator, block_hashes, deduplicate, keyed_records, least_score
from sitewright.session import Workspace, free_driver_memory, table

SCHEMA = "sample_id long, batch int, trial string, subject string, sample string, replicate int, text string, key long"


def normal(x):
    x = re.sub("[ \t\u00a0]+", "_", x.strip(" \t\u00a0"))
    return "".join(chr(ord(c) - 32) if "a" <= c <= "z" else c for c in x)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    accepted, out = [], set()
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        if None in r[2:6]:
            continue
        text = "|".join(map(normal, r[2:5]))
        hits = {i for t, p, i in accepted if p == r[5] and abs(len(t) - len(text)) <= 2 and distance(t, text) <= 2} if r[1] else set()
        out |= {(i, r[0]) for i in hits}
        if not hits:
            accepted.append((text, r[5], r[0]))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA)
    state = deduplicate(df, Workspace(spark, "t"))
    return {tuple(r)[:2] for r in state.links.collect()}, state


def test_batches(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ABCDE01") for _ in range(n))
    rows = [(i, 0, f"T{i % 3}", f"P-{word(6)}", f"S_{i:03}{word(7)}", i % 2) for i in range(60)]
    rows += [(60 + i, 0, "A", "B", "CD" * (i + 1), 1) for i in range(4)]
    for b in (1, 2, 3):
        for _ in range(25):
            old = rng.choice(rows)
            i = len(rows)
            sample = list(old[4] or "x")
            for _ in range(rng.randrange(4)):
                sample[rng.randrange(len(sample))] = rng.choice("ABz9 ")
            rows.append((i, b, f" {old[2] or 'T'}\t", old[3], "".join(sample), old[5]))
    rows += [(900, 3, None, "a", "b", 1), (901, 3, "a", "b", "c", None), (902, 3, "", "", "", 1), (903, 3, " ", "", "q", 1), (904, 3, "long", "x" * 3000, "y", 1), (905, 3, "LONG", "x" * 2999, "yz", 1)]
    got, state = run(spark, rows)
    assert got == brute(rows)
    clusters = {r.sample_id: r.cluster_id for r in state.representatives.collect()}
    assert len(clusters) == sum(None not in r[2:6] for r in rows) and all(clusters[s] == clusters[a] for a, s in got)


def test_chain_inside_a_batch(spark):
    rows = [(0, 0, "t", "s", "zzzzzzzzzzzzzzzzzzzzzzz", 1)] + [(1 + i, 1, "t", "s", "A" * i + "B" * (30 - i), 1) for i in range(12)]
    assert run(spark, rows)[0] == brute(rows)


def test_no_history_and_no_batches(spark):
    assert run(spark, [])[0] == set()
    rows = [(1, 1, "a", "b", "c", 1), (2, 2, "a", "b", "c", 1), (3, 2, "a", "b", "c", 2)]
    assert run(spark, rows)[0] == {(1, 2)}


def test_keys_share_one_within_two_edits():
    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choice("AB|") for _ in range(rng.randrange(1, 24)))
        b = list(a)
        for _ in range(2):
            k, at = rng.randrange(3), rng.randrange(len(b) + 1)
            if k == 0:
                b.insert(at, "C")
            elif b and at < len(b):
                b[at : at + 1] = ["C"] * (k - 1)
        assert block_hashes(a, frozenset()) & block_hashes("".join(b), frozenset())


def test_table(spark, sf):
    """The first batches of the table; the query itself takes all."""
    df = table(spark, sf, "samples").where("batch <= 3")
    rows = [(r.sample_id, r.batch, r.trial, r.subject, r.sample, r.replicate) for r in df.collect()]
    got = deduplicate(df, Workspace(spark, "t")).links.select("accepted_id", "sample_id").collect()
    assert {tuple(r) for r in got} == brute(rows)


def test_accepted_between_copies(spark):
    """F repeats A and is out; G is like F but not like A, and accepted; the copy C of F repeats both."""
    a, f, g = "ABCDEFGHIJKLMNOPQRST", "ABCDEFGHIJKLMNOPQRxx", "yyCDEFGHIJKLMNOPQRxx"
    rows = [(50, 0, "t", "s", a, 1), (1, 1, "t", "s", f, 1), (2, 1, "t", "s", g, 1), (3, 1, "t", "s", f, 1), (4, 1, "t", "s", f, 2), (5, 1, "t", "s", f, 2)]
    got, state = run(spark, rows)
    assert got == brute(rows) == {(50, 1), (50, 3), (2, 3), (4, 5)}
    clusters = {r.sample_id: r.cluster_id for r in state.representatives.collect()}
    assert len({clusters[x] for x in (50, 1, 2, 3)}) == 1 and clusters[4] != clusters[2]


def unions(rows, links):
    """Least accepted record of each cluster, by following links one by one."""
    root = {r[0]: r[0] for r in rows if None not in r[2:6]}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, s in sorted(links):
        x, y = find(a), find(s)
        root[max(x, y)] = min(x, y)
    groups = {}
    for x in root:
        groups.setdefault(find(x), set()).add(x)
    return set(map(frozenset, groups.values()))


def test_reopened_between_batches(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("AB") for _ in range(20)) for _ in range(12)]
    rows = [(i, 0, "t", "s", n, 1) for i, n in enumerate(names)]
    for b in (1, 2, 3):
        for _ in range(15):
            x = list(rng.choice(rows)[4])
            for _ in range(rng.randrange(1, 4)):
                x[rng.randrange(len(x))] = rng.choice("ABC")
            rows.append((len(rows), b, "t", "s", "".join(x), 1))
    records = keyed_records(spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA))
    work = Workspace(spark, "t")
    BatchDeduplicator(spark, work).accept_history(records.where("batch = 0"))
    for b in (1, 2, 3):
        state = BatchDeduplicator.open(spark, work.root)
        state.accept(records.where(f"batch = {b}"), b)
    links = {tuple(r)[:2] for r in state.links.collect()}
    assert links == brute(rows)
    groups = {}
    for r in BatchDeduplicator.open(spark, work.root).representatives.collect():
        groups.setdefault(r.cluster_id, set()).add(r.sample_id)
    assert set(map(frozenset, groups.values())) == unions(rows, links)


def test_long_chain_in_few_rounds(spark):
    text = lambda i: "".join("B" if j < 2 * i else "A" for j in range(130))
    rows = [(0, 0, "t", "s", "zzzzzzzzzzzzzzzzzzzzzzz", 1)] + [(1 + i, 1, "t", "s", text(i), 1) for i in range(64)]
    got, state = run(spark, rows)
    assert got == brute(rows) and len(got) > 30
    folder = state.work._file_system("batch-1")
    assert sum(f.getPath().getName().startswith("edges-") for f in folder[0].listStatus(folder[1])) <= 9


def test_separators_in_fields(spark):
    rows = [(0, 0, "ab|cd", "subject", "sample", 1), (1, 0, "ef", "subject number", "sample", 1), (2, 1, "abcd", "subject", "sample", 1), (3, 1, "ef|", "subject number", "sample", 1), (4, 1, "efs", "ubject number", "sample", 1), (5, 1, "efsu", "bject number", "sample", 1), (6, 2, "e", "fsubject number", "sample", 1)]
    assert run(spark, rows)[0] == brute(rows)


def test_least_score():
    w = [-4.0, -1.0, -2.0, 2.0]
    assert abs(least_score(w) - 1 / (1 + 2.718281828 ** -(2 - 8 / 3))) < 1e-6


def test_driver_memory_is_given_back_after_every_batch(spark, monkeypatch):
    assert free_driver_memory(spark)  # the native heap could be trimmed
    given_back = []
    monkeypatch.setattr(incremental, "free_driver_memory", lambda s: given_back.append(free_driver_memory(s)))
    got, _ = run(spark, [(1, 0, "T", "P", "some sample", 1), (2, 1, "T", "P", "some sample", 1), (3, 2, "T", "P", "another one", 1)])
    assert got == {(1, 2)} and given_back == [True, True, True]
