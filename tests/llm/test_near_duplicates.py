import random

import numpy as np

from pyspark.sql import functions as F

from sitewright.llm import near_duplicates
from sitewright.llm.near_duplicates import NEXT_BITS, SketchPlan, candidate_groups, common_substrings, features, likeliest, may_reach, registers, shared_share, similar_pairs
from sitewright.llm.queries import LEADERS, READS
from sitewright.session import Workspace, table


def shingles(x, k=5):
    return {x[i : i + k] for i in range(len(x) - k + 1)}


def brute(values, threshold=0.6):
    values = sorted(set(values))
    sets = [shingles(v) for v in values]
    out = set()
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            both = len(a & sets[j])
            if both and both >= threshold * (len(a) + len(sets[j]) - both) - 1e-9:
                out.add((values[i], values[j]))
    return out


def found(spark, values, plan=SketchPlan()):
    df = spark.createDataFrame([(v, "x") for v in values], "value string, id string")
    return {tuple(r) for r in similar_pairs(df, plan, Workspace(spark, "t")).collect()}


def edited(rng, x, n):
    x = list(x)
    for _ in range(n):
        at = rng.randrange(len(x))
        kind = rng.randrange(4)
        if kind == 0:
            x[at] = rng.choice("ACGT")
        elif kind == 1:
            x.insert(at, rng.choice("ACGT"))
        elif kind == 2:
            del x[at]
        else:
            x = x[at:] + x[:at]
    return "".join(x)


def test_recall_on_edits(spark):
    rng = random.Random(1)
    roots = ["GATTACAGATTACAGGCC" + "".join(rng.choice("ACGT") for _ in range(50)) for _ in range(400)]
    values = roots + [edited(rng, x, rng.randrange(1, 5)) for x in roots for _ in range(2)]
    want = brute(values)
    for plan in (LEADERS, READS):
        got = found(spark, values, plan)
        assert got <= want and len(got) >= 0.97 * len(want), (len(got), len(want))


def test_short_common_and_odd_values(spark):
    values = ["", "abc", "abcd", "abcde", "abcde", "abcdeX", "abcdef", "abcdefgh", "Xabcdefgh", "日本語の文章です。", "日本語の文章です", "aaaaaaaa", "aaaaaaaaaaaa", "x" * 5000, "x" * 4000 + "y", None]
    values += [f"same start of everything {i:04}" for i in range(200)]
    want = brute([v for v in values if v is not None])
    got = found(spark, values)
    assert got <= want and len(got) >= 0.97 * len(want)
    assert {p for p in want if len(p[0]) < 20} <= got


def test_no_values(spark):
    assert found(spark, []) == set() and found(spark, [None, "", "abcd"]) == set()


def test_estimate():
    rng = random.Random(2)
    base = ["".join(rng.choice("ACGT") for _ in range(200)) for _ in range(300)]
    other = [b[: 40 + i % 150] + "".join(rng.choice("ACGT") for _ in range(160 - i % 150)) for i, b in enumerate(base)]
    m = 256
    row, h = features(base + other, 9)
    k, _ = registers(row, h, 600, m, 3)
    size = np.bincount(row)
    j = likeliest((k[:300] > k[300:]).sum(1), (k[:300] < k[300:]).sum(1), m, size[:300], size[300:])
    true = np.array([len(shingles(a, 9) & shingles(b, 9)) / len(shingles(a, 9) | shingles(b, 9)) for a, b in zip(base, other)])
    assert np.abs(j - true).mean() < 0.03


def test_threshold_is_not_excluded_for_similar_pairs():
    rng = random.Random(4)
    values = ["".join(rng.choice("ACGT") for _ in range(120)) for _ in range(200)]
    row, h = features(values + [edited(rng, v, 2) for v in values], 5)
    k, _ = registers(row, h, 400, 32, 3)
    size = np.bincount(row)
    check = lambda other: may_reach(0.6, 4, (k[:200] > other).sum(1), (k[:200] < other).sum(1), 32, size[:200], size[200:])
    assert check(k[200:]).all() and check(np.roll(k[200:], 1, 0)).mean() < 0.1


def test_exact_share():
    rng = random.Random(6)
    values = ["".join(rng.choice("ab日本") for _ in range(rng.randrange(40))) for _ in range(60)] + ["", "abcde", "x" * 500, "\ud800abcdef"]
    i, j = (np.array([rng.randrange(len(values)) for _ in range(500)]) for _ in range(2))
    for k in (3, 5, 40):
        want = [len(x & y) / max(len(x | y), 1) for x, y in ((shingles(values[a], k), shingles(values[b], k)) for a, b in zip(i, j))]
        assert np.allclose(shared_share(values, i, j, k), want)


def test_crowds_are_split_and_dense_groups_kept():
    key = lambda own, second, third: (own << 2 * NEXT_BITS) | (second << NEXT_BITS) | third
    few, dense = [key(1, x, 0) for x in range(5)], [key(2, 7, x) for x in range(30)]
    crowd = sorted(key(3, x % 40, x // 40) for x in range(80))
    begin = candidate_groups(np.array(few + dense + crowd), SketchPlan())
    assert begin[:35].sum() == 2 and begin[35:].sum() == 40


def test_no_pair_of_a_crowd_is_lost(spark, monkeypatch):
    """All values share one band and no further register: every similar pair has to come out of the crowd."""
    rng = random.Random(12)
    start = "".join(rng.choice("ACGT") for _ in range(20))
    roots = [start + "".join(rng.choice("ACGT") for _ in range(40)) for _ in range(60)]
    values = [*roots, *(edited(rng, x, 2) for x in roots), "abcdeabcde", "x" * 3000, "x" * 3000 + "y"]
    one = F.lit(7 << 2 * NEXT_BITS).cast("long") + F.pmod(F.hash("id").cast("long"), F.lit(1 << 2 * NEXT_BITS))
    monkeypatch.setattr(near_duplicates, "band_rows", lambda kept, plan, common: kept.select(one.alias("key"), "id"))
    want = brute(values)
    assert len(want) > 40 and found(spark, values) == want


def test_bitmaps_exclude_no_similar_pair():
    rng = random.Random(13)
    roots = ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(100)]
    values = sorted({*roots, *(edited(rng, x, 3) for x in roots), "", "abcd", "日本語の文章です"})
    left = {(values[i], values[j]) for a, b in near_duplicates.not_excluded(*near_duplicates.bitmaps(values, 5), 0.6) for i, j in zip(a, b)}
    assert brute(values) <= left and len(left) < 0.05 * len(values) ** 2 / 2


def test_common_by_share(spark):
    values = [f"{i:06}" * 3 + "a common part of all values" for i in range(600)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, value string")
    found = common_substrings(df, SketchPlan())
    _, h = features(["a common part of all values"], 16)
    assert set(h.tolist()) <= set(found.tolist()) and len(found) < 40


def test_a_crowded_family(spark):
    """Most substrings of the family are too common to be sketched; its pairs come out all the same."""
    rng = random.Random(9)
    root = "".join(rng.choice("ACGT") for _ in range(60))
    values = [root, *{edited(rng, root, 2) for _ in range(90)}, *("".join(rng.choice("ACGT") for _ in range(60)) for _ in range(200))]
    want, got = brute(values), found(spark, values)
    assert len(want) > 1000 and got <= want and len(got) >= 0.97 * len(want)


def test_registers_merge():
    rng = random.Random(3)
    a, b = ("".join(rng.choice("ACGT") for _ in range(90)) for _ in range(2))
    sketch = lambda parts: registers(np.zeros(sum(map(len, parts)), int), np.concatenate(parts), 1, 64, 5)[0]
    x, y = features([a], 7)[1], features([b], 7)[1]
    assert (np.maximum(sketch([x]), sketch([y])) == sketch([x, y])).all()


def test_table(spark, sf):
    reads = [r.readid.strip() for r in table(spark, sf, "buildstdfragments").select("readid").collect()]
    assert found(spark, reads, READS) == brute(reads)


def half_common(rng, n):
    """n pairs of 68 letters, the first 32 the same in all; edits in the rest, similarity 0.60 to 0.65; and as many single values."""
    start, values, want = "".join(rng.choice("ACGT") for _ in range(32)), [], set()
    tail = lambda: "".join(rng.choice("ACGT") for _ in range(36))
    while len(want) < n:
        a = b = start + tail()
        for _ in range(12):
            at = rng.randrange(32, len(b))
            b = b[:at] + rng.choice(["", *"ACGT"]) + b[at + rng.randrange(2) :]
            s = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
            if s <= 0.65:
                break
        if 0.6 <= s <= 0.65:
            values += [a, b, start + tail()]
            want.add((min(a, b), max(a, b)))
    return values, want


def test_half_common_start(spark):
    values, want = half_common(random.Random(11), 400)
    got = found(spark, values, LEADERS)
    assert len(got & want) >= 0.95 * len(want), len(got & want) / len(want)
