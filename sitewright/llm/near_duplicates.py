"""Near-duplicate strings by SetSketch registers (problem 3).

A value is the set of its substrings of `width` characters. The candidate search sketches the longer
substrings of `shingle` characters: every register keeps the truncated logarithm of the least hash, so
registers are exponentially spaced, mergeable (by maximum) and equal with a probability that grows with
the similarity. Substrings that a large share of all values has (common prefixes) are left out of the
sketch, not of the similarity; a value gets the more bands the more of it is left out, since then the
differences of a similar value may all lie in what is sketched.

A band is one register. Values that share it are candidates if they are few, or if the next register says
that the group is dense. In a crowd that it would split, every two values are compared by bitmaps of their
substrings, and those that the bitmaps do not exclude (none that reaches the threshold is) are candidates. A
candidate's similarity is then estimated from a joint sketch by likelihood, and what may reach the threshold
is verified exactly. One plan serves tables of every size: nothing in it depends on the number of values but
the count from which a substring is common, which is a share of the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.session import Workspace

#: Base of the register values: b close to 1 lets registers tell as much as the minima themselves.
BASE = 1.001
#: Base of the registers in bands: a band is a single register, which unrelated values must not share by rounding.
BAND_BASE = 1 + 1e-9
#: Characters a kernel handles at once.
BLOCK = 1 << 21
#: Bands are given to values in steps of so many.
STEP = 4
#: Share of pairs at the threshold that the number of bands is chosen to miss at most.
MISS = 0.01
#: Bits of a band's key for its own register and for each of the two that may split it.
OWN_BITS, NEXT_BITS = 40, 12
#: Pairs a kernel hands on, or compares, at once.
PAIRS = 1 << 20
#: Bits of the bitmap that stands for the substrings of a value in a crowd.
MAP_BITS = 512


@dataclass(frozen=True)
class SketchPlan:
    """width, threshold: what similar means. The others: how candidates are found.

    Substrings of `shingle` characters are sketched, in at least `bands` bands (see bands_needed). A substring
    is common, and not sketched, if more than `floor` + `share` * n of the n values have it; there are at most
    (substrings of a value) / share such ones. A value with fewer than `few` sketched substrings, or under 45%
    of its own, is also banded by all its substrings of `width` characters, two registers to a band, so that
    short and common values find their partners, too. Where more than `gone` of a value's substrings are common,
    edits are close to each other in the rest, and few long substrings outlive them: it is also banded by its
    substrings of `closer` characters outside the common ones. In a band of more than `crowd` values, unless at least `dense`
    of its pairs agree in the next register, the pairs are compared by bitmaps before they are candidates. joint registers serve the estimate; a candidate
    is verified unless the threshold is less likely than the estimate by `sigmas` standard deviations.
    """

    width: int = 5
    threshold: float = 0.6
    shingle: int = 16
    bands: int = 24
    floor: int = 256
    share: float = 1e-3
    few: int = 24
    gone: float = 0.2
    closer: int = 11
    crowd: int = 16
    dense: float = 0.12
    joint: int = 32
    sigmas: float = 4.0


def bands_needed(plan: SketchPlan, own: np.ndarray, sketched: np.ndarray) -> np.ndarray:
    """Bands for values of which `sketched` of `own` substrings are sketched, for a recall of about 1 - MISS at the threshold.

    A pair at the threshold shares 2t / (1 + t) of its substrings of `width`. If what is left out is common to
    both, the differences lie in the rest, where a share q of the substrings of `width` stays, and so about
    q ** (shingle / width) of the sketched ones. The rest is taken a tenth of
    the value smaller, since pairs scatter about this expectation and a partner may have lost some of the
    common part. Where hardly any of it is left, values are banded otherwise as well, so the number ends there.
    """
    wider = plan.shingle - plan.width
    gone = own - sketched
    rest = 1 - (gone + np.where(gone > 0, wider, 0)) / np.maximum(own + wider, 1) - 0.1
    kept = 1 - (1 - 2 * plan.threshold / (1 + plan.threshold)) / np.clip(rest, 0.36, 1)
    q = np.clip(kept, 1e-3, 1) ** (plan.shingle / plan.width)
    least = np.ceil(math.log(MISS) / np.log1p(-np.clip(q / (2 - q), 1e-9, 0.999)))
    least = np.where(rest < 0.5, 2 * least, least)  # few substrings left: single pairs scatter widely
    return (np.ceil(np.maximum(least, plan.bands) / STEP) * STEP).astype(np.int64)


def features(values: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and mixed hash of each substring of k characters, in order."""
    return placed_features(values, k)[:2]


def placed_features(values: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, mixed hash and place in the joined values of each substring of k characters, in order."""
    text = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, values), np.int64, len(values))
    if len(text) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(text) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + text[j : j + n] + np.uint64(1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    row = np.repeat(np.arange(len(values)), size)[:n]
    inside = np.arange(n) + k <= np.cumsum(size)[row]
    return row[inside], h[inside], np.flatnonzero(inside)


def registers(row: np.ndarray, h: np.ndarray, n: int, m: int, seed: int, base: float = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Register values (n x m) of the rows that have a substring, and which rows these are.

    Values are truncated to 0..q+1, with q as large as the least of 2**64 hashes asks for.
    """
    there = np.bincount(row, minlength=n) > 0
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    factors = np.random.default_rng(seed).integers(0, 1 << 63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.empty((len(starts), m), np.uint64)
    for i, f in enumerate(factors):
        least[:, i] = np.minimum.reduceat(h * f, starts) if len(starts) else 0
    step = np.log1p(base - 1)
    q = math.ceil(64 * math.log(2) / step)
    return np.clip(np.floor(1 - np.log((least.astype(np.float64) + 1) / 2.0**64) / step), 0, q + 1).astype(np.int64), there


def _log_likelihood(j: np.ndarray, u: np.ndarray, above: np.ndarray, below: np.ndarray, m: int) -> np.ndarray:
    """Of a similarity j, given how many of m registers are greater and less for a than for b; u: a's share of both sizes."""
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    return above * np.log(up) + below * np.log(down) + (m - above - below) * np.log(np.clip(1 - up - down, 1e-9, 1))


def likeliest(above: np.ndarray, below: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs; n_a, n_b: set sizes."""
    u = (n_a / (n_a + n_b))[:, None]
    j = np.linspace(0, 1, 65)[None] * np.minimum(u / (1 - u), (1 - u) / u)
    return np.take_along_axis(j, _log_likelihood(j, u, above[:, None], below[:, None], m).argmax(1)[:, None], 1)[:, 0]


def may_reach(threshold: float, sigmas: float, above: np.ndarray, below: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Pairs for which the threshold is not excluded by the likelihood ratio; that of each different observation is taken once."""
    seen, place = np.unique(np.stack([above, below, n_a, n_b], 1), axis=0, return_inverse=True)
    above, below, n_a, n_b = seen.T
    u = n_a / (n_a + n_b)
    best = likeliest(above, below, m, n_a, n_b)
    lost = _log_likelihood(best, u, above, below, m) - _log_likelihood(np.minimum(threshold, np.minimum(u / (1 - u), (1 - u) / u)), u, above, below, m)
    return ((best >= threshold) | (lost <= sigmas**2 / 2))[place.ravel()]


def shared_share(values: list[str], i: np.ndarray, j: np.ndarray, k: int) -> np.ndarray:
    """Exact similarity of the substring sets of values[i] and values[j]; 0 where both are empty."""
    text = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
    used = np.zeros(0x110000, bool)
    used[text] = True
    letters, different = (np.cumsum(used) - 1)[text], int(used.sum())
    size = np.fromiter(map(len, values), np.int64, len(values))
    n = max(len(text) - k + 1, 0)
    row = np.repeat(np.arange(len(values)), size)[:n]
    inside = np.arange(n) + k <= np.cumsum(size)[row]
    code = np.zeros(n, np.int64)
    for at in range(k):  # a number for each substring; renumbered where the next letter would not fit
        if code.size and (int(code.max()) + 1) * different >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * different + letters[at : at + n]
    row, code = row[inside], code[inside]
    if code.size and int(code.max()) >= (1 << 62) // max(len(values), len(i)):
        code = np.unique(code, return_inverse=True)[1]
    most = int(code.max()) + 1 if code.size else 1
    own = _runs(np.sort(row * most + code))[0]
    row, code = own // most, own % most
    count = np.bincount(row, minlength=len(values))
    first = np.cumsum(count) - count

    def listed(side: np.ndarray) -> np.ndarray:
        pair = np.repeat(np.arange(len(side)), count[side])
        return pair * most + code[first[side][pair] + np.arange(len(pair)) - (np.cumsum(count[side]) - count[side])[pair]]

    both = np.sort(np.concatenate([listed(i), listed(j)]))
    same = np.bincount(both[1:][both[1:] == both[:-1]] // most, minlength=len(i))
    return same / np.maximum(count[i] + count[j] - same, 1)


def _blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive rows of about BLOCK characters; a longer row is a block of its own."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, side="right")))
        yield slice(at, to)
        at = to


def _strings(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for b in batches:
        lists = [b.column(c).to_pylist() for c in columns]
        sizes = sum(np.fromiter(map(len, x), np.int64, len(x)) for x in lists)
        for s in _blocks(sizes):
            yield (b.slice(s.start, s.stop - s.start), *[x[s] for x in lists])


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a sorted array and how often each occurs."""
    at = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return x[at], np.diff(np.append(at, len(x)))


def common_substrings(values: DataFrame, plan: SketchPlan) -> np.ndarray:
    """Hashes of the substrings that too many values have (see SketchPlan), sorted.

    Each batch reports the substrings that at least share / 4 of its values have, so that a substring is
    undercounted by at most share / 4 of all values; the threshold is lowered by as much. The driver gets
    at most (substrings of a value) / (share / 2) hashes, whatever the number of values.
    """

    def count(batches):
        for b, texts in _strings(batches, "value"):
            row, h = features(texts, plan.shingle)
            least = max(2, plan.share / 4 * len(texts))
            found, n = _runs(np.sort(h))
            some = found[n >= least]
            if some.size:  # few are left; those that a value has twice count once
                held = some[np.minimum(np.searchsorted(some, h), len(some) - 1)] == h
                row, h = row[held], h[held]
                order = np.lexsort((row, h))
                row, h = row[order], h[order]
                found, n = _runs(h[np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))])
                yield pa.RecordBatch.from_arrays([pa.array(found[n >= least].view(np.int64)), pa.array(n[n >= least])], ["h", "n"])

    counts = values.select("value").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    total = values.agg(F.count("*").alias("total"))  # one row
    rows = counts.join(F.broadcast(total)).where(F.col("n") > plan.floor + 0.75 * plan.share * F.col("total")).select("h").toArrow()
    return np.sort(rows["h"].to_numpy().view(np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _keys(own: np.ndarray, following: np.ndarray, label: int) -> np.ndarray:
    """One key for each value and band: the band's own register, and short forms of the two registers that may split it."""
    bands = (np.arange(own.shape[1]) + label).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = _mixed(own.astype(np.uint64) + bands) >> np.uint64(64 - OWN_BITS)
    short = _mixed(following.astype(np.uint64)) >> np.uint64(64 - NEXT_BITS)
    m = short.shape[1]
    for shift in (m // 3, m - m // 4):
        key = (key << np.uint64(NEXT_BITS)) | short[:, (np.arange(own.shape[1]) + shift) % m]
    return key.view(np.int64)


def band_rows(values: DataFrame, plan: SketchPlan, common: np.ndarray) -> DataFrame:
    """key and id: one row for each band of each value."""
    shipped = values.sparkSession.sparkContext.broadcast(common)  # bounded by the share

    def banded(row, h, n, need, label):
        base, there = registers(row, h, n, plan.bands, 10, BAND_BASE)
        yield _keys(base, base, label), there
        at = np.cumsum(there) - 1
        for step in range(plan.bands // STEP, need.max(initial=0) // STEP):
            more = need[row] > step * STEP
            row, h = row[more], h[more]
            k, these = registers(row, h, n, STEP, 10 + step, BAND_BASE)
            yield _keys(k, base[at[these]], label + step * STEP), these

    def emit(batches):
        skip = shipped.value
        for b, texts in _strings(batches, "value"):
            ids = b.column("id").to_numpy()
            row, h, place = placed_features(texts, plan.shingle)
            own = np.bincount(row, minlength=len(texts))
            parts = []
            if len(skip):
                used = skip[np.minimum(np.searchsorted(skip, h), len(skip) - 1)] != h
                left_out = place[~used]
                row, h = row[used], h[used]
            sketched = np.bincount(row, minlength=len(texts))
            need = bands_needed(plan, own, sketched)
            if (thin := own - sketched > plan.gone * own).any():
                short, g, at = placed_features(texts, plan.closer)
                inside = np.zeros(sum(map(len, texts)) + plan.shingle, np.int32)
                np.add.at(inside, left_out, 1)
                np.add.at(inside, left_out + plan.shingle - plan.closer + 1, -1)
                outside = thin[short] & (np.cumsum(inside)[at] == 0)
                wider = bands_needed(replace(plan, shingle=plan.closer), np.bincount(short, minlength=len(texts)), np.bincount(short[outside], minlength=len(texts)))
                parts += banded(short[outside], g[outside], len(texts), np.where(thin, wider, 0), 1 << 24)
            if (poor := np.flatnonzero(sketched < np.maximum(plan.few, 0.45 * own))).size:
                short, g = features([texts[i] for i in poor], plan.width)
                k, there = registers(poor[short], g, len(texts), plan.bands, 2, BAND_BASE)
                parts.append((_keys(k[:, 0::2] * 31 + k[:, 1::2], k, 1 << 20), there))
            parts += banded(row, h, len(texts), need, 0)
            for key, there in parts:
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(ids[there], key.shape[1]))], ["key", "id"])

    return values.select("id", "value").mapInArrow(emit, "key long, id long")


def candidate_groups(key: np.ndarray, plan: SketchPlan) -> np.ndarray:
    """Which of the sorted keys begin a group of candidates."""
    starts = [np.concatenate([[True], (key[1:] >> shift) != (key[:-1] >> shift)]) for shift in (2 * NEXT_BITS, NEXT_BITS, 0)]
    begin, crowded = starts[0].copy(), np.ones(len(key), bool)
    for finer in starts[1:]:
        first, inner = np.flatnonzero(begin), np.flatnonzero(begin | finer)
        size = np.diff(np.append(first, len(key)))
        parts = np.diff(np.append(inner, len(key)))
        agree = np.add.reduceat(parts * (parts - 1), np.searchsorted(inner, first))
        crowded &= np.repeat((size > plan.crowd) & (agree < plan.dense * size * (size - 1)), size)
        begin |= finer & crowded
    return begin


def _whole_groups(batches: Iterator[pa.RecordBatch], group: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.Table]:
    """Sorted rows in tables that end where a group of the first column does."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        g = group(b.column(0).to_numpy())
        done = int(np.searchsorted(g, g[-1])) if len(g) else 0  # the last group may go on
        if held and len(g) and (done or group(held[-1].column(0).to_numpy()[-1:])[0] != g[0]):
            yield pa.Table.from_batches([*held, b.slice(0, done)])
            held = []
        elif done:
            yield pa.Table.from_batches([b.slice(0, done)])
        if len(g):
            held.append(b.slice(done))
    if held:
        yield pa.Table.from_batches(held)


def _pairs(plan: SketchPlan):
    """a, b: candidates; or a and the crowd that it belongs to, without b."""

    def emit(key: np.ndarray, ids: np.ndarray):
        own = key >> (2 * NEXT_BITS)
        begin = candidate_groups(key, plan)
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(first, len(key)))
        crowd = np.repeat(np.add.reduceat(begin.astype(np.int64), first) > 1, size)  # would be split
        if crowd.any():
            n = int(crowd.sum())
            yield pa.RecordBatch.from_arrays([pa.array(ids[crowd]), pa.nulls(n, pa.int64()), pa.array(own[crowd])], ["a", "b", "crowd"])
        key, ids, begin = key[~crowd], ids[~crowd], begin[~crowd]
        size = np.diff(np.append(np.flatnonzero(begin), len(key)))
        left = np.repeat(np.cumsum(size), size) - np.arange(len(key))  # members from here to the end of the group
        alive, gap = np.flatnonzero(left > 1), 1
        while alive.size:
            for s in range(0, len(alive), PAIRS):
                a, b = ids[alive[s : s + PAIRS]], ids[alive[s : s + PAIRS] + gap]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.nulls(len(a), pa.int64())], ["a", "b", "crowd"])
            gap += 1
            alive = alive[left[alive] > gap]

    def run(batches):
        for t in _whole_groups(batches, lambda key: key >> (2 * NEXT_BITS)):
            yield from emit(t["key"].to_numpy(), t["id"].to_numpy())

    return run


def bitmaps(values: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each value the bits that its substrings of k characters have (words x values), and how many different ones there are."""
    row, h = features(values, k)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    bits = np.zeros(len(values) * MAP_BITS, bool)
    bits[row * MAP_BITS + (_mixed(h) % np.uint64(MAP_BITS)).astype(np.int64)] = True
    return np.ascontiguousarray(np.packbits(bits).view(np.uint64).reshape(len(values), -1).T), np.bincount(row[new], minlength=len(values))


def not_excluded(words: np.ndarray, size: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i < j of the pairs that may reach the threshold, by bitmaps.

    Every bit in which two bitmaps differ is a substring of one value only; a pair at the threshold has at most
    (1 - t) / (1 + t) of both sizes together of these. So no pair that reaches it is left out.
    """
    most = (1 - threshold) / (1 + threshold)
    n, at = len(size), 0
    while at < n - 1:
        to = min(n - 1, at + max(1, PAIRS // (n - at)))
        differ = np.zeros((to - at, n - at), np.uint16)
        for w in words:
            differ += np.bitwise_count(w[at:to, None] ^ w[None, at:])
        i, j = np.nonzero(differ <= most * (size[at:to, None] + size[None, at:]) + 1e-6)
        yield at + i[i < j], at + j[i < j]
        at = to


def _crowd_pairs(plan: SketchPlan):
    def run(batches):
        for t in _whole_groups(batches, lambda crowd: crowd):
            crowd, ids, texts = t["crowd"].to_numpy(), t["id"].to_numpy(), t["value"].to_pylist()
            ends = np.append(np.flatnonzero(crowd[1:] != crowd[:-1]) + 1, len(crowd))
            for start, end in zip(np.append(0, ends[:-1]), ends):
                words, size = bitmaps(texts[start:end], plan.width)
                own = ids[start:end]
                for i, j in not_excluded(words, size, plan.threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(own[i], own[j])), pa.array(np.maximum(own[i], own[j]))], ["a", "b"])

    return run


def _verify(plan: SketchPlan):
    def run(batches):
        for b, left, right in _strings(batches, "a", "b"):
            place: dict[str, int] = {}
            i = np.fromiter((place.setdefault(x, len(place)) for x in left), np.int64, len(left))
            j = np.fromiter((place.setdefault(x, len(place)) for x in right), np.int64, len(right))
            texts = list(place)
            row, h = features(texts, plan.width)
            k, there = registers(row, h, len(place), plan.joint, 3)
            full = np.zeros((len(place), plan.joint), np.int32)
            full[there] = k
            size = np.maximum(np.bincount(row, minlength=len(place)), 1)
            good = may_reach(plan.threshold, plan.sigmas, (full[i] > full[j]).sum(1), (full[i] < full[j]).sum(1), plan.joint, size[i], size[j])
            if good.any():
                used, where = np.unique(np.concatenate([i[good], j[good]]), return_inverse=True)
                good[good] = shared_share([texts[t] for t in used], where[: good.sum()], where[good.sum() :], plan.width) >= plan.threshold - 1e-9
            yield b.filter(pa.array(good))

    return run


def candidate_pairs(kept: DataFrame, plan: SketchPlan, work: Workspace, name: str) -> DataFrame:
    """a < b: ids of values that share a band, once each, but those of a crowd that cannot be similar. kept: id, value.

    The bands are shuffled by their own register and sorted; a group is at most the share of all values
    that may have one substring. The members of crowds get their values, and meet once more by crowd.
    """
    bands = band_rows(kept, plan, common_substrings(kept, plan))
    ordered = bands.repartition(F.shiftright("key", 2 * NEXT_BITS)).sortWithinPartitions("key")
    met = work.write(ordered.mapInArrow(_pairs(plan), "a long, b long, crowd long"), f"{name}-met")
    members = met.where("crowd is not null").select(F.col("a").alias("id"), "crowd").join(kept.select("id", "value"), "id").select("crowd", "id", "value")
    crowded = members.repartition("crowd").sortWithinPartitions("crowd").mapInArrow(_crowd_pairs(plan), "a long, b long")
    return met.where("crowd is null").select("a", "b").union(crowded).distinct()


def similar_pairs(values: DataFrame, plan: SketchPlan, work: Workspace, name: str = "values") -> DataFrame:
    """key_a < key_b: each pair of different values whose similarity reaches the threshold.

    values: a string column `value`. Equal values count once and a null is no value; a value shorter
    than `width` has no substring and no partner. Pairs are of different values only: copies are never
    expanded. Nothing is capped: all pairs of a band are candidates, however many values it has, but those
    of a crowd whose bitmaps show that they are below the threshold. Which pairs meet in a band, and so the
    recall, is a matter of probability: see the README.
    """
    kept = work.write(values.select("value").where(F.length("value") >= plan.width).distinct().select(F.monotonically_increasing_id().alias("id"), "value"), name)
    pairs = candidate_pairs(kept, plan, work, name)
    first = pairs.join(kept.select(F.col("id").alias("a"), F.col("value").alias("va")), "a").select("va", "b")
    both = first.join(kept.select(F.col("id").alias("b"), F.col("value").alias("vb")), "b").select(F.col("va").alias("a"), F.col("vb").alias("b"))
    found = both.mapInArrow(_verify(plan), "a string, b string")
    return found.select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"))
