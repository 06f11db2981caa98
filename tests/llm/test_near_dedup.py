import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import near_dedup as D


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) by an index over shingles and exact similarities."""
    sets = [plain_set(t) if i is not None else set() for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    seen, index = {}, {}
    for k, s in enumerate(sets):
        if not s:
            continue
        first = seen.setdefault(frozenset(s), k)
        if first != k:  # a copy links with whatever the first one links with
            a, b = top(rows[first][0]), top(rows[k][0])
            root[max(a, b)] = min(a, b)
            continue
        for g in s:
            index.setdefault(g, []).append(k)
    shared = {}
    for ks in index.values():
        for pair in combinations(ks, 2):
            shared[pair] = shared.get(pair, 0) + 1
    for (x, y), both in shared.items():
        if 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both):
            a, b = top(rows[x][0]), top(rows[y][0])
            root[max(a, b)] = min(a, b)
    return sorted(((i, len(plain_set(t)), top(i)) for i, t in rows), key=repr)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def edited(dice, words, rate):
    return [dice.choice("qwertz") * 3 + str(dice.random()) if dice.random() < rate else w for w in words]


def family(seed, groups, copies, length, rate):
    dice = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{dice.randint(0, 5000)}" for _ in range(length)]
        rows += [(len(rows) + 1000 * k, " ".join(edited(dice, base, dice.random() * rate))) for k in range(copies)]
    dice.shuffle(rows)
    return [(n, t) for n, (_, t) in enumerate(rows)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, rep string, band string").repartition(3)


def test_query(run_query, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in run_query("op4_near_dedup")) == sorted(brute(rows))


def test_near_the_threshold(spark):
    rows = family(1, 40, 6, 120, 0.05) + [(9000 + k, t) for k, (_, t) in enumerate(family(2, 30, 4, 30, 0.04))]
    assert got(D.near_duplicates(table(spark, rows))) == brute(rows)


def test_large_groups_are_divided(spark, monkeypatch):
    """One family of near copies in many blocks, whose buckets are tied unseen."""
    monkeypatch.setattr(D, "BLOCK_HASHES", 1500)
    monkeypatch.setattr(D, "BUCKET", 10)
    monkeypatch.setattr(D, "PIVOTS", 2)
    rows = family(3, 2, 120, 60, 0.05)
    assert got(D.near_duplicates(table(spark, rows))) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(D.near_duplicates(odd_docs)) == brute(rows)
    assert D.near_duplicates(no_docs).collect() == [] and D.deduplicated(no_docs).collect() == []
    kept = D.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13] and ids.count(None) == 2


def test_repeated_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "other words"), (6, "a b c d e f"), (4, "other words"), (8, "alone")]
    assert got(D.near_duplicates(table(spark, rows))) == brute(rows)
    assert sorted(r.doc_id for r in D.deduplicated(table(spark, rows)).collect()) == [4, 8]


def test_estimates():
    dice = np.random.default_rng(1)
    for share in (0.3, 0.7, 0.85, 0.95):
        off = []
        for _ in range(30):
            n = 400
            both = int(2 * n * share / (1 + share))
            pool = dice.integers(0, 1 << 63, 2 * n - both, np.uint64)
            x, y = np.sort(pool[:n]), np.sort(pool[n - both :])
            off.append(float(D.estimates(D.packed_bits(D.minima(x)), D.packed_bits(D.minima(y)))) - share)
        assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.06


@pytest.mark.parametrize("left", [False, True])
def test_confirmed(left):
    dice = random.Random(8)
    sets = [np.unique(np.array([dice.randint(0, 40) for _ in range(dice.randint(0, 45))], np.uint64)) for _ in range(60)]
    mask = np.array([dice.random() < 0.3 for _ in sets]) if left else None
    good = lambda a, b: len(np.intersect1d(a, b)) * 100 >= 85 * len(np.union1d(a, b)) and len(a)
    want = [(i, j) for i, j in combinations(range(60), 2) if good(sets[i], sets[j]) and (mask is None or mask[i] or mask[j])]
    p, q = D.confirmed(sets, mask)
    assert set(map(frozenset, zip(p.tolist(), q.tolist()))) <= set(map(frozenset, want))
    ends = lambda ps: D.local_components(60, np.array([x for x, _ in ps], int), np.array([y for _, y in ps], int)).tolist()
    assert ends(want) == ends(list(zip(p.tolist(), q.tolist())))


def at_threshold(rows, percent):
    """The components of `brute` at another threshold, by all pairs."""
    sets, root = [plain_set(t) for _, t in rows], {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (x, s), (y, t) in combinations(zip((i for i, _ in rows), sets), 2):  # noqa: B905
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            a, b = top(x), top(y)
            root[max(a, b)] = min(a, b)
    return sorted(((i, len(s), top(i)) for (i, _), s in zip(rows, sets)), key=repr)  # noqa: B905


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_other_thresholds(spark, percent):
    rows = family(1, 40, 6, 120, 0.07) + [(9000 + k, t) for k, (_, t) in enumerate(family(2, 30, 4, 30, 0.04))]
    want = at_threshold(rows, percent)
    assert want != brute(rows) and at_threshold(rows, 85) == brute(rows)
    assert got(D.near_duplicates(table(spark, rows), percent=percent)) == want
    assert sorted(r.doc_id for r in D.deduplicated(table(spark, rows), percent=percent).collect()) == sorted(i for i, _, c in want if i == c)


def test_bands_fit_the_threshold():
    assert D.fitted(85)[:2] == (20, 6)
    for percent in (50, 60, 80, 85, 90, 99, 100):
        bands, size, likely = D.fitted(percent)
        assert bands * size <= D.K and (1 - (percent / 100) ** size) ** bands <= 1e-4 and likely < percent / 100
    with pytest.raises(ValueError):
        D.fitted(3)
