"""Operator 7 where buckets are large: near copies at and around the threshold against all pairs."""

import random

import numpy as np
import pytest

from widelines.llm import near_dup


def shingles(text, size):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def components(sets, percent):
    label = {d: d for d in sets}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    number = {s: k for k, s in enumerate({s for x in sets.values() for s in x})}
    held = np.zeros((len(ids), len(number)), np.float32)
    for k, d in enumerate(ids):
        held[k, [number[s] for s in sets[d]]] = 1
    both, size = held @ held.T, held.sum(axis=1)
    for x, y in zip(*np.nonzero(100 * both >= percent * (size[:, None] + size[None] - both))):
        if x < y and size[x] and size[y]:
            a, b = sorted((top(ids[x]), top(ids[y])))
            label[b] = a
    return {d: top(d) for d in sets}


def near_copies(n, seed, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for k in range(n):
        words = list(base)
        for i in rng.sample(range(len(words)), edits(k)):
            words[i] = f"v{rng.randrange(100_000)}"
        rows.append((k, " ".join(words)))
    return rows


def test_many_near_copies_half_of_them_unlinked(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 300)
    rows = near_copies(2000, 4, lambda k: 3 if k % 2 else 14)  # 14 edits of 200 words: no link to any other
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, 3, 85).collect()}
    want = components({d: shingles(t, 3) for d, t in rows}, 85)
    assert got == want and sum(1 for d, c in want.items() if d == c) > 900


def test_copies_at_the_threshold_without_their_source(spark):
    rows = near_copies(300, 9, lambda k: 2 + k % 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, 3, 85).collect()}
    want = components({d: shingles(t, 3) for d, t in rows}, 85)
    assert got == want and 1 < len(set(want.values())) < 299


@pytest.mark.parametrize("two_sides", [False, True])
def test_cell_links_join_what_all_pairs_join(two_sides):
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = np.arange(100, dtype=np.uint64) + np.uint64(1000 * rng.integers(4))
        sets.append(np.unique(np.concatenate([rng.choice(base, rng.integers(80, 100), replace=False),
                                              rng.integers(10**6, 10**9, rng.integers(0, 12)).astype(np.uint64)])))
    component = np.where(np.arange(60) % 7 == 0, 0, np.arange(60))
    side = np.arange(60) % 2 if two_sides else np.zeros(60, np.int64)

    def joined(pairs):
        label = component.copy()
        for x, y in pairs:
            label[label == label[y]] = label[x]
        return {frozenset(np.flatnonzero(label == v)) for v in np.unique(label)}

    held = [set(s.tolist()) for s in sets]
    all_pairs = [(x, y) for x in range(60) for y in range(x) if (not two_sides or side[x] != side[y])
                 and 100 * len(held[x] & held[y]) >= 85 * len(held[x] | held[y])]
    found = near_dup.cell_links(sets, component, side, 85)
    assert joined(found) == joined(all_pairs) and len(found) < 60 and all(p in all_pairs or p[::-1] in all_pairs for p in found)


def test_exactly_at_85_percent_is_linked(spark):
    words = [f"w{i}" for i in range(22)]  # 20 shingles of three words
    rows = [(1, " ".join(words[:19])), (2, " ".join(words)), (3, " ".join(words[:18]) + " x")]
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == components({d: shingles(t, 3) for d, t in rows}, 85) and got[2] == 1


def test_estimates_with_many_bins():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:2200], rng.integers(0, 2**63, 800).astype(np.uint64)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    for part in (1, 300):  # also sets that need many rounds
        one, two = near_dup.sketches([a[::part], b[::part]], 370)
        small = len(np.intersect1d(a[::part], b[::part])) / len(np.union1d(a[::part], b[::part]))
        assert abs((one == two).mean() - small) < 5 * (0.25 / 370) ** 0.5
    assert 0.5 < true < 0.7
