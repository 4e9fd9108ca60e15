"""Operator 11 against brute force: every document scored for every query in Python integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from widelines.llm import search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERMS.findall((text or "").translate(LOWER))


def brute(rows, items, top):
    docs = [(d, Counter(terms_of(t)), len(terms_of(t))) for d, t in rows if terms_of(t)]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc_id, tf, n in docs:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t, c in Counter(terms_of(text)).items() if t in tf)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "日本", "x-y", "A.B"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(k, rng.choice([" ", "\n", ", "]).join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 40, 200, 900]))))
            for k in range(n)]
    items = [(f"q{k}", " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for k in range(25)]
    return rows, items


@pytest.mark.parametrize("per_block, broadcast_rows", [(1000, 100_000), (6, 0)])
def test_equals_brute_force(spark, monkeypatch, per_block, broadcast_rows):
    monkeypatch.setattr(search, "BLOCK_QUERIES", per_block)
    monkeypatch.setattr(search, "BROADCAST_ROWS", broadcast_rows)
    rows, items = corpus(3)
    rows += [(k, "w7 w8 É w8") for k in range(1000, 1060)]  # ties beyond the last rank
    rows += [(None, "w7 w8 É w8"), (None, "w299 w298"), (5, "w299"), (5, "w299"), (6, None), (7, ""), (8, "-- .")]
    items += [("same", "w7 w8 w8"), ("none", "nowhere"), ("empty", ""), ("null", None), (None, "w299"), ("few", "É w299 W298")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "text")
    found = search.search(docs, spark.createDataFrame(items, "item_id string, text string"), top=10).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, items, 10)


def test_bounds_never_fall_short_and_exclude_most(spark):
    rows, items = corpus(8, 800)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = search.build_index(docs)
    queries = search.Queries([t for _, t in items])
    queries.weigh({}, len(rows), sum(len(terms_of(t)) for _, t in rows))
    texts, kept, all_pairs = dict(rows), 0, 0
    for row in index.collect():
        bounds, ids, _ = search._bounds(queries, row.asDict())
        for b, i in zip(bounds, ids["id"].tolist()):
            r, t, tf, n = queries.frequencies(next(search.chunks(search.pa.array([texts[i]]), lower=True)))
            exact = queries.scores(r, t, tf, queries.damping(n), 1)[0]
            assert (b >= exact).all()
            kept += int((b >= np.sort(exact)[-1]).sum())
            all_pairs += len(b)
    assert kept < all_pairs / 4


def test_empty_tables_clashing_columns_and_a_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b"), (1, "b")], "item_id int, text string")
    assert search.search(empty, items).count() == 0
    long = "a " * 300_000 + "b"
    docs = spark.createDataFrame([(1, long, 1, 2, 3, "x"), (2, "b c", 1, 2, 3, "x")],
                                 "doc_id long, text string, digest int, query int, rank int, queries string")
    assert search.search(docs, items.where("item_id > 1")).count() == 0
    found = search.search(docs, items).collect()
    assert sorted(map(tuple, found), key=str) == brute([(1, long), (2, "b c")], [(1, "a b"), (1, "b")], 20)
