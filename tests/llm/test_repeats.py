"""Operator 12 against brute force: every window of every document in one dictionary."""

import hashlib
import random

import pytest

from widelines.llm import repeats, varint

import numpy as np

WINDOW = 5


def brute(rows, window):
    place = lambda doc_id, i: (doc_id is None, doc_id or 0, i)
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, place(doc_id, i)), place(doc_id, i))
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != place(doc_id, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "é", "日本", "x1", "Y", "-"]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if k % 3 == 0:  # a third of all documents holds one passage
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


@pytest.mark.parametrize("records", [10, 200, 2_000_000])
def test_equals_brute_force_whatever_the_groups(spark, records, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1500)
    rows = corpus(records) + [(None, "a b c a b c a b c"), (None, "a b c a b c a b c x1 x1"), (3, "a b c a b c Y"), (3, ""),
                              (7, None), (900, "q " * 400), (900, "q " * 400), (901, "w"), (902, "a b c a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "text")
    found = repeats.drop_repeats(docs, WINDOW, group_records=records).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in found), key=str)
    assert got == brute(rows, WINDOW)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.drop_repeats(empty).count() == 0
    names = "doc_id long, text string, digest int, spans string, chunk int, _bucket int, _marked int, n_words int"
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, long, 1, "s", 2, 3, 4, 5), (2, long, 1, "s", 2, 3, 4, 5), (3, "one two", 1, "s", 2, 3, 4, 5)]
    found = repeats.drop_repeats(spark.createDataFrame(rows, names)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], len(r["kept"])) for r in found) == [
        (1, 40_000, 0, len(long)), (2, 40_000, 40_000, 0), (3, 2, 0, 7)]


def test_varints_round_trip():
    values = np.array([0, 1, 127, 128, 300, 2**21, 2**35 - 1, 2**62], np.int64)
    data, size = varint.encode(values)
    assert size.sum() == len(data) and (varint.decode(data) == values).all() and not len(varint.decode(data[:0]))
