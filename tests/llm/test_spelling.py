"""Operator 13 against brute force: all pairs of a small vocabulary, character by character."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from widelines.llm import spelling


def words_of(rows):
    found = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = words_of(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=str)


def corpus(seed=5):
    rng = random.Random(seed)
    base = ["letter", "lettre", "élève", "þórður", "aabbcc", "aabbccc", "colour", "color", "colours", "ÀÉÎÕÜ", "a×b÷cd", "x" * 70]
    rows = []
    for k in range(200):
        words = []
        for _ in range(12):
            w = rng.choice(base[: rng.randrange(1, len(base) + 1)])
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeñ") + w[i:], w[:i] + rng.choice("aeñ") + w[i + 1 :]])
            words.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((k if k % 3 else 0, rng.choice([" ", "1", "\n", "ā", "-"]).join(words)))
    return rows + [(None, "letter lettor Letter"), (None, "letter"), (5, ""), (6, None), (7, "theİletter ab")]


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 64 * 32, 40 * 32])
def test_equals_brute_force_in_one_pass_or_many(spark, filter_bytes):
    rows = corpus()
    found = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), filter_bytes=filter_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert sum(1 for r in brute(rows) if r[1]) > 20


def test_chains_lead_to_the_last_form(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w40"}


def test_empty_table_clashing_columns_and_a_very_long_word(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = "ab" * 30_000
    rows = [(k, f"{long} {long}x {long[:-1]}", "q", 1, "b", 2) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int, form string, candidate int")
    n = words_of([r[:2] for r in rows])
    found = {r["word"]: r["n_near"] for r in spelling.variants(docs).collect()}
    assert found == {w: sum(1 for v in n if abs(len(v) - len(w)) < 2 and w != v and one_edit(w, v)) for w in n}


def test_crc_and_hashes_of_edits():
    data = np.frombuffer("abcdefghij".encode() * 20, np.uint8)
    first, size = np.array([0, 3, 5, 0]), np.array([3, 0, 100, 10])
    before = np.array([0, 7, 9, 2**32 - 1], np.uint32)
    assert spelling.crc32_of(data, first, size, before).tolist() == [
        zlib.crc32(data[a : a + n].tobytes(), int(c)) for a, n, c in zip(first, size, before)]
    words = spelling.Words(pa.array(["élève", "éève"]))
    cut = 1  # the second code point
    rest = words.total[0] - words.prefix[cut] - words.term[cut]
    made = spelling.finished(words.prefix[[cut]] + rest * spelling.UNBASE, np.array([4]))
    assert made[0] == words.hashes()[1]
