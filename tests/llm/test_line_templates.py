"""Operator 9: templates whatever the size of the data, masked and long lines, against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from widelines.llm import line_templates as lt

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, min_docs=10, percent=60, long=50):
    lines = []
    for k, (doc_id, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            t = WORD.findall(re.sub("[0-9]+", "0", line))
            if t:
                lines.append((k, i, (doc_id, text), t, (len(t), *(t + ["", ""])[:3])))
    size, held = Counter(x[4] for x in lines), Counter((x[4], p, w) for x in lines for p, w in enumerate(x[3]))
    fit, forms = defaultdict(set), defaultdict(set)
    for _, _, doc, t, leaf in lines:
        forms[tuple(t)].add(doc)
        same = sum(2 * held[leaf, p, w] > size[leaf] for p, w in enumerate(t))
        if size[leaf] >= min_docs and 100 * same >= percent * len(t):
            fit[leaf, True].add(doc)
    gone = defaultdict(set)
    for k, i, doc, t, leaf in lines:
        same = sum(2 * held[leaf, p, w] > size[leaf] for p, w in enumerate(t))
        fits = size[leaf] >= min_docs and 100 * same >= percent * len(t) and len(fit[leaf, True]) >= min_docs
        n = len(forms[tuple(t)])
        if fits or n >= min_docs or len(t) >= long and n >= 2:
            gone[k].add(i)
    return sorted((str(d), sum(1 for x in (t or "").split("\n") if WORD.search(x)), len(gone[k]),
                   None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]))
                  for k, (d, t) in enumerate(rows))


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["clean_text"]) for r in lt.drop_recurring(docs).collect())


def varied(n, seed=1):
    rng = random.Random(seed)
    pick = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") * 3
    return [(k, f"Own words {k * 7919} of {' '.join(pick() for _ in range(20))} {k}\n"
                f"Posted in section {pick()} by member {pick()} of the {pick()} group on this site") for k in range(n)]


@pytest.mark.parametrize("n", [100, 1000, 10_000])
def test_varied_templates_are_dropped_whatever_the_size(spark, n):
    docs = spark.createDataFrame(varied(n), "doc_id long, text string")
    got = lt.drop_recurring(docs).groupBy("n_dropped").count().collect()
    assert {r["n_dropped"]: r["count"] for r in got} == {1: n}


def test_equals_brute_force(spark):
    long = " ".join(f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(60))
    rows = varied(60) + [(100 + k, f"Page {k} of 12\nChapter {k}\nkept line alone {'abcdefghijklm'[k % 13]} q{k}z") for k in range(30)]
    rows += [(200, f"{long}\nother"), (201, f"{long}\nanother thing"), (202, "x\n\n \ny"), (203, ""), (204, None), (None, "Page 3 of 12"),
             (205, "tab\tand\x0bblank  Page 1"), (205, "tab\tand\x0bblank  Page 1"), (206, "a b c " * 5000)]
    rows += [(300 + k, "Subscribe to our letter today") for k in range(9)]  # one document too few
    rows += [(400 + k, "Subscribe to our channel today") for k in range(10)]
    got, want = found(spark, rows), brute(rows)
    assert got == want
    dropped = {r[0]: r[2] for r in got}
    assert dropped["200"] == dropped["201"] == 1 and dropped["110"] >= 2


def test_empty_table_and_clashing_columns(spark):
    assert lt.drop_recurring(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(k, f"Page {k} of 9\nown {'abcdefghijkl'[k]}", 1, 2, 3) for k in range(12)],
                                 "doc_id long, text string, leaf int, lines int, gone int")
    assert {r["n_dropped"] for r in lt.drop_recurring(docs).collect()} == {1}
