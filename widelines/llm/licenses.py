"""Operator 3, licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs are the blocks of a text between lines without a word, with line breaks and comment marks taken as blanks,
so that wrapped notices are whole. A multinomial logistic regression over sparse word n-grams (1 to
3 words, hashed) knows the licence families of ``TEMPLATES`` and "unknown". It is trained on variants of the
templates and, as unknown, on paragraphs of the corpus without a licence cue, on shuffled or cut notices that must
not count, and on notices of licences that are not listed. The temperature of its probabilities is calibrated on
variants held back from training. It judges each line, each paragraph of several lines, and each run of words of
about a template's length that holds ``contained`` of the template's word pairs. A paragraph is of a family when the
family's probability reaches ``threshold`` there, at least ``contained`` of the word pairs of one of its templates
are found, compared in full, and the deciding words agree: the template's version number and its conditions (as
non-commercial) are there, and no word of another licence of the same kind (as lesser, affero, no derivatives).
A paragraph can be of several families.

Training takes ``NEGATIVES`` paragraphs at most of the corpus; scoring takes every paragraph of every whole text in
the task that reads it, without a shuffle. The model (some thousand n-grams) is broadcast.

Defined results: null and empty texts have no paragraph and no licence; null ids and other columns pass; repeated
rows get equal results; an empty table trains on the templates alone and gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.llm.textkernel import ALNUM_WORDS, Chunk, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Short notices as licence texts, their stewards and common usage word them.
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    "bsd-3-clause": ("Licensed under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    "cc-by-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "under the terms of the GNU General Public License version 2 as published by the Free Software "
                "Foundation"),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "under the terms of the GNU General Public License version 3 as published by the Free Software "
                "Foundation"),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."),
    "proprietary": ("All rights reserved.", "Unauthorized copying of this file is strictly prohibited."),
}
#: Openings and closings around notices in training variants; cues that keep a corpus paragraph out of the unknowns.
AROUND = ("", "Note:", "Copyright 2021 the authors.", "This file is", "See the file for details.", "The text is")
#: Notices of licences that are not listed: unknown.
UNLISTED = (
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "under the terms of the GNU Lesser General Public License version 2 as published by the Free Software Foundation",
    "under the terms of the GNU Affero General Public License version 3 as published by the Free Software Foundation",
    "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under the BSD 2-Clause License.", "Licensed under the ISC License.",
    "Licensed under the Eclipse Public License, version 2.0.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This is free and unencumbered software released into the public domain.",
)
#: Words that tell licences of one kind apart, by what they say, and the families of the kind with what they need.
TELLING = {"nc": ("nc", "noncommercial", "commercial"), "sa": ("sa", "sharealike", "alike"),
           "nd": ("nd", "noderivatives", "noderivs", "derivatives", "derivs"), "lesser": ("lesser", "library"),
           "affero": ("affero",)}
KINDS = ((("nc", "sa", "nd"), {"cc-by-4.0": (), "cc-by-nc-4.0": ("nc",), "cc-by-sa-4.0": ("sa",)}),
         (("lesser", "affero"), {"gpl-2.0": (), "gpl-3.0": ()}))
CUE = r"(?i)licen[sc]e|copyright|rights reserved|permission|redistribution|creative commons|\bcc by|\bgpl|\bmit\b"
NEGATIVES = 3000
MAX_GRAM = 3
THRESHOLD = 0.5
CONTAINED = 0.8


def paragraph_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, line of each word, paragraph of each word, text of each paragraph), of lines and paragraphs with
    a word, counted from 0."""
    starts, ends, _ = chunk.words(ALNUM_WORDS)
    line_starts, _, first = chunk.lines()
    at = np.searchsorted(line_starts, starts, "right") - 1
    held, line = np.unique(at, return_inverse=True)
    owner = np.searchsorted(first, held, "right") - 1
    new = np.ones(len(held), bool)
    new[1:] = (held[1:] > held[:-1] + 1) | (owner[1:] != owner[:-1])
    return span_hashes(chunk.data, starts, ends), line, (np.cumsum(new) - 1)[line], owner[new]


def grams(words: np.ndarray, paragraph: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first word, code) of all word n-grams within paragraphs, length after length."""
    codes = words
    for n in range(1, MAX_GRAM + 1):
        if n > 1:
            if len(words) < n:
                return
            same = paragraph[n - 1 :] == paragraph[: len(paragraph) - n + 1]
            codes = mix(codes[: len(words) - n + 1] + mix(words[n - 1 :], 60 + n), 61)
            yield np.flatnonzero(same), codes[same]
        else:
            yield np.arange(len(words)), mix(codes, 60)


def _words(text: str) -> np.ndarray:
    return paragraph_words(next(chunks(pa.array([text.replace("\n", " ")]), lower=True)))[0]


def _codes(text: str) -> list[np.ndarray]:
    words = _words(text)
    return [c for _, c in grams(words, np.zeros(len(words), np.int64))]


def deciding(family: str, notice: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Words of which one each must be there (version number, conditions), and words that must not."""
    needed = [(d,) for d in "123456789" if np.isin(_words(d), _words(notice)).all()]
    refused: list[str] = []
    for names, families in KINDS:
        if family in families:
            needed += [TELLING[x] for x in families[family]]
            refused += [w for x in names if x not in families[family] for w in TELLING[x]]
    return [_words(" ".join(x)) for x in needed], _words(" ".join(refused))


def variants(seed: int = 5) -> tuple[list[str], list[int]]:
    """Notices as they vary in use, with the number of their family (0: unknown, from cut or shuffled notices)."""
    rng = np.random.default_rng(seed)
    texts, family = [], []
    for k, notices in enumerate(TEMPLATES.values(), 1):
        for notice in notices:
            for before in AROUND:
                for after in ("", AROUND[4], AROUND[2]):
                    texts.append(f"{before} {notice} {after}")
                    family.append(k)
            words = notice.split()
            for _ in range(6):
                part = words[: max(1, len(words) // 3)] if rng.random() < 0.5 else list(rng.permutation(words))
                texts.append(" ".join(part))
                family.append(0)
    return texts, family


class LicenceModel:
    """Weights of the n-grams seen in training, temperature, and the templates' word pairs."""

    def __init__(self, negatives: list[str], seed: int = 5, rounds: int = 200):
        self.families = ["unknown", *TEMPLATES]
        texts, family = variants(seed)
        unlisted = [f"{before} {notice} {after}" for notice in UNLISTED for before in AROUND for after in ("", AROUND[4])]
        named = np.array([k > 0 for k in family] + [True] * len(unlisted) + [False] * len(negatives))
        texts, family = texts + unlisted + negatives, np.array(family + [0] * (len(unlisted) + len(negatives)))
        rows = [np.unique(np.concatenate(_codes(t) or [np.zeros(0, np.uint64)])) for t in texts]
        notices = np.unique(np.concatenate([r for r, k in zip(rows, named) if k]))
        self.codes = notices
        at = [np.searchsorted(notices, r[np.isin(r, notices)]) for r in rows]
        held = np.arange(len(texts)) % 5 == 4
        self.weights = self._fit([a for a, h in zip(at, held) if not h], family[~held], rounds)
        self.temperature = self._calibrate([a for a, h in zip(at, held) if h], family[held])
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[notices >> np.uint64(48)] = True
        self.templates = []
        for k, (name, ns) in enumerate(TEMPLATES.items(), 1):
            for n in ns:
                pairs = np.unique(np.searchsorted(notices, _codes(n)[1]))
                self.templates.append((k, pairs, len(_words(n)), *deciding(name, n)))

    @classmethod
    def of(cls, state: dict) -> "LicenceModel":
        """A model from its attributes, which are what is broadcast."""
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made

    def logits(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        out = np.repeat(self.weights[-1:], n, axis=0)
        np.add.at(out, rows, self.weights[cols])
        return out

    def probabilities(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        return self._softmax(self.logits(rows, cols, n) / self.temperature)

    @staticmethod
    def _softmax(logit: np.ndarray) -> np.ndarray:
        logit = np.exp(logit - logit.max(axis=1, keepdims=True))
        return logit / logit.sum(axis=1, keepdims=True)

    def _fit(self, at, family, rounds, ridge: float = 0.02, rate: float = 0.5) -> np.ndarray:
        rows, cols = np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate(at)
        self.weights = np.zeros((len(self.codes) + 1, len(self.families)))
        target = np.eye(len(self.families))[family]
        balance = (1.0 / np.maximum(np.bincount(family, minlength=len(self.families)), 1))[family][:, None] * 20
        squares = np.full_like(self.weights, 1e-6)
        for _ in range(rounds):
            error = (self._softmax(self.logits(rows, cols, len(at))) - target) * np.minimum(balance, 1.0)
            grad = ridge * self.weights
            np.add.at(grad, cols, error[rows])
            grad[-1] += error.sum(axis=0)
            squares += grad ** 2
            self.weights -= rate * grad / np.sqrt(squares)
        return self.weights

    def _calibrate(self, at, family) -> float:
        rows, cols = np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate(at)
        logit = self.logits(rows, cols, len(at))

        def loss(t: float) -> float:
            return -np.log(np.maximum(self._softmax(logit / t)[np.arange(len(at)), family], 1e-12)).mean()

        return min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)

    def _judged(self, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, best family, its probability) of rows that hold n-grams of notices, and all (row, n-gram) as one number."""
        pairs = np.unique(rows * len(self.codes) + at)
        held, row = np.unique(pairs // len(self.codes), return_inverse=True)
        p = self.probabilities(row, pairs % len(self.codes), len(held))
        best = p[:, 1:].argmax(axis=1) + 1 if len(held) else np.zeros(0, np.int64)
        return held, best, p[np.arange(len(held)), best], pairs

    @staticmethod
    def _decided(words: np.ndarray, needed: list[np.ndarray], refused: np.ndarray) -> bool:
        return all(np.isin(x, words).any() for x in needed) and not np.isin(refused, words).any()

    def classify(self, chunk: Chunk, contained: float = CONTAINED):
        """(text, family, probability, containment) of each family of each paragraph that holds n-grams of notices;
        the containment is 0 where the deciding words do not agree."""
        words, line, paragraph, owner = paragraph_words(chunk)
        starts, lasts, codes_at = [], [], []
        for n, (first, codes) in enumerate(grams(words, paragraph), 1):
            near = self.sieve[codes >> np.uint64(48)]
            first, codes = first[near], codes[near]
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            hit = self.codes[at] == codes
            starts.append(first[hit])
            lasts.append(first[hit] + n - 1)
            codes_at.append(at[hit])
        start, last, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lasts, codes_at))
        order = np.argsort(start, kind="stable")
        start, last, at = start[order], last[order], at[order]
        found: dict[tuple[int, int], tuple[float, float]] = {}

        def note(where: int, family: int, p: float, share: float) -> None:
            old = found.get((where, family), (-1.0, 0.0))
            found[where, family] = max(old, (share, p))

        # Lines, and paragraphs of several lines.
        in_line = line[start] == line[last]
        lines_of = np.bincount(paragraph[np.flatnonzero(np.diff(line, prepend=-1))], minlength=len(owner))
        wrapped = lines_of[paragraph[start]] > 1
        for unit, rows, cols in ((line, line[start[in_line]], at[in_line]),
                                 (paragraph, paragraph[start[wrapped]], at[wrapped])):
            held, best, p, pairs = self._judged(rows, cols)
            for k in np.flatnonzero(p >= THRESHOLD):
                low, high = np.searchsorted(pairs, (held[k] * len(self.codes), (held[k] + 1) * len(self.codes)))
                own = pairs[low:high] % len(self.codes)
                a, b = np.searchsorted(unit, held[k]), np.searchsorted(unit, held[k], "right")
                share = max(np.isin(c, own).mean() if self._decided(words[a:b], *rule) else 0.0
                            for f, c, _, *rule in self.templates if f == best[k])
                note(int(paragraph[a]), int(best[k]), float(p[k]), float(share))
        # Runs of words of about a template's length, wherever they stand in a paragraph.
        two = last == start + 1
        two_start, two_at = start[two], at[two]
        ends = np.searchsorted(paragraph, np.arange(len(owner)), "right")
        for family, pairs, length, *rule in self.templates:
            mine = np.isin(two_at, pairs)
            s, c = two_start[mine], two_at[mine]
            limit = np.minimum(s + length + max(4, length // 4), ends[paragraph[s]])
            stop, need = np.searchsorted(s + 2, limit, "right"), contained * len(pairs)
            for i in np.flatnonzero(stop - np.arange(len(s)) >= need):
                where = int(paragraph[s[i]])
                if found.get((where, family), (0.0, 0.0))[0] >= contained:
                    continue
                share = len(np.unique(c[i : stop[i]])) / len(pairs)
                a, b = s[i], s[stop[i] - 1] + 2
                if share < contained or not self._decided(words[a:b], *rule):
                    continue
                low, high = np.searchsorted(start, (a, b))
                own = at[low:high][last[low:high] < b]
                _, best, p, _ = self._judged(np.zeros(len(own), np.int64), own)
                if best[0] == family and p[0] >= THRESHOLD:
                    note(where, family, float(p[0]), share)
        keys = sorted(found)
        return (owner[[w for w, _ in keys]] if keys else np.zeros(0, np.int64), np.array([f for _, f in keys], np.int64),
                np.array([found[k][1] for k in keys], float), np.array([found[k][0] for k in keys], float))


def train(docs: DataFrame, text: str = "text", negatives: int = NEGATIVES) -> LicenceModel:
    """The model, with up to ``negatives`` paragraphs (cut to 400 characters for training) of a random part of the
    corpus as examples of unknown text."""
    rows = docs.where(F.col(text).isNotNull())
    total = rows.count()
    lines = (rows.sample(min(1.0, 2 * negatives / max(total, 1)), seed=3)
             .select(F.explode(F.split(F.col(text), "\n")).alias("line"))
             .where(~F.col("line").rlike(CUE)).select(F.substring("line", 1, 400).alias("line")).limit(negatives))
    return LicenceModel([r["line"] for r in lines.collect()])


FOUND = T.ArrayType(T.StructType([T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()),
                                  T.StructField("contained", T.DoubleType())]))


def scan(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraphs: family, probability and containment of each family that the classifier finds in a
    paragraph, in reading order) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("paragraphs", FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LicenceModel.of(shared.value)
        names = pa.array(model.families)
        for batch in batches:
            for chunk in chunks(batch.column(1), lower=True):
                owner, family, p, contained = model.classify(chunk)
                bounds = np.searchsorted(owner, np.arange(len(chunk) + 1))
                found = pa.StructArray.from_arrays([names.take(pa.array(family)), pa.array(p), pa.array(contained)],
                                                   ["family", "probability", "contained"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)], names=schema.names)

    return docs.select(id_col, text).mapInArrow(run, schema)


def licences(docs: DataFrame, id_col: str = "doc_id", text: str = "text", contained: float = CONTAINED) -> DataFrame:
    """Per row of ``docs``: doc_id, licences (the confirmed families, sorted), n_confirmed and n_unconfirmed
    (families of paragraphs)."""
    found = scan(docs, train(docs, text), id_col, text)
    sure = F.filter("paragraphs", lambda p: p["contained"] >= contained)
    return found.select(
        "doc_id", F.array_sort(F.array_distinct(F.transform(sure, lambda p: p["family"]))).alias("licences"),
        F.size(sure).cast("long").alias("n_confirmed"),
        (F.size("paragraphs") - F.size(sure)).cast("long").alias("n_unconfirmed"))
