"""Operator 8, toxicity by weak supervision.

Voters. Words of a fixed insult lexicon, word forms and word beginnings that the labelled training rows show to be
far more frequent in toxic texts (counted by an aggregation), and patterns (repeated exclamation marks, starred
words). A voter votes toxic where it occurs and abstains elsewhere; "no voter fires" votes the other
way; the annotator's label of a training row is a voter as well.

Label model. Expectation maximisation estimates every voter's rate of firing in either class from the votes of a
bounded sample; voters that agree beyond what their class explains are correlated, and share the weight of one.

Classifier. A linear model over the voters' occurrences is fitted to the posterior labels, and scores every whole
text. Language, source, id and label are never inputs.

Learning uses about ``MAX_ROWS`` labels of each class, chosen by a hash of the id; each stands for as many labels as its
class has for one chosen. Defined results: null and empty texts get the score of a text without
any feature; a null doc_id is no held-out row and never learnt from; repeated rows get equal scores; without labels
the lexicon alone decides; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.llm.storage import stored
from widelines.llm.textkernel import ALNUM_WORDS, Chunk, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Common English insults.
LEXICON = ("idiot idiots moron morons stupid dumb pathetic worthless loser losers scum trash garbage clown disgusting "
           "imbecile jerk fool ugly hate filthy vermin coward degenerate freak creep lunatic shut disgrace "
           "useless").split()
PREFIXES = (4, 5, 6)
#: Voters learnt at most, and labels of each class that are learnt from, about (their ids are broadcast).
MAX_VOTERS = 4096
MAX_ROWS = 20_000
HASH_RANGE = 1 << 40
MIN_TOXIC_TEXTS = 3
MIN_GAIN = 12.0
#: Patterns by the byte that repeats: a text with three or more "!" or "*".
PATTERNS = {33: np.uint64(1), 42: np.uint64(2)}


def features(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text of each, feature code) of word forms, word beginnings and patterns, kind after kind; repeats included."""
    starts, ends, first = chunk.words(ALNUM_WORDS)
    owner = np.repeat(np.arange(len(chunk)), np.diff(first))
    yield owner, mix(span_hashes(chunk.data, starts, ends), 40)
    if len(starts):
        points = np.flatnonzero((chunk.data & 0xC0) != 0x80)
        number = np.searchsorted(points, starts)
        bounds = np.append(points, len(chunk.data))
        for k in PREFIXES:
            stop = bounds[np.minimum(number + k, len(points))]
            long = stop < ends
            yield owner[long], mix(span_hashes(chunk.data, starts[long], stop[long]), 40 + k)
    for byte, code in PATTERNS.items():
        marks = np.concatenate([[0], np.cumsum(chunk.data == byte)])
        held = np.flatnonzero(np.diff(marks[chunk.bounds]) >= 3)
        yield held, np.full(len(held), code)


def word_code(word: str) -> int:
    _, codes = next(features(next(chunks(pa.array([word])))))
    return int(codes[0])


def voter_counts(labelled: DataFrame) -> DataFrame:
    """(code, toxic, other): texts that hold each feature, over all of ``labelled`` (text, toxic); summed per batch
    before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for chunk in chunks(batch.column(0), lower=True):
                for owner, codes in features(chunk):
                    order = np.lexsort((codes, owner))
                    owner, codes = owner[order], codes[order]
                    new = np.ones(len(codes), bool)
                    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
                    kinds, inverse = np.unique(codes[new], return_inverse=True)
                    bad = np.bincount(inverse, toxic[chunk.first + owner[new]], len(kinds))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kinds.view(np.int64)), pa.array(bad.astype(np.int64)),
                         pa.array((np.bincount(inverse, minlength=len(kinds)) - bad).astype(np.int64))],
                        names=["code", "toxic", "other"])

    counted = labelled.select("text", "toxic").mapInArrow(run, "code long, toxic long, other long")
    return counted.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learnt_codes(labelled: DataFrame, n_toxic: int, n_other: int, limit: int = MAX_VOTERS) -> list[int]:
    """Features far more frequent in toxic texts, by log-likelihood gain; a top list of bounded length."""
    p = n_toxic / max(n_toxic + n_other, 1)
    rate = F.col("toxic") / (F.col("toxic") + F.col("other"))
    gain = 2 * (F.col("toxic") * F.log(rate / p) + F.when(F.col("other") > 0, F.col("other") * F.log((1 - rate) / (1 - p))).otherwise(0))
    top = (voter_counts(labelled).where(F.col("toxic") >= MIN_TOXIC_TEXTS).where(rate > min(2 * p, (1 + p) / 2))
           .withColumn("gain", gain).where(F.col("gain") >= MIN_GAIN).orderBy(F.desc("gain"), "code").limit(limit))
    return [r["code"] for r in top.select("code").collect()]


def _occurring(chunk: Chunk, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, index in the sorted ``codes``) of the chunk."""
    sieve = np.zeros(1 << 16, bool)
    sieve[codes >> np.uint64(48)] = True
    pairs = []
    for owner, found in features(chunk):
        near = sieve[found >> np.uint64(48)]
        owner, found = owner[near], found[near]
        at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        hit = codes[at] == found
        pairs.append(owner[hit] * len(codes) + at[hit])
    pairs = np.unique(np.concatenate(pairs))
    return pairs // len(codes), pairs % len(codes)


def votes(df: DataFrame, codes: np.ndarray, toxic: str) -> DataFrame:
    """(toxic, voters: indices of the voters that fire) per row of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), lower=True):
                owner, at = _occurring(chunk, codes)
                bounds = np.searchsorted(owner, np.arange(len(chunk) + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(chunk.first, len(chunk)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at, pa.int32()))],
                    names=["toxic", "voters"])

    return df.select("text", F.col(toxic).cast("int").alias("toxic")).mapInArrow(run, "toxic int, voters array<int>")


def label_model(rows: np.ndarray, cols: np.ndarray, n_voters: int, labels: np.ndarray, counts: np.ndarray,
                rounds: int = 30) -> np.ndarray:
    """Posterior of being toxic for each text, from votes (text ``rows[i]``, voter ``cols[i]``) and annotator labels
    (1, 0, or -1 for none); a text counts as ``counts`` texts. Voters that fire together beyond their class's rates share their weight."""
    n = len(labels)
    fired = np.bincount(rows, minlength=n) > 0
    post = np.where(labels >= 0, np.where(labels == 1, 0.9, 0.1), np.where(fired, 0.7, 0.1))
    for step in range(rounds):
        weight = np.stack([1 - post, post]) * counts
        total = weight.sum(axis=1) + 2.0
        firing = np.stack([np.bincount(cols, w[rows], n_voters) + 1.0 for w in weight]) / total[:, None]
        if step in (0, rounds // 2):
            share = _shares(rows, cols, n_voters, firing, weight.sum(axis=1))
        vote = np.log(firing[1] / firing[0]) * share
        silent = np.log((weight[1][~fired].sum() + 1) / total[1]) - np.log((weight[0][~fired].sum() + 1) / total[0])
        prior = np.log(total[1] / total[0])
        says = np.stack([[weight[c][labels == l].sum() + 1.0 for l in (0, 1)] for c in (0, 1)])
        says /= says.sum(axis=1, keepdims=True)
        logit = prior + np.bincount(rows, vote[cols], n) + np.where(fired, 0.0, silent)
        for l in (0, 1):
            logit[labels == l] += np.log(says[1, l] / says[0, l])
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post


def _shares(rows, cols, n_voters, firing, mass, texts: int = 2000, block: int = 512) -> np.ndarray:
    """1 / (1 + correlated partners) of each voter, from co-occurrence in ``texts`` of the texts that any voter marks.
    Two voters are correlated when they fire together more than half as often as they could, beyond their classes."""
    marked = np.unique(rows)
    marked = marked[:: max(1, len(marked) // texts)]
    at = np.minimum(np.searchsorted(marked, rows), max(len(marked) - 1, 0))
    own = marked[at] == rows if len(marked) else np.zeros(0, bool)
    table = np.zeros((len(marked), n_voters), np.float32)
    table[at[own], cols[own]] = 1
    often = np.sqrt(np.maximum(table.sum(axis=0), 1.0))
    part = len(marked) / max(len(np.unique(rows)), 1)
    partners = np.zeros(n_voters)
    for k in range(0, n_voters, block):
        own = slice(k, k + block)
        expected = sum(np.outer(firing[c][own], firing[c]) * (mass[c] * part) for c in (0, 1))
        tied = (table[:, own].T @ table - expected) / np.outer(often[own], often) > 0.5
        partners[own] = tied.sum(axis=1) - tied[np.arange(len(tied)), k + np.arange(len(tied))]
    return 1.0 / (1.0 + partners)


def fit_linear(rows: np.ndarray, cols: np.ndarray, n_voters: int, target: np.ndarray, counts: np.ndarray,
               ridge: float = 0.05, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression of soft labels on occurrences, by accelerated gradient steps."""
    n, total = max(len(target), 1), max(counts.sum(), 1.0)
    degree = np.bincount(rows, minlength=n)
    rate = 4.0 / (1.0 + np.mean(degree) + degree.max(initial=0))
    w, b = np.zeros(n_voters), float(np.log((target @ counts + 0.5) / (total - target @ counts + 0.5)))
    u, c = w.copy(), b
    scale = np.maximum(np.bincount(cols, counts[rows], n_voters), 1.0)
    for step in range(rounds):
        logit = c + np.bincount(rows, u[cols], n)
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) * counts
        grad = (np.bincount(cols, error[rows], n_voters) + ridge * u) / scale
        new_w, new_b = u - rate * grad, c - 4.0 * error.sum() / total
        push = step / (step + 3.0)
        u, c = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    return w, b


def chosen_labels(known: DataFrame, max_rows: int = MAX_ROWS) -> tuple[DataFrame, dict[bool, float]]:
    """(doc_id, toxic) of at most about ``max_rows`` labels of each class, chosen by a hash of the id so that no
    layout matters, and for each class the labels that one of them stands for."""
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, max_rows / n) for k, n in size.items()}
    limit = F.when(F.col("toxic"), F.lit(math.ceil(share.get(True, 1.0) * HASH_RANGE))).otherwise(
        F.lit(math.ceil(share.get(False, 1.0) * HASH_RANGE)))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < limit), {k: 1 / s for k, s in share.items()}


def train(docs: DataFrame, known: DataFrame, max_rows: int = MAX_ROWS, max_voters: int = MAX_VOTERS):
    """(sorted feature codes, weights, intercept) from the texts of ``docs`` (doc_id, text) that ``known`` (doc_id,
    toxic) labels. The chosen labels are broadcast, so that one scan of the texts finds theirs and none is shuffled."""
    chosen, weight = chosen_labels(known, max_rows)
    labelled = stored(docs.join(F.broadcast(chosen), "doc_id"), "labelled")
    size = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)).alias("t")).first()
    lexicon = [word_code(w) for w in LEXICON]
    learnt = learnt_codes(labelled, size["t"], size["n"] - size["t"], max_voters) if 0 < size["t"] < size["n"] else []
    codes = np.unique(np.concatenate([np.array(lexicon + [int(c) for c in PATTERNS.values()], np.uint64), _unsigned(learnt)]))
    table = votes(labelled, codes, "toxic").toArrow()
    if not table.num_rows:
        return codes, np.isin(codes, np.array(lexicon, np.uint64)) * 4.0, -3.0
    counts = table["voters"].combine_chunks().value_lengths().to_numpy()
    rows = np.repeat(np.arange(table.num_rows), counts)
    cols = table["voters"].combine_chunks().flatten().to_numpy().astype(np.int64)
    labels = table["toxic"].to_numpy().astype(np.int64)
    stands_for = np.where(labels == 1, weight.get(True, 1.0), weight.get(False, 1.0))
    post = label_model(rows, cols, len(codes), labels, stands_for)
    weights, base = fit_linear(rows, cols, len(codes), post, stands_for)
    unseen = np.isin(codes, np.array(lexicon, np.uint64)) & (np.bincount(cols, minlength=len(codes)) == 0)
    return codes, np.where(unseen, 4.0, weights), base


def _unsigned(codes) -> np.ndarray:
    return np.array(codes, np.int64).view(np.uint64) if len(codes) else np.zeros(0, np.uint64)


def score_texts(df: DataFrame, model, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with a score of 0 to 1 for each text; without a shuffle. The model is at most a few dozen KB."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = [c for c in df.columns if c != text]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, weights, base = shared.value
        for batch in batches:
            for chunk in chunks(batch.column(0), lower=True):
                owner, at = _occurring(chunk, codes)
                logit = base + np.bincount(owner, weights[at], len(chunk))
                part = batch.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], names=schema.names)

    return df.select(text, *names).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id's decimal text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. Learns from ``labels`` (doc_id, toxic) of rows that
    are not held out; a doc_id with several labels counts with each."""
    bare = docs.select("doc_id", "text")
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(
        "doc_id", (F.col("toxic") == 1).alias("toxic"))
    model = train(bare, known)
    scored = score_texts(bare, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
