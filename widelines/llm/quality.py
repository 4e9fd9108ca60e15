"""Operator 1, quality rules: a short-circuit cascade ordered by rejection per cost.

Each rule sees only the texts that all earlier rules let pass. ``rule_order`` times every rule on a sample, inside
tasks, and puts first the rule that rejects most per second. The order changes the cost, never the verdict: a text
is kept when no rule rejects it.

Defined results: a null or empty text has no words and is rejected (too few words); any other column may be null
and is passed through; repeated rows are judged each on its own; an empty table gives an empty table.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.llm.textkernel import WHITESPACE_WORDS, Chunk, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTERS = UPPER.copy()
LETTERS[97:123] = True
DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
#: Rows of the sample on which rules are timed; the verdicts do not depend on it.
SAMPLE_ROWS = 2000


class Features:
    """Measures of the texts of a chunk, each made when first asked for; ``take`` narrows to the texts that pass."""

    def __init__(self, chunk: Chunk):
        self.chunk, self._made = chunk, {}

    def _get(self, name: str, make: Callable):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def _per_text(self, marked: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
        return np.diff(sums[self.chunk.bounds])

    def words(self):
        return self._get("words", lambda: self.chunk.words(WHITESPACE_WORDS))

    def n_words(self) -> np.ndarray:
        return np.diff(self.words()[2])

    def word_chars(self) -> np.ndarray:
        return self._get("word_chars", lambda: self._per_text(
            WHITESPACE_WORDS[self.chunk.data] & ((self.chunk.data & 0xC0) != 0x80)))

    def n_symbols(self) -> np.ndarray:
        return self._get("n_symbols", lambda: self._per_text(SYMBOLS[self.chunk.data]))

    def n_upper(self) -> np.ndarray:
        return self._get("n_upper", lambda: self._per_text(UPPER[self.chunk.data]))

    def n_letters(self) -> np.ndarray:
        return self._get("n_letters", lambda: self._per_text(LETTERS[self.chunk.data]))

    def n_digits(self) -> np.ndarray:
        return self._get("n_digits", lambda: self._per_text(DIGITS[self.chunk.data]))

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines that hold a word, and how many of them equal an earlier line of their text."""
        return self._get("lines", self._lines)

    def _lines(self):
        starts, ends, first = self.chunk.lines()
        inside = np.concatenate([[0], np.cumsum(WHITESPACE_WORDS[self.chunk.data], dtype=np.int64)])
        worded = inside[ends] > inside[starts]
        owner = np.repeat(np.arange(len(self.chunk)), np.diff(first))[worded]
        hashes = span_hashes(self.chunk.data, starts[worded], ends[worded])
        order = np.lexsort((hashes, owner))
        same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        return (np.bincount(owner, minlength=len(self.chunk)),
                np.bincount(owner[order][1:][same], minlength=len(self.chunk)))

    def n_repeat_words(self) -> np.ndarray:
        return self._get("n_repeat_words", self._repeat_words)

    def _repeat_words(self) -> np.ndarray:
        """Words in 3-word windows that the text holds twice or more."""
        starts, ends, first = self.words()
        hashes = span_hashes(self.chunk.data, starts, ends)
        covered = np.zeros(len(starts), bool)
        if len(starts) >= 3:
            windows = mix(mix(mix(hashes[:-2]) + hashes[1:-1]) + hashes[2:])
            for a, b in zip(first[:-1], first[1:]):
                if b - a < 4:
                    continue
                own = windows[a : b - 2]
                order = np.argsort(own, kind="stable")
                ranked = own[order]
                same = ranked[1:] == ranked[:-1]
                if same.any():
                    again = a + np.concatenate([order[1:][same], order[:-1][same]])
                    for shift in range(3):
                        covered[again + shift] = True
        sums = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
        return np.diff(sums[first])

    def take(self, mask: np.ndarray) -> "Features":
        lengths = np.diff(self.chunk.bounds)
        bounds = np.concatenate([[0], np.cumsum(lengths[mask])])
        part = Features(Chunk(self.chunk.first, self.chunk.first + int(mask.sum()),
                              self.chunk.data[np.repeat(mask, lengths)], bounds))
        for name, value in self._made.items():
            if name == "words":
                starts, ends, first = value
                counts = np.diff(first)
                own = np.repeat(mask, counts)
                moved = np.repeat(bounds[:-1] - self.chunk.bounds[:-1][mask], counts[mask])
                part._made[name] = (starts[own] + moved, ends[own] + moved,
                                    np.concatenate([[0], np.cumsum(counts[mask])]))
            elif name == "lines":
                part._made[name] = (value[0][mask], value[1][mask])
            else:
                part._made[name] = value[mask]
        return part


#: The base rules of the contract; each gives True for texts it rejects.
BASE_RULES: dict[str, Callable[[Features], np.ndarray]] = {
    "few_words": lambda f: f.n_words() < 50,
    "repeated_windows": lambda f: 100 * f.n_repeat_words() > 50 * f.n_words(),
}
RULES: dict[str, Callable[[Features], np.ndarray]] = {
    **BASE_RULES,
    "symbols": lambda f: 10 * f.n_symbols() > 3 * f.n_words(),
    "shouting": lambda f: 10 * f.n_upper() > 6 * np.maximum(f.n_letters(), 1),
    "word_length": lambda f: (f.word_chars() < 2 * f.n_words()) | (f.word_chars() > 20 * f.n_words()),
    "duplicate_lines": lambda f: 10 * f.lines()[1] > 4 * np.maximum(f.lines()[0], 1),
    "digits": lambda f: 2 * f.n_digits() > f.word_chars(),
}


def cascade(features: Features, order: list[str], rules=RULES) -> np.ndarray:
    """For each text, the position in ``order`` of the rule that rejects it, or -1."""
    verdict = np.full(len(features.chunk), -1)
    alive = np.arange(len(features.chunk))
    for k, name in enumerate(order):
        if not len(alive):
            break
        rejected = rules[name](features)
        if rejected.any():
            verdict[alive[rejected]] = k
            alive = alive[~rejected]
            features = features.take(~rejected)
    return verdict


def rule_order(df: DataFrame, text: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by texts rejected per second on a random sample of about ``sample_rows`` rows, best first.

    The rules are timed in the tasks that hold the sample; one small row per rule reaches the driver."""
    total = df.count()
    names = list(rules)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                for name in names:
                    began = time.process_time()
                    rejected = int(rules[name](Features(chunk)).sum())
                    yield pa.RecordBatch.from_pydict({
                        "rule": [name], "rejected": [rejected], "seconds": [time.process_time() - began]})

    share = min(1.0, sample_rows / total) if total else 1.0
    found = (df.select(F.col(text).alias("text")).sample(share, seed=7)
             .mapInArrow(profile, "rule string, rejected long, seconds double")
             .groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect())
    worth = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in found}
    return sorted(names, key=lambda name: (-worth.get(name, 0.0), names.index(name)))


def keep_good(df: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """The rows whose text every rule lets pass, with all their columns; no shuffle."""
    order = order or rule_order(df, text)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [cascade(Features(c), order) < 0 for c in chunks(batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return df.mapInArrow(run, df.schema)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def assess(df: DataFrame, id_col: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: its id, the base measures, ``base_failed``, ``kept`` and ``rejected_by``
    (the first rule of this run's order that rejects; null if kept)."""
    order = order or rule_order(df, text)
    names = pa.array(order, pa.string())
    out = T.StructType([T.StructField(id_col, df.schema[id_col].dataType)]
                       + [T.StructField(m, T.LongType()) for m in MEASURES]
                       + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
                          T.StructField("rejected_by", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                f = Features(chunk)
                base = np.zeros(len(chunk), bool)
                for rule in BASE_RULES.values():
                    base |= rule(f)
                measures = [f.n_words(), f.word_chars(), f.n_symbols(), f.lines()[1], f.n_repeat_words()]
                verdict = cascade(f, order)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), *(pa.array(m.astype(np.int64)) for m in measures),
                     pa.array(base), pa.array(verdict < 0),
                     names.take(pa.array(verdict, mask=verdict < 0))], names=out.names)

    return df.select(id_col, text).mapInArrow(run, out)
