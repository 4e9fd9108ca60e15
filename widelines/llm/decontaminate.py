"""Operator 6, benchmark decontamination: suffix arrays over the training texts, searched by every test suffix.

Each task turns its share of the corpus into shards of a few megabytes and builds a word-level suffix array of each,
over the suffixes that can match at all (their first words begin some test window). All distinct test windows are
then looked up by binary search; neighbouring hits on one diagonal join into the longest verbatim matches, with
their places in document and item. No shuffle; a shard's memory is bounded whatever the corpus holds, except that one
document is never split.

The test set travels as broadcast blocks of at most ``BLOCK_BYTES`` of text each (one item is never split): the
driver asks for the size first, and a larger set is taken block after block, each pass adding to the last one's
columns, so nothing is left out.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.

Defined results: null or empty text has no words and no hit; an item without words hits nothing; an item whose id is
null hits words but is not named; rows with equal or null ids are judged each on its own; without documents or
without test items the result is empty or without hits.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.llm.storage import stored
from widelines.llm.textkernel import ALNUM_WORDS, Chunk, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text of a block of test items: bounds what is sent to the driver and broadcast at once.
BLOCK_BYTES = 16 << 20
#: Passes whose Python workers may run at once in a task; then the columns so far are written out.
CHAINED = 4
ID_BITS, PACKED = 21, 3
FILTER_BITS = 20


def _packed(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, fill: int) -> np.ndarray:
    """The ``width`` word ids from each start as sortable bytes; beyond a length: ``fill``."""
    groups = -(-width // PACKED)
    out = np.zeros((len(starts), groups), np.uint64)
    for g in range(groups):
        for k in range(g * PACKED, (g + 1) * PACKED):
            word = np.where(k < lengths, ids[np.minimum(starts + k, len(ids) - 1)], fill if k < width else 0)
            out[:, g] = (out[:, g] << np.uint64(ID_BITS)) | word.astype(np.uint64)
    return np.ascontiguousarray(out.astype(">u8")).view(f"S{8 * groups}").ravel()


class TestIndex:
    """The distinct windows of a block of test items, ready for search."""

    __test__ = False  # not a pytest class

    def __init__(self, names: list[str | None], texts: list[str | None], window: int):
        self.window = window
        self.names = sorted({n for n in names if n is not None})
        number = {n: k for k, n in enumerate(self.names)}
        words, owner, place, length, flat, base = [], [], [], [], [], 0
        for chunk in chunks(pa.array(texts, pa.large_string()), lower=True):
            starts, ends, first = chunk.words(ALNUM_WORDS)
            words.append(span_hashes(chunk.data, starts, ends))
            for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
                own = max(int(b - a) - window + 1, min(int(b - a), 1))
                owner += [number.get(names[chunk.first + k], -1)] * own
                place += range(own)
                length += [min(int(b - a), window)] * own
                flat += range(base + int(a), base + int(a) + own)
            base += len(starts)
        hashes = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(hashes)
        if len(self.vocabulary) + 1 >= 1 << ID_BITS:
            raise ValueError("a block of test items has too many different words; lower block_bytes")
        ids = np.concatenate([np.searchsorted(self.vocabulary, hashes) + 1, [0]])
        flat, length = np.array(flat, np.int64), np.array(length, np.int64)
        low = _packed(ids, flat, length, window, 0)
        self.low, first, kind = np.unique(low, return_index=True, return_inverse=True)
        self.length = length[first]
        self.high = _packed(ids, flat[first], self.length, window, (1 << ID_BITS) - 1)
        order = np.argsort(kind, kind="stable")
        self.owner, self.place = np.array(owner, np.int64)[order], np.array(place, np.int64)[order]
        self.first = np.searchsorted(kind[order], np.arange(len(self.low) + 1))
        begins = self._begins(ids, flat[first])
        self.begins = np.unique(begins[self.length >= PACKED])
        self.short = np.unique(ids[flat[first][self.length < PACKED]])
        self.may_begin = np.zeros(1 << FILTER_BITS, bool)
        self.may_begin[mix(self.begins) >> np.uint64(64 - FILTER_BITS)] = True

    @classmethod
    def of(cls, state: dict) -> "TestIndex":
        """An index from its attributes, which are what is broadcast (arrays, a number and a list of names)."""
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made

    @staticmethod
    def _begins(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for k in range(PACKED):
            out = (out << np.uint64(ID_BITS)) | ids[np.minimum(at + k, len(ids) - 1)].astype(np.uint64)
        return out

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def suffixes(self, ids: np.ndarray) -> np.ndarray:
        """Positions at which a test window may begin."""
        begins = self._begins(ids, np.arange(len(ids)))
        at = np.flatnonzero(self.may_begin[mix(begins) >> np.uint64(64 - FILTER_BITS)])
        found = np.zeros(len(ids), bool)
        found[at[np.isin(begins[at], self.begins)]] = True
        if len(self.short):
            found |= np.isin(ids, self.short)
        return np.flatnonzero(found)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence of a test window in a shard; 0 in ``ids`` matches nothing."""
        at = self.suffixes(ids)
        keys = _packed(ids, at, np.full(len(at), self.window), self.window, 0)
        order = np.argsort(keys, kind="stable")
        array, keys = at[order], keys[order]
        left, right = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        counts = np.maximum(right - left, 0)
        kinds = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(kinds)) - np.repeat(np.cumsum(counts) - counts, counts)
        return array[left[kinds] + within], kinds


def _longest(index: TestIndex, at: np.ndarray, kinds: np.ndarray):
    """(item, item_start, start, length) of the longest verbatim matches: runs of hits on one diagonal of one item."""
    counts = np.diff(index.first)[kinds]
    start, length = np.repeat(at, counts), np.repeat(index.length[kinds], counts)
    use = np.repeat(index.first[kinds], counts) + np.arange(len(start)) - np.repeat(np.cumsum(counts) - counts, counts)
    item, place = index.owner[use], index.place[use]
    order = np.lexsort((length, start, start - place, item))
    item, place, start, length = item[order], place[order], start[order], length[order]
    last = np.ones(len(start), bool)  # items that share an id and a text hit twice: the longest counts
    last[:-1] = (item[1:] != item[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1])
    item, place, start, length = item[last], place[last], start[last], length[last]
    new = np.ones(len(start), bool)
    new[1:] = (item[1:] != item[:-1]) | (start[1:] - place[1:] != start[:-1] - place[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1 if len(head) else head
    return item[head], place[head], start[head], start[tail] - start[head] + length[tail]


MATCH = T.StructType([T.StructField("item", T.StringType()), T.StructField("item_start", T.LongType()),
                      T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = [T.StructField("_n_words", T.LongType()), T.StructField("_spans", T.ArrayType(SPAN)),
         T.StructField("_matches", T.ArrayType(MATCH))]


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _shard(index: TestIndex, chunk: Chunk, spans_before) -> list[pa.Array]:
    starts, ends, first = chunk.words(ALNUM_WORDS)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(chunk)), counts)
    ids = np.zeros(len(starts) + len(chunk) + index.window, np.int64)
    ids[np.arange(len(starts)) + owner] = index.word_ids(span_hashes(chunk.data, starts, ends))
    base = first + np.arange(len(first))  # a text's first word, with one empty place after each text
    at, kinds = index.search(ids)
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + index.length[kinds], -1)
    if spans_before is not None:
        for row, spans in enumerate(spans_before):
            for span in spans.as_py() or ():
                depth[base[row] + span["start"]] += 1
                depth[base[row] + span["end"]] -= 1
    edge = np.diff(np.concatenate([[0], (np.cumsum(depth) > 0).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(base, begin, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(begin - base[row]), pa.array(end - base[row])], ["start", "end"])
    out = [pa.array(counts.astype(np.int64)), _lists(np.bincount(row, minlength=len(chunk)), spans)]
    item, place, start, length = _longest(index, at, kinds)
    order = np.argsort(start, kind="stable")
    item, place, start, length = item[order], place[order], start[order], length[order]
    row = np.searchsorted(base, start, "right") - 1
    named = pa.array(index.names, pa.string()).take(pa.array(item, mask=item < 0))
    matches = pa.StructArray.from_arrays([named, pa.array(place), pa.array(start - base[row]), pa.array(length)],
                                         ["item", "item_start", "start", "length"])
    out.append(_lists(np.bincount(row, minlength=len(chunk)), matches))
    return out


def _pass(df: DataFrame, shared, text: str, again: bool) -> DataFrame:
    columns = df.columns[: -len(FOUND)] if again else df.columns
    at = columns.index(text)
    schema = T.StructType([df.schema[c] for c in columns] + FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = TestIndex.of(shared.value)
        for batch in batches:
            for chunk in chunks(batch.column(at), lower=True):
                part = batch.slice(chunk.first, len(chunk))
                before = part.column(len(columns) + 1) if again else None
                found = _shard(search, chunk, before)
                if again:
                    old = part.column(len(columns) + 2).to_pylist()
                    found[2] = pa.array([a + b for a, b in zip(old, found[2].to_pylist())], found[2].type)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], *found], names=schema.names)

    return df.mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> Iterator[TestIndex]:
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where(
        F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / block_bytes))
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else rows
        found = block.collect()
        yield TestIndex([r["item"] for r in found], [r["text"] for r in found], window)


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``_n_words``, ``_spans`` (maximal runs of hit words, [start, end)) and ``_matches`` (the longest
    verbatim matches with each item: item, item_start, start, length). ``docs`` must not have these columns."""
    out, spark = docs, docs.sparkSession
    for k, index in enumerate(_blocks(benchmark, item_id, item_text, window, block_bytes)):
        if k and k % CHAINED == 0:
            out = stored(out, "matches")
        out = _pass(out, spark.sparkContext.broadcast(vars(index)), text, again=k > 0)
    return out


def hit_words() -> F.Column:
    return F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated() -> F.Column:
    """At least one word in twenty lies in an occurrence of a test window."""
    return (hit_words() > 0) & (20 * hit_words() >= F.col("_n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with their columns as they were."""
    names = docs.columns
    numbered = docs.toDF(*(f"c{k}" for k in range(len(names))))  # so that no column's name clashes with the result's
    found = find_matches(numbered, benchmark, f"c{names.index(text)}", **options)
    return found.where(~contaminated()).select(*numbered.columns).toDF(*names)
