"""Operator 13, spelling variants: generated edits probed against length-sharded blocked Bloom filters.

Words are maximal runs of Latin letters, counted over all whole texts; the vocabulary is those of at least
``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences. Each length has a Bloom filter of its vocabulary words in
blocks of 256 bits, eight lanes of which get a bit for each word (words of ``LONG`` code points and more share one,
their length being part of the hash). Every word generates the hashes of its edits: each deletion, probed in the
filter one shorter, and each replacement by a later letter, probed in its own; so each pair of near words is found
from exactly one side, and insertions are the other side's deletions. Only edits that a filter holds become strings.
They are shuffled to a join with the vocabulary on the whole string, which removes false positives.

Filters of ``FILTER_BYTES`` at most are broadcast at once. A larger vocabulary is probed in several passes, each with
the filters of other lengths, or other slices (by hash) of one length.

A word's form is its most frequent near word if that is at least twice as frequent. Since counts at least double
along forms, a chain of forms has no more than log2(count) steps; roots are found by doubling pointers.

Defined results: null or empty text: no words. A null doc_id counts as an empty one in the hash that deletes a code
point. Repeated rows count as often as they stand there. Equal counts: the smallest word in code-point order is
the form. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.llm.storage import stored
from widelines.llm.textkernel import Chunk, chunks, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_CHARS, MIN_COUNT, EVERY = 5, 3, 97
LONG = 64
WORDS_PER_BLOCK = 16
LANES = 8
BLOCK_BYTES = 4 * LANES
FILTER_BYTES = 32 << 20
PIECE_BLOCKS = 1 << 15
PROBES = 1 << 20
LEAD = 0xC3  # the first of the two bytes of U+00C0 to U+00FF

LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[LEAD] = True
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, (CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), CRC >> np.uint32(1)).astype(np.uint32)
CODES = mix(np.arange(256, dtype=np.uint64), 61)
BASE = 0x9E3779B97F4A7C15
UNBASE = np.uint64(pow(BASE, -1, 2**64))


def crc32_of(data: np.ndarray, first: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span continued from ``before``: all spans a byte at a time, the long ones by themselves."""
    order = np.argsort(-np.minimum(size, LONG), kind="stable")
    state = (before[order] ^ np.uint32(0xFFFFFFFF)).astype(np.uint32)
    at, sizes = first[order], size[order]
    short = np.where(sizes > LONG, 0, sizes)
    begin = int((sizes > LONG).sum())
    for k in range(int(short.max(initial=0))):
        end = int(np.searchsorted(-short[begin:], -k, "left")) + begin  # spans longer than k
        s = state[begin:end]
        state[begin:end] = CRC[(s ^ data[at[begin:end] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty(len(state), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:begin]:
        out[i] = zlib.crc32(data[first[i] : first[i] + size[i]].tobytes(), int(before[i]))
    return out


def chunk_words(chunk: Chunk, doc_ids: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a chunk of lower-cased texts, some less a code point, and the code points of each."""
    inside = LETTERS[chunk.data]
    inside[1:] |= chunk.data[:-1] == LEAD
    starts, ends, first = chunk.spans(inside)
    size = ends - starts
    begin = np.cumsum(size) - size
    flat = chunk.data[inside]
    point = (flat & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(point)])
    length = points[begin + size] - points[begin]
    prefix = np.array([zlib.crc32(b"%s:" % (b"" if d is None else str(d).encode())) for d in doc_ids.to_pylist()], np.uint32)
    crc = crc32_of(flat, begin, size, np.repeat(prefix, np.diff(first)))
    cut = np.flatnonzero(crc % EVERY == 0)
    gone = np.flatnonzero(point)[points[begin[cut]] + crc[cut] % length[cut]]
    keep = np.ones(len(flat), bool)
    keep[gone] = False
    two = gone[flat[gone] == LEAD]
    keep[two + 1] = False
    size[cut] -= 1 + (flat[gone] == LEAD)
    length[cut] -= 1
    words = pa.Array.from_buffers(pa.large_string(), len(size), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])), pa.py_buffer(flat[keep])])
    return words, length


def counted_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the vocabulary with its counts over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), lower=True, size=4 << 20):
                words, length = chunk_words(chunk, batch.column(0).slice(chunk.first, len(chunk)))
                found = pc.value_counts(words.filter(pa.array(length >= MIN_CHARS)))
                yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])

    bare = docs.select(F.col(id_col).cast("string"), F.col(text))
    return bare.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class Words:
    """A column of vocabulary words as code points, with what the hashes of their edits need."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        _, bounds, data = column.buffers()
        bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if len(column) else np.zeros(0, np.uint8)
        more = data >= 0x80
        self.points = (data + np.where(more, 0x40, 0).astype(np.uint8))[data != LEAD]
        before = np.concatenate([[0], np.cumsum(data != LEAD)])
        self.first = before[bounds - bounds[0]]
        self.length = np.diff(self.first)
        self.place = np.arange(len(self.points)) - np.repeat(self.first[:-1], self.length)
        powers = np.full(int(self.length.max(initial=0)) + 1, BASE, np.uint64)
        powers[0] = 1
        self.power = np.cumprod(powers, dtype=np.uint64)[self.place]
        self.term = CODES[self.points] * self.power
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.term, dtype=np.uint64)])
        self.total = sums[self.first[1:]] - sums[self.first[:-1]]
        self.prefix = sums[:-1] - np.repeat(sums[self.first[:-1]], self.length)

    def hashes(self) -> np.ndarray:
        return finished(self.total, self.length)


def finished(sums: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(sums + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 62)


class Shards:
    """Which block of which filter a word's hash belongs to; filters are by length and slice."""

    def __init__(self, counts: dict[int, int], limit: int):
        most = max(limit // BLOCK_BYTES, 1)
        self.blocks, self.slices = np.zeros(LONG + 1, np.int64), np.ones(LONG + 1, np.int64)
        for shard, n in counts.items():
            need = max(64, math.ceil(n / WORDS_PER_BLOCK))
            self.slices[shard] = math.ceil(need / most)
            self.blocks[shard] = math.ceil(need / self.slices[shard])
        self.base = np.cumsum(self.slices) - self.slices  # number of a shard's first slice
        self.passes, held = [[]], 0
        for shard in sorted(counts):
            for part in range(int(self.slices[shard])):
                if held + self.blocks[shard] > most and self.passes[-1]:
                    self.passes.append([])
                    held = 0
                self.passes[-1].append((shard, part))
                held += int(self.blocks[shard])

    def slot(self, hashes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the slice, block in it)."""
        shard = np.minimum(length, LONG)
        part = self.base[shard] + (mix(hashes, 63) % self.slices[shard].astype(np.uint64)).astype(np.int64)
        return part, ((hashes >> np.uint64(32)) * self.blocks[shard].astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def lane_bits(hashes: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((hashes >> np.uint64(5 * lane)) & np.uint64(31)).astype(np.uint32)


def filter_pieces(vocabulary: DataFrame, shards: Shards) -> DataFrame:
    """(slice, piece, bits): the filters, cut into pieces of PIECE_BLOCKS blocks."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0))
            hashes = words.hashes()
            part, block = shards.slot(hashes, words.length)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(block // PIECE_BLOCKS), pa.array(block % PIECE_BLOCKS),
                                              pa.array(hashes.view(np.int64))], names=["slice", "piece", "block", "hash"])

    size = np.zeros(int(shards.slices.sum()), np.int64)
    for shard in range(LONG + 1):
        size[shards.base[shard] : shards.base[shard] + shards.slices[shard]] = shards.blocks[shard]

    def fill(table: pa.Table) -> pa.Table:
        part, piece = table["slice"][0].as_py(), table["piece"][0].as_py()
        bits = np.zeros((min(PIECE_BLOCKS, int(size[part]) - piece * PIECE_BLOCKS), LANES), np.uint32)
        block, hashes = table["block"].to_numpy(), mix(table["hash"].to_numpy().view(np.uint64), 64)
        for lane in range(LANES):
            np.bitwise_or.at(bits[:, lane], block, lane_bits(hashes, lane))
        return pa.table({"slice": [part], "piece": [piece], "bits": [bits.tobytes()]})

    placed = vocabulary.select("word").mapInArrow(spread, "slice long, piece long, block long, hash long")
    return placed.groupBy("slice", "piece").applyInArrow(fill, "slice long, piece long, bits binary")


def _held(filters: np.ndarray, base: np.ndarray, shards: Shards, hashes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of the hashes that a filter of this pass holds."""
    part, block = shards.slot(hashes, length)
    row = base[part] + block
    at = np.flatnonzero(base[part] >= 0)
    bits = mix(hashes, 64)
    for lane in range(LANES):
        if not len(at):
            break
        at = at[(filters[row[at], lane] & lane_bits(bits[at], lane)) != 0]
    return at


def probed(vocabulary: DataFrame, shards: Shards, held, base: np.ndarray, alphabet: np.ndarray) -> DataFrame:
    """(candidate, word, n): the edits of each word that the broadcast filters hold."""
    codes = CODES[alphabet]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = np.frombuffer(held.value, np.uint32).reshape(-1, LANES)
        for whole in batches:
            for first in range(0, whole.num_rows, 4096):
                batch = whole.slice(first, 4096)
                words = Words(batch.column(0))
                strings, owner = batch.column(0), np.repeat(np.arange(batch.num_rows), words.length)
                length = words.length[owner]
                found_word, found_place, found_letter = [], [], []
                step = max(1, PROBES // (len(alphabet) + 1))
                for a in range(0, len(owner), step):  # a long word has many places
                    at = np.arange(a, min(a + step, len(owner)))
                    again = (words.place[at] > 0) & (words.points[at] == words.points[at - 1])  # deletes to the same string
                    cut = at[(length[at] > MIN_CHARS) & ~again]
                    rest = words.total[owner[cut]] - words.prefix[cut] - words.term[cut]
                    hashes = finished(words.prefix[cut] + rest * UNBASE, length[cut] - 1)
                    good = cut[_held(filters, base, shards, hashes, length[cut] - 1)]
                    found_word.append(owner[good])
                    found_place.append(words.place[good])
                    found_letter.append(np.zeros(len(good), np.int64))
                    later = alphabet[None, :] > words.points[at][:, None]
                    which, letter = np.nonzero(later)
                    which = at[which]
                    sums = words.total[owner[which]] - words.term[which] + codes[letter] * words.power[which]
                    good = _held(filters, base, shards, finished(sums, length[which]), length[which])
                    found_word.append(owner[which[good]])
                    found_place.append(words.place[which[good]])
                    found_letter.append(alphabet[letter[good]].astype(np.int64))
                word, place, letter = map(np.concatenate, (found_word, found_place, found_letter))
                texts, counts = strings.to_pylist(), batch.column(1)
                made, size, begun = [], 0, 0
                for k, (w, p, c) in enumerate(zip(word.tolist(), place.tolist(), letter.tolist()), 1):
                    text = texts[w]
                    made.append(text[:p] + (chr(c) if c else "") + text[p + 1 :])
                    size += 2 * len(text)
                    if size > 8 << 20 or k == len(word):
                        mine = pa.array(word[begun:k])
                        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()), strings.take(mine), counts.take(mine)],
                                                         names=["candidate", "word", "n"])
                        made, size, begun = [], 0, k

    return vocabulary.select("word", "n").mapInArrow(run, "candidate string, word string, n long")


def _alphabet(vocabulary: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, bool)
        for batch in batches:
            seen[Words(batch.column(0)).points] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], names=["letter"])

    return np.array(sorted(r[0] for r in vocabulary.select("word").mapInArrow(run, "letter long").distinct().collect()), np.int64)


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words of ``vocabulary`` (word, n; a stored table) one edit apart, once."""
    sc = vocabulary.sparkSession.sparkContext
    counts = {r[0]: r[1] for r in vocabulary.groupBy(F.least(F.length("word"), F.lit(LONG))).count().collect()}
    shards, alphabet, out = Shards(counts, filter_bytes), _alphabet(vocabulary), None
    pieces = stored(filter_pieces(vocabulary, shards), "spelling-filters")
    for wanted in shards.passes:
        base, room = np.full(int(shards.slices.sum()), -1, np.int64), 0
        for shard, part in wanted:
            base[shards.base[shard] + part] = room
            room += int(shards.blocks[shard])
        bits = np.zeros((room, LANES), np.uint32)
        mine = [int(shards.base[shard] + part) for shard, part in wanted]
        for r in pieces.where(F.col("slice").isin(mine)).collect():  # no more than filter_bytes
            begin = int(base[r["slice"]]) + r["piece"] * PIECE_BLOCKS
            got = np.frombuffer(r["bits"], np.uint32).reshape(-1, LANES)
            bits[begin : begin + len(got)] = got
        part = probed(vocabulary, shards, sc.broadcast(bits.tobytes()), base, alphabet)
        out = part if out is None else out.unionByName(part)
    known = vocabulary.select(F.col("word").alias("candidate"), F.col("n").alias("b_n"))
    return out.join(known, "candidate").select(F.col("word").alias("a"), F.col("n").alias("a_n"),
                                               F.col("candidate").alias("b"), "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of ``forms`` (word, form) by following forms to their end."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = reached.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = stored(reached.join(ahead, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        reached = moved.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per vocabulary word: word, form, root, n, n_near, form_n."""
    vocabulary = stored(counted_words(docs, id_col, text), "vocabulary")
    pairs = near_pairs(vocabulary, filter_bytes)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = vocabulary.join(best, "word", "left")
    is_form = -F.col("best.less") >= 2 * F.col("n")
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(is_form, F.col("best.near")).alias("form"),
                                F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
