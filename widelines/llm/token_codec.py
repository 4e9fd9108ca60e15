"""Blocks of token ids, compressed by an adaptive context-mixing range coder.

A block is cut into lanes of equal length that are coded in step: at each step every lane codes its next id with a
range coder of its own, under one model that all lanes of the block share and that learns after each step. Encoder
and decoder do the same whole-array arithmetic, so they stay in agreement.

Model. The two ids before predict one id by a hashed order-2 table, the id before by an order-1 table, each with a
confidence. A table indexed by both confidences mixes them: it learns how often order 2 is right, order 1 is right,
or neither. What neither predicts is coded by order-0 frequencies. Everything is reset at each block.

Block layout, little-endian: magic "CMRB", u32 ids, u32 lanes, u32 vocabulary, u32 crc32 of the ids as u32; u32 words
of each lane; then the lanes' 16-bit words one lane after another.
"""

from __future__ import annotations

import struct
import sys
import zlib

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"CMRB"
HEAD = "<4sIIII"
STEPS = 128
MAX_LANES = 60_000
TABLE_BITS = 18
FLAG_BITS, ZERO_BITS = 12, 18
LEVELS = 8
REFRESH = 4
#: Keeps the steps of a lane from lying a power of two apart, in the same few lines of the processor's cache.
PAD = 16
U = np.uint64
TOP, BOTTOM = U(1 << 48), U(1 << 32)


class Model:
    """The shared model of a block. Ids are int32, indices int64: mixed widths would be converted at each operation."""

    def __init__(self, vocabulary: int):
        self.vocabulary = vocabulary
        # an entry is LEVELS * the id predicted + the confidence
        self.order1, self.order2 = np.zeros(vocabulary, np.int32), np.zeros(1 << TABLE_BITS, np.int32)
        self.outcomes = np.ones((LEVELS * LEVELS, 3), np.int64)
        self.seen, self.new = np.zeros(vocabulary, np.int64), []
        self.steps = 0
        self._weigh()
        self._refresh()

    def _weigh(self) -> None:
        """Shares of (neither, order 1, order 2) for each pair of confidences; none where there is no prediction."""
        counts = self.outcomes.copy()
        counts[::LEVELS, 1] = 0
        counts[:LEVELS, 2] = 0
        free = (1 << FLAG_BITS) - 3
        share = counts * free // counts.sum(axis=1, keepdims=True) + (counts > 0)
        share[:, 0] += (1 << FLAG_BITS) - share.sum(axis=1)
        start = np.cumsum(share, axis=1) - share
        self.share, self.start = share.astype(U).ravel(), start.astype(U).ravel()
        self.start1, self.start2 = self.start[1::3].copy(), self.start[2::3].copy()

    def _refresh(self) -> None:
        if self.new:
            self.seen += np.bincount(np.concatenate(self.new), minlength=self.vocabulary)
            self.new = []
        free = (1 << ZERO_BITS) - self.vocabulary
        share = 1 + self.seen * free // max(int(self.seen.sum()), 1)
        upper = np.cumsum(share)
        self.width, self.lower = share.astype(U), (upper - share).astype(U)
        self.by_value = None

    def found(self, value: np.ndarray) -> np.ndarray:
        """The ids in whose share of the order-0 frequencies the values lie."""
        if self.by_value is None:
            self.by_value = np.full(1 << ZERO_BITS, self.vocabulary - 1, np.int32)
            ids = np.repeat(np.arange(self.vocabulary, dtype=np.int32), self.width.astype(np.int64))
            self.by_value[: len(ids)] = ids
        return self.by_value.take(value)

    def predict(self, before1: np.ndarray, before2: np.ndarray):
        """(places in the order-2 table, entries of orders 1 and 2, ids they predict, index of the mixing table)."""
        place = ((before2 * 40_503 + before1 * 2_654_435_761) >> 7) & ((1 << TABLE_BITS) - 1)
        entry1, entry2 = self.order1.take(before1), self.order2.take(place)
        guess1, guess2 = entry1 >> 3, entry2 >> 3
        sure1, sure2 = entry1 & (LEVELS - 1), entry2 & (LEVELS - 1)
        sure1 *= (guess1 != guess2) | (sure2 == 0)
        return place, (entry1, entry2), guess1, guess2, sure2 * LEVELS + sure1

    def outcome(self, ids, guess1, guess2, mixed) -> np.ndarray:
        """2 or 1 for the order that predicted the id, 0 for neither."""
        second = (mixed >= LEVELS) & (ids == guess2)
        first = (mixed & (LEVELS - 1) > 0) & (ids == guess1) & ~second
        return second.view(np.int8) * np.int8(2) + first.view(np.int8)

    def learn(self, ids, before1, place, entries, case, rest) -> None:
        """``case``: 3 * the mixing table's index + the outcome; ``rest``: ids that neither order predicted."""
        fresh = ids * np.int32(LEVELS)
        for index, entry, table in ((before1, entries[0], self.order1), (place, entries[1], self.order2)):
            other = entry ^ fresh  # the confidence, if the entry predicts the id; 0 if nothing is known yet
            sure = entry & (LEVELS - 1)
            right = (other < LEVELS) & (sure > 0)
            made = np.where(sure <= 1, fresh + np.int32(1), entry - sure + (sure >> 1))
            table[index] = np.where(right, entry + (sure < LEVELS - 1), made)
        self.outcomes += np.bincount(case, minlength=3 * LEVELS * LEVELS).reshape(-1, 3)
        self._weigh()
        self.new.append(rest)
        self.steps += 1
        if self.steps % REFRESH == 0 or self.steps < 2 * REFRESH:
            self._refresh()


def _lanes(n: int) -> tuple[int, int]:
    steps = max(STEPS, -(-n // MAX_LANES))
    return -(-n // steps), steps


def _due(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Lanes whose next word is settled, or whose span is too short to be divided further."""
    return ((low ^ (low + span)) < TOP) | (span < BOTTOM)


def _cut(low: np.ndarray, span: np.ndarray) -> None:
    """Shorten in place the spans of due lanes whose next word is not settled, so that it is; these are few."""
    short = np.flatnonzero(span < BOTTOM)
    if len(short):
        l, s = low[short], span[short]
        span[short] = np.where((l ^ (l + s)) < TOP, s, (U(0) - l) & (BOTTOM - U(1)))


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """``ids``: non-negative integers below ``vocabulary`` (at most 2**17)."""
    n = len(ids)
    lanes, steps = _lanes(n)
    head = struct.pack(HEAD, MAGIC, n, lanes, vocabulary, zlib.crc32(ids.astype("<u4").tobytes()))
    if not n:
        return head
    table = np.zeros((steps, lanes), np.int32)
    flat = np.zeros(steps * lanes, np.int32)
    flat[:n] = ids
    table[:] = flat.reshape(lanes, steps).T
    model = Model(vocabulary)
    low, span = np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    before1, before2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    out_lane, out_word = [], []
    last = n - (lanes - 1) * steps
    for step in range(steps):
        k = lanes if step < last else lanes - 1
        if not k:
            break
        now, b1, b2 = table[step, :k], before1[:k], before2[:k]
        place, entries, guess1, guess2, mixed = model.predict(b1, b2)
        outcome = model.outcome(now, guess1, guess2, mixed)
        case = mixed * np.int64(3) + outcome
        part = span[:k] >> U(FLAG_BITS)
        low[:k] += part * model.start.take(case)
        span[:k] = part * model.share.take(case)
        rest = np.flatnonzero(outcome == 0)
        rare = now.take(rest)
        part = span.take(rest) >> U(ZERO_BITS)
        low[rest] += part * model.lower.take(rare)
        span[rest] = part * model.width.take(rare)
        todo = np.flatnonzero(_due(low[:k], span[:k]))
        while len(todo):
            l, s = low.take(todo), span.take(todo)
            _cut(l, s)
            out_lane.append(todo.astype(np.uint16))
            out_word.append((l >> U(48)).astype(np.uint16))
            l, s = l << U(16), s << U(16)
            low[todo], span[todo] = l, s
            todo = todo[_due(l, s)]
        model.learn(now, b1, place, entries, case, rare)
        before2[:k], before1[:k] = b1, now
    for _ in range(4):
        out_lane.append(np.arange(lanes, dtype=np.uint16))
        out_word.append((low >> U(48)).astype(np.uint16))
        low = low << U(16)
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane, kind="stable")
    counts = np.bincount(lane, minlength=lanes).astype("<u4")
    return head + counts.tobytes() + word[order].astype("<u2").tobytes()


def decode_block(data: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError if it is damaged."""
    magic, n, lanes, vocabulary, check = struct.unpack_from(HEAD, data)
    if magic != MAGIC or lanes != _lanes(n)[0]:
        raise ValueError("not a block of token ids")
    steps = _lanes(n)[1]
    if not n:
        return np.zeros(0, np.int32)
    counts = np.frombuffer(data, "<u4", lanes, struct.calcsize(HEAD)).astype(np.int64)
    words = np.frombuffer(data, "<u2", -1, struct.calcsize(HEAD) + 4 * lanes)
    if len(words) != counts.sum() or len(words) < 4 * lanes:
        raise ValueError("a block of token ids is cut short")
    at = np.cumsum(counts) - counts
    code = np.zeros(lanes, U)
    for _ in range(4):
        code = (code << U(16)) | words.take(at, mode="clip")
        at = at + 1
    model = Model(vocabulary)
    low, span = np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    before1, before2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    table = np.zeros((steps, lanes + PAD), np.int32)
    last = n - (lanes - 1) * steps
    for step in range(steps):
        k = lanes if step < last else lanes - 1
        if not k:
            break
        b1, b2 = before1[:k], before2[:k]
        place, entries, guess1, guess2, mixed = model.predict(b1, b2)
        part = span[:k] >> U(FLAG_BITS)
        value = np.minimum(code[:k] - low[:k], (part << U(FLAG_BITS)) - U(1))
        second = value >= part * model.start2.take(mixed)
        known = value >= part * model.start1.take(mixed)
        case = mixed * np.int64(3) + known + second
        low[:k] += part * model.start.take(case)
        span[:k] = part * model.share.take(case)
        now = np.where(second, guess2, guess1)
        rest = np.flatnonzero(~known)
        part = span.take(rest) >> U(ZERO_BITS)
        value = np.minimum((code.take(rest) - low.take(rest)) // part, U((1 << ZERO_BITS) - 1)).astype(np.int64)
        rare = model.found(value)
        low[rest] += part * model.lower.take(rare)
        span[rest] = part * model.width.take(rare)
        now[rest] = rare
        todo = np.flatnonzero(_due(low[:k], span[:k]))
        while len(todo):
            l, s = low.take(todo), span.take(todo)
            _cut(l, s)
            next_word = at.take(todo)
            code[todo] = (code.take(todo) << U(16)) | words.take(next_word, mode="clip")
            at[todo] = next_word + 1
            l, s = l << U(16), s << U(16)
            low[todo], span[todo] = l, s
            todo = todo[_due(l, s)]
        table[step, :k] = now
        model.learn(now, b1, place, entries, case, rare)
        before2[:k], before1[:k] = b1, now
    ids = table[:, :lanes].T.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != check:
        raise ValueError("a block of token ids fails its checksum")
    return ids
