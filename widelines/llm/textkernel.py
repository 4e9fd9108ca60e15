"""Vectorised word splitting and hashing over Arrow string columns, for use inside tasks.

A column's texts are worked on in chunks of a few megabytes, cut between
documents; one long text is a chunk of its own. Nothing is cut short.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 2 << 20


def _byte_set(excluded: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in excluded:
        table[low : high + 1] = False
    return table


#: Words are what lies between space and the controls 9 to 13.
WHITESPACE_WORDS = _byte_set([(0x20, 0x20), (0x09, 0x0D)])
#: Words of digits, ASCII lower-case letters and everything outside ASCII (after lower-casing A-Z).
ALNUM_WORDS = _byte_set([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.random.default_rng(20240229)
BYTE_CODES = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; each seed gives another function."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty, ascending, disjoint span data[start:end]."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    terms = BYTE_CODES[data[within + np.repeat(starts, lengths)]] * powers[within]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Chunk:
    """Some texts of a batch: rows [first, last), their bytes and the bounds of each text in them."""

    def __init__(self, first: int, last: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.last, self.data, self.bounds = first, last, data, bounds

    def __len__(self) -> int:
        return self.last - self.first

    def words(self, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and for each text the index of its first word (one more at the end)."""
        return self.spans(word_bytes[self.data])

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As words(), of the bytes that a mask marks."""
        if not len(inside):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self) + 1, np.int64)
        cut = np.zeros(len(inside) + 1, bool)
        cut[self.bounds] = True
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each newline-split line, and for each text the index of its first line (one more at the end)."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.bounds[:-1], breaks + 1])
        ends = np.concatenate([breaks, self.bounds[1:]])
        owner = np.searchsorted(self.bounds[1:], breaks, "right")
        texts = np.arange(len(self))
        by_start = np.lexsort((starts, np.concatenate([texts, owner])))
        by_end = np.lexsort((ends, np.concatenate([owner, texts])))
        counts = np.bincount(owner, minlength=len(self)) + 1
        return starts[by_start], ends[by_end], np.concatenate([[0], np.cumsum(counts)])


def chunks(column: pa.Array | pa.ChunkedArray, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's texts in chunks; null is taken as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = data[bounds[first] : bounds[last]]
        yield Chunk(first, last, LOWER[part] if lower else part, bounds[first : last + 1] - bounds[first])
        first = last
