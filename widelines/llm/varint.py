"""Variable-length integers in NumPy: seven bits a byte, low bits first, the top bit set on all bytes but the last."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all (non-negative) values in a row, and the bytes that each takes."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 10):
        more = values >= np.uint64(1 << (7 * k))
        if not more.any():
            break
        size += more
    out = np.zeros(int(size.sum()), np.uint8)
    first = np.cumsum(size) - size
    for k in range(int(size.max(initial=0))):
        has = size > k
        part = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[first[has] + k] = part.astype(np.uint8) | ((size[has] > k + 1).astype(np.uint8) << 7)
    return out, size


def decode(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], last[:-1] + 1])
    within = np.arange(len(data)) - np.repeat(first, last + 1 - first)
    parts = (data & np.uint8(127)).astype(np.uint64) << (np.uint64(7) * within.astype(np.uint64))
    return np.add.reduceat(parts, first).astype(np.int64)
