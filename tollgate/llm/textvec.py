"""Vectorised word hashing over the bytes of an Arrow string column.

A batch of texts is one byte array with document offsets.  Words are maximal
runs of bytes of a class (valid for UTF-8 as long as the class treats all
non-ASCII bytes alike).  A word's 64-bit hash is a polynomial over random
byte values, read off prefix sums, then mixed; equal words have equal hashes,
different words collide with probability about 2**-64.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa

_SEGMENT = 1 << 18
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))
_RNG = np.random.default_rng(20240229)
_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd multipliers that tell the positions of a window apart.
POSITION = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_class(separators: bytes) -> np.ndarray:
    """Word bytes: all but the given ones."""
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


#: Words of runs of non-white-space.
NON_SPACE = byte_class(b" \t\n\x0b\x0c\r")
#: Words of ASCII digits and letters and of all non-ASCII bytes.
ALNUM = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_FOLD = np.arange(256)
_FOLD[65:91] += 32
FOLDED_VALUES = _VALUES[_FOLD]


def _trimmer():
    """glibc's way to give freed heap pages back; nothing on other systems."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


_TRIM = _trimmer()


#: What a worker keeps between its tasks of one operator, and other operators let go.
KEPT: list[dict] = []


def start_over() -> None:
    """At the start of a task that needs nothing of what the worker keeps: a
    worker lives on from query to query."""
    for kept in KEPT:
        kept.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """At the end of a task: freed memory goes back to the system, as the
    worker lives on beside others."""
    pa.default_memory_pool().release_unused()
    _TRIM(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words, and for each document
    the index of its first word (one more entry than documents)."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    w = cls[data]
    edge = np.empty(len(w), bool)
    edge[0] = w[0]
    np.greater(w[1:], w[:-1], out=edge[1:])
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    edge[cut] = w[cut]
    starts = np.flatnonzero(edge)
    edge[-1] = w[-1]
    np.greater(w[:-1], w[1:], out=edge[:-1])
    edge[cut - 1] = w[cut - 1]
    ends = np.flatnonzero(edge) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


_POWERS = [_powers(2 * _SEGMENT, _MULT), _powers(2 * _SEGMENT, _INVERSE)]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """A 64-bit hash for each word, worked out in pieces that fit the cache."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + _SEGMENT, "right")))
        n = int(ends[j - 1] - a)
        power, inverse = (p[:n] for p in _POWERS) if n <= len(_POWERS[0]) else (_powers(n, _MULT), _powers(n, _INVERSE))
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[a: a + n]] * power, out=sums[1:])
        s = starts[i:j] - a
        out[i:j] = (sums[ends[i:j] - a] - sums[s]) * inverse[s]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words (also across documents; the
    caller leaves out those that cross)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n] * POSITION[0]
    for k in range(1, size):
        h += words[k: k + n] * POSITION[k]
    return mix(h)


def ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(first[i], first[i] + length[i])``."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    at = np.cumsum(length) - length
    return np.repeat(first - at, length) + np.arange(total)
