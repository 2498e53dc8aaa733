"""Directly addressable codes for token ids.

An id is cut into chunks of eight bits, lowest first.  Level k holds chunk k
of every id that has one, in order, as a byte array; a continuation bitmap
beside it says which ids go on to level k + 1, and a rank directory (ones
before every 512th bit) turns a position on one level into the position on the
next.  Reading token i touches one byte and one bit a level; nothing is
decoded before it.

Layout, little-endian: ``b"DAC1"``, number of ids (u64), number of levels
(u32), then for each level the number of chunks (u64), the chunks padded to a
multiple of eight bytes, and for all levels but the last the bitmap as u64
words and the directory as u64 counts.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
_BLOCK_WORDS = 8  # 512 bits for each entry of the directory


def encode(ids: np.ndarray) -> bytes:
    ids = np.ascontiguousarray(ids, np.uint32)
    levels = max(1, -(-int(ids.max()).bit_length() // 8)) if len(ids) else 1
    out = [MAGIC, struct.pack("<QI", len(ids), levels)]
    rest = ids
    for level in range(levels):
        chunk = (rest & 0xFF).astype(np.uint8).tobytes()
        out += [struct.pack("<Q", len(rest)), chunk, b"\0" * (-len(chunk) % 8)]
        rest = rest >> 8
        if level < levels - 1:
            more = rest > 0
            words = np.zeros(len(more) // 64 + 1, np.uint64)
            packed = np.packbits(more, bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.cumsum(np.bitwise_count(words).astype(np.uint64))
            directory = np.concatenate(([np.uint64(0)], counts[_BLOCK_WORDS - 1:: _BLOCK_WORDS])).astype("<u8")
            out += [words.astype("<u8").tobytes(), struct.pack("<Q", len(directory)), directory.tobytes()]
            rest = rest[more]
    return b"".join(out)


class Reader:
    """Random access to an encoded sequence without decoding it."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 payload")
        self.n, count = struct.unpack_from("<QI", payload, 4)
        at, self.levels = 16, []
        for level in range(count):
            size, = struct.unpack_from("<Q", payload, at)
            chunks = np.frombuffer(payload, np.uint8, size, at + 8)
            at += 8 + size + (-size % 8)
            words = directory = None
            if level < count - 1:
                words = np.frombuffer(payload, "<u8", size // 64 + 1, at)
                at += 8 * len(words)
                entries, = struct.unpack_from("<Q", payload, at)
                directory = np.frombuffer(payload, "<u8", entries, at + 8)
                at += 8 + 8 * entries
            self.levels.append((chunks, words, directory))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """The i-th id."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, words, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if words is None:
                break
            word, bit = divmod(i, 64)
            if not int(words[word]) >> bit & 1:
                break
            block = word // _BLOCK_WORDS
            before = int(np.bitwise_count(words[block * _BLOCK_WORDS: word]).sum())
            i = int(directory[block]) + before + (int(words[word]) & ((1 << bit) - 1)).bit_count()
        return value

    def decode(self) -> np.ndarray:
        """All ids, level by level."""
        out = np.zeros(self.n, np.uint32)
        at = None
        for level, (chunks, words, _) in enumerate(self.levels):
            part = chunks.astype(np.uint32) << np.uint32(8 * level)
            if at is None:
                out |= part
            else:
                out[at] |= part
            if words is None:
                break
            more = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little", count=len(chunks)).astype(bool)
            at = np.flatnonzero(more) if at is None else at[more]
        return out
