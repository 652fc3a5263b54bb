"""Hashes of words and word runs over whole Arrow blocks, in numpy.

Words are the matches of ``[^\\x20\\x09-\\x0D]+`` in the UTF-8 bytes.  A word's
hash sums its bytes times position-dependent 64-bit multipliers, mixed at the
end; it depends on the word alone, so every task computes the same value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Byte classes: 0 ends a word, and a word does not run from one class into another.
WORD = np.ones(256, dtype=np.uint8)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
#: The same with ASCII signs as words of their own.
WORD_OR_SIGN = WORD.copy()
WORD_OR_SIGN[[i for i in range(0x21, 0x7F) if not chr(i).isalnum()]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
#: Words hashed at once.
PART_WORDS = 50_000


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a bijection of 64-bit values)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _multipliers(n: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64)) * U(0x9E3779B97F4A7C15)) | U(1)


class Words:
    """The words of a block of texts: byte ranges, owning row, hashes."""

    def __init__(self, column: pa.Array, lower: bool = False, classes: np.ndarray = WORD):
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
        data = column.buffers()[2]
        raw = (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8))[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        self.buf = LOWER[raw] if lower else raw
        kind = classes[self.buf]
        solid = kind > 0
        first = solid.copy()
        first[1:] &= kind[1:] != kind[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(raw)]
        first[cuts] = solid[cuts]  # no word runs from one text into the next
        self.starts = np.flatnonzero(first)
        last = solid.copy()
        last[:-1] &= kind[1:] != kind[:-1]
        ends = cuts[cuts > 0] - 1
        last[ends] = solid[ends]
        self.ends = np.flatnonzero(last) + 1
        #: words of row i are bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, offsets)
        self._solid = solid

    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.empty(0, np.uint64)
        begin = np.zeros(len(lengths), np.int64)
        np.cumsum(lengths[:-1], out=begin[1:])
        factor, solid = _multipliers(int(lengths.max())), self.buf[self._solid]
        total = np.empty(len(lengths), np.uint64)
        for lo in range(0, len(lengths), PART_WORDS):  # a byte takes many times its size on the way
            n, at = lengths[lo:lo + PART_WORDS], begin[lo:lo + PART_WORDS]
            at, first = at - at[0], at[0]
            size = int(at[-1] + n[-1])
            place = np.arange(size) - np.repeat(at, n)
            terms = (solid[first:first + size].astype(np.uint64) + U(1)) * factor[place]
            total[lo:lo + PART_WORDS] = np.add.reduceat(terms, at)
        return mix(total + lengths.astype(np.uint64))


def runs(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``width`` neighbouring words (rows are the caller's concern)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = _multipliers(width + seed)[seed:]
    total = np.full(n, U(width))
    for j in range(width):
        total += hashes[j:n + j] * factor[j]
    return mix(total)
