"""Elias-Fano n-gram trie: compact levels in memory-mapped scratch files.

Every level is searched in its coded form: select on the unary high bits finds
the run of values that share the sought one's high bits, and a binary search over
the packed low bits of that run finds the successor.
"""

from __future__ import annotations

import mmap
import os
import tempfile

import numpy as np

from .textcore import U64


#: Searches at once.
BLOCK = 1 << 14


def _mapped(values: np.ndarray) -> np.ndarray:
    """``values`` in a memory-mapped file.

    The file is scratch of the task in Spark's own local folder, like a spill
    file: it has no name, nobody else reads it, and it goes with the array.
    """
    if not len(values):
        return values
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    with tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None) as f:
        f.write(np.ascontiguousarray(values).data)
        f.flush()
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), values.dtype)


_EACH = U64(0x0101010101010101)
_TOP = U64(0x8080808080808080)
#: Place of the nth set bit of each byte.
_IN_BYTE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _own = [k for k in range(8) if _byte >> k & 1]
    _IN_BYTE[_byte, : len(_own)] = _own


def _nth_bit(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth set bit (from 0) of each word: its byte by running sums
    of the bytes' counts, then its place in the byte from a table."""
    nth = nth.astype(U64)
    counts = words - ((words >> U64(1)) & U64(0x5555555555555555))
    counts = (counts & U64(0x3333333333333333)) + ((counts >> U64(2)) & U64(0x3333333333333333))
    counts = ((counts + (counts >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _EACH
    # bytes whose running sum does not exceed nth lie before it
    before = np.bitwise_count((((nth * _EACH) | _TOP) - counts) & _TOP).astype(U64) << U64(3)
    left = nth - (((counts << U64(8)) >> before) & U64(255))
    return (before + _IN_BYTE[((words >> before) & U64(255)).astype(np.int64), left.astype(np.int64)]).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray):
        values = values.astype(U64, copy=False)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.low_bits = max(0, ((top + 1) // max(self.n, 1)).bit_length() - 1)
        self.last = top >> self.low_bits
        place = (values >> U64(self.low_bits)).astype(np.int64) + np.arange(self.n)
        # a zero ends the last run, too
        bits = np.zeros((self.last + self.n + 2 + 63) // 64 * 64, np.uint8)
        bits[place] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.high = _mapped(words)
        self.ones, self.zeros = _mapped(ones), _mapped(64 * np.arange(len(ones)) - ones)
        self.low = _mapped(self._packed(values & U64((1 << self.low_bits) - 1)))

    def _packed(self, low: np.ndarray) -> np.ndarray:
        at = np.arange(self.n, dtype=np.int64) * self.low_bits
        out = np.zeros((self.n * self.low_bits >> 6) + 2, U64)
        if self.n and self.low_bits:
            word, shift = at >> 6, (at & 63).astype(U64)
            new = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[new]] = np.bitwise_or.reduceat(low << shift, new)
            over = np.flatnonzero((at & 63) + self.low_bits > 64)
            out[word[over] + 1] |= low[over] >> (U64(64) - shift[over])
        return out

    def _select(self, nth: np.ndarray, ones: bool) -> np.ndarray:
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, nth, side="right") - 1
        bits = self.high[word]
        return 64 * word + _nth_bit(bits if ones else ~bits, nth - before[word])

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), U64)
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(U64)
        part = self.low[word] >> shift
        over = (bit & 63) + self.low_bits > 64
        part = np.where(over, part | (self.low[word + 1] << ((U64(64) - shift) & U64(63))), part)
        return part & U64((1 << self.low_bits) - 1)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at these places."""
        index = np.asarray(index, np.int64)
        return ((self._select(index, True) - index).astype(U64) << U64(self.low_bits)) | self._low(index)

    def find(self, sought: np.ndarray, floor: np.ndarray | int = 0) -> np.ndarray:
        """Place of the least value from ``floor`` on that is not below the
        sought one, if it equals it; else -1."""
        out = np.full(len(sought), -1)
        run = (sought >> U64(self.low_bits)).astype(np.int64)
        ok = np.flatnonzero((sought >> U64(self.low_bits) <= U64(self.last)) & (self.n > 0))
        run, low = run[ok], sought[ok] & U64((1 << self.low_bits) - 1)
        end = self._select(run, False) - run
        begin = np.where(run > 0, self._select(np.maximum(run - 1, 0), False) - run + 1, 0)
        begin = np.maximum(begin, np.broadcast_to(floor, out.shape)[ok])
        left, right = begin, end
        open_ = np.flatnonzero(left < right)
        left, right = left.copy(), right.copy()
        while len(open_):
            middle = (left[open_] + right[open_]) >> 1
            less = self._low(middle) < low[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
            open_ = open_[left[open_] < right[open_]]
        there = np.flatnonzero(left < end)
        there = there[self._low(left[there]) == low[there]]
        out[ok[there]] = left[there]
        return out

    def __len__(self) -> int:
        return self.n


class Codes:
    """Logarithms of probabilities (at most 0), quantised to 16 bits."""

    SCALE = 4000.0

    def __init__(self, log_values: np.ndarray):
        self.codes = _mapped(np.clip(np.rint(-log_values * self.SCALE), 0, 65535).astype("<u2"))

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        return self.codes[index] / -self.SCALE


class Level:
    """Successors of the entries of the level above, and a value of each.

    A successor is stored as its rank plus the last value stored for the
    contexts before, so the sequence never falls; pointers bound each context.
    """

    def __init__(self, parents: int, parent: np.ndarray, word: np.ndarray, log_p: np.ndarray, log_backoff: np.ndarray | None):
        """Sorted by (parent, word), without repeats."""
        first = np.searchsorted(parent, np.arange(parents + 1))
        self.pointers = EliasFano(first)
        own = np.flatnonzero(np.diff(first))
        last = np.zeros(parents + 1, np.int64)
        last[own + 1] = word[first[own + 1] - 1]
        base = np.cumsum(last)
        self.successors = EliasFano(word + base[parent])
        self.log_p = Codes(log_p)
        self.log_backoff = Codes(log_backoff) if log_backoff is not None else None

    def child(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each (parent, word), or -1; a parent or word of -1 has none.

        Searched in blocks that fit a cache; parents in order make it fastest.
        """
        cut = range(0, len(parent), BLOCK)
        parts = [self._children(parent[i : i + BLOCK], word[i : i + BLOCK]) for i in cut]
        return np.concatenate([np.zeros(0, np.int64), *parts])

    def _children(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(parent), -1)
        ok = np.flatnonzero((parent >= 0) & (word >= 0))
        if not len(self.successors) or not len(ok):
            return out
        # every context is looked up once
        contexts, at = np.unique(parent[ok], return_inverse=True)
        low, high = (self.pointers.at(contexts + k).astype(np.int64) for k in (0, 1))
        base = np.where(low > 0, self.successors.at(np.maximum(low - 1, 0)), U64(0))
        some = (low < high)[at]
        ok, at = ok[some], at[some]
        low, high, base = low[at], high[at], base[at]
        found = self.successors.find(base + word[ok].astype(U64), low)
        inside = (found >= 0) & (found < high)
        out[ok[inside]] = found[inside]
        return out


class Trie:
    """Words, bigrams and trigrams; p of each and the back-off of contexts."""

    def __init__(self, names: np.ndarray, log_p: np.ndarray, log_backoff: np.ndarray):
        """Names: sorted 64-bit hashes of the words."""
        self.words = EliasFano(names)
        self.log_p, self.log_backoff = Codes(log_p), Codes(log_backoff)
        self.levels: list[Level] = []

    def add_level(self, parent: np.ndarray, word: np.ndarray, log_p: np.ndarray, log_backoff: np.ndarray | None = None) -> None:
        above = len(self.levels[-1].successors) if self.levels else len(self.words)
        self.levels.append(Level(above, parent, word, log_p, log_backoff))
