"""Byte-level text kernels shared by the corpus operators.

All kernels work on the UTF-8 bytes of whole texts.  A block is a run of
documents whose bytes fit ``BLOCK_BYTES`` (a longer document is a block of its
own), so memory is bounded by the block or by the longest single document.
Hashes are 64-bit polynomial (Rabin-Karp) hashes taken from prefix sums modulo
2**64: the odd base has an inverse, so any slice is one subtraction and one
product.  A final avalanche step spreads the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
WORD_BASE = 0x9E3779B97F4A7C15
ROLL_BASE = 0xD6E8FEB86659FD93
#: Bases of a second hash, independent of the first; both together make 128 bits.
WORD_BASE_2 = 0xA24BAED4963EE407
ROLL_BASE_2 = 0x9FB21C651E98DF25
U64 = np.uint64
MASK64 = (1 << 64) - 1


def _lut(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: ``[^\x20\x09-\x0D]+``: every byte but the six ASCII blanks.
PLAIN_WORD = ~_lut([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM_WORD = _lut([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit integers (the public splitmix64 finaliser)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(WORD_BASE)) | U64(1)
BYTE_CODE_2 = mix(np.arange(1, 257, dtype=U64) * U64(WORD_BASE_2)) | U64(1)


class Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, dtype=U64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


FIRST = Powers(WORD_BASE), Powers(ROLL_BASE), BYTE_CODE, U64(ROLL_BASE)
SECOND = Powers(WORD_BASE_2), Powers(ROLL_BASE_2), BYTE_CODE_2, U64(ROLL_BASE_2)


@dataclass
class Block:
    """Documents ``first_row .. first_row + n`` of a column, as bytes."""

    first_row: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, n + 1

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column; a null text counts as empty."""
    for part, start in _parts(column):
        data, offsets = _buffers(part)
        n, i = len(offsets) - 1, 0
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
            j = min(n, max(i + 1, j))
            own = offsets[i : j + 1]
            yield Block(start + i, data[own[0] : own[-1]], own - own[0])
            i = j


def _parts(column):
    start = 0
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        yield part, start
        start += len(part)


@dataclass
class Words:
    """Words of a block: byte spans and, for each document, its first word."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # n + 1 word indexes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(block: Block, is_word: np.ndarray = PLAIN_WORD) -> Words:
    data, offs = block.data, block.offsets
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offs), np.int64))
    w = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    before[offs[offs < n]] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[offs[offs > 0] - 1] = False
    ends = np.flatnonzero(w & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offs))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family=FIRST) -> np.ndarray:
    """64-bit hash of each byte slice; equal slices have equal hashes."""
    n = len(data)
    powers, _, code, salt = family
    up, down = powers.get(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(code[data] * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * salt)


def window_hashes(tokens: np.ndarray, first: np.ndarray, width: int, family=FIRST) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hash of every ``width``-token window that stays in one document.

    Returns the start tokens and the hashes.
    """
    n = len(tokens)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    up, down = family[1].get(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(tokens * up[:n], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * down[: n - width + 1]
    limit = np.repeat(first[1:], np.diff(first))  # end of each token's document
    at = np.flatnonzero(np.arange(width, n + 1) <= limit[: n - width + 1])
    return at, mix(h[at])


def per_doc_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over ``first[i]:first[i+1]``, empty ranges included."""
    sums = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def covered(starts: np.ndarray, width: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in any range ``start .. start + width``."""
    edge = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    edge -= np.bincount(starts + width, minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0
