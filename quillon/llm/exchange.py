"""Packed exchange of sorted keys between chunks and buckets.

A chunk is a bounded group of documents, a bucket a range of keys.  Each chunk
sends each bucket one row with its distinct keys in order, as differences, and
a value per key.  The number of rows is at most the number of keys, and keys
repeated within a chunk are aggregated before the shuffle, so a key that a third
of all documents hold comes at most once from each chunk.  Where a corpus has so
many buckets that a row would hold a few keys only, the rows are slices of one
buffer instead, without any work per row.

What only one chunk holds needs no exchange: chunks first offer their keys cut
to a few bits more than the number of keys has (``offer``), the bucket answers
one bit a key, set where another chunk may hold the key, too (``shared``), and
only such keys are then sent whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .clusterio import pack, unpack
from .textcore import U64

BUCKET_KEYS = 1 << 19
MIN_BUCKETS = 64
#: Keys a row from which packing pays.
DENSE = 16
#: Bits of an offered key beyond those that number all keys: one in 2**6 is sent in vain.
SPARE_BITS = 6
SCHEMA = "bucket int, chunk long, first long, gaps binary, data binary, more binary"
ANSWER = "chunk long, bucket int, found binary"
_RECORD = np.dtype([("key", "<u8"), ("value", "<i8")])


def bucket_bits(keys: int) -> int:
    """Buckets as a power of two, about ``BUCKET_KEYS`` keys each."""
    return max(MIN_BUCKETS, -(-keys // BUCKET_KEYS)).bit_length() - 1


def offer_bits(keys: int) -> int:
    """Width of an offered key, which follows the number of keys."""
    return min(64, max(32, keys.bit_length() + SPARE_BITS))


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the least unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def _slices(flat: np.ndarray, cut: np.ndarray) -> pa.Array:
    """``flat[cut[k]:cut[k + 1]]`` as binary values, sharing one buffer."""
    offsets = (cut * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def send(chunk: int, keys: np.ndarray, values: np.ndarray, bits: int, width: int = 64, more: np.ndarray | None = None, base: int = 0) -> pa.Table:
    """Rows for the buckets; ``keys`` sorted (of ``width`` bits), ``values`` int64.

    ``more`` goes along as it is; bucket numbers start at ``base``.
    """
    bucket = (keys >> U64(width - bits)).astype(np.int32)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, np.int64)
    cut = np.append(starts, len(keys))
    if len(keys) < DENSE * len(starts):
        records = np.empty(len(keys), _RECORD)
        records["key"], records["value"] = keys, values
        gaps, data = pa.nulls(len(starts), pa.binary()), _slices(records, cut)
    else:
        apart = np.diff(keys)
        rows = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        gaps = pa.array([pack48(apart[s : e - 1]) for s, e in rows], pa.binary())
        data = pa.array([sized_pack(values[s:e]) for s, e in rows], pa.binary())
    return pa.table(
        {
            "bucket": pa.array(bucket[starts] + np.int32(base), pa.int32()),
            "chunk": pa.array(np.full(len(starts), chunk), pa.int64()),
            "first": pa.array(keys[starts].view(np.int64)),
            "gaps": gaps,
            "data": data,
            "more": _slices(more, cut) if more is not None and len(keys) else pa.nulls(len(starts), pa.binary()),
        }
    )


def received(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, values, number of the row) of all rows of a bucket, row by row."""
    keys, values, sizes = [], [], []
    for first, gaps, data in zip(rows["first"].to_numpy(), rows["gaps"], rows["data"], strict=True):
        gaps = gaps.as_py()
        if gaps is None:
            records = np.frombuffer(data.as_py(), _RECORD)
            keys.append(records["key"])
            values.append(records["value"])
        else:
            start = np.array([first], np.int64).view(U64)
            keys.append(np.cumsum(np.concatenate([start, unpack48(gaps)]), dtype=U64))
            values.append(sized_unpack(data.as_py()))
        sizes.append(len(keys[-1]))
    return np.concatenate(keys), np.concatenate(values), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)


def answered(rows: pa.Table, origin: np.ndarray, values: np.ndarray, code) -> pa.Table:
    """One answer for each row: ``code`` of the values of its keys, in order."""
    cut = np.searchsorted(origin, np.arange(len(rows) + 1)).tolist()
    found = [code(values[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"], "found": pa.array(found, pa.binary())})


def bits_of(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def offer(chunk: int, keys: np.ndarray, several: np.ndarray, bits: int, width: int, base: int = 0) -> pa.Table:
    """Offers of sorted distinct keys of ``width`` bits; ``several`` marks those that the chunk alone holds more than once."""
    return send(chunk, keys, several.astype(np.int64), bits, width, base=base)


def shared(rows: pa.Table) -> pa.Table:
    """Which offered keys of each row come from another row, too, or are marked."""
    keys, several, origin = received(rows)
    order = np.argsort(keys)
    same = np.concatenate([[False], keys[order][1:] == keys[order][:-1], [False]])
    twice = np.empty(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    if several.any():
        twice |= np.isin(keys, keys[several > 0])
    return answered(rows, origin, twice, bits_of)


def sums(rows: pa.Table) -> pa.Table:
    """The sum of the values of each key over all rows, for every row."""
    keys, values, origin = received(rows)
    _, at = np.unique(keys, return_inverse=True)
    return answered(rows, origin, np.bincount(at, weights=values).astype(np.int64)[at], sized_pack)


def gathered(answers: pa.Table, base: int, bits: int) -> list[bytes]:
    """What the buckets ``base .. base + 2**bits`` answered, in their order."""
    bucket = answers["bucket"].to_numpy()
    own = np.flatnonzero((bucket >= base) & (bucket < base + (1 << bits)))
    own = own[np.argsort(bucket[own])]
    return answers["found"].take(pa.array(own)).to_pylist()


def flags_for(keys: np.ndarray, width: int, answers: pa.Table, base: int, bits: int) -> np.ndarray:
    """The bit that the buckets answered for each of the sorted keys that were sent."""
    found = gathered(answers, base, bits)
    bucket = (keys >> U64(width - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=1 << bits)) if len(keys) else np.zeros(1, np.int64)
    own = np.diff(cut).tolist()
    if len(own) != len(found):
        raise ValueError("a bucket did not answer its chunk")
    parts = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(found, own, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def values_for(answers: pa.Table, base: int, bits: int) -> np.ndarray:
    """The values that the buckets answered, in the order of the keys sent."""
    parts = [sized_unpack(x) for x in gathered(answers, base, bits)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def pack48(gaps: np.ndarray) -> bytes:
    """Differences in as many bytes as the largest needs: a width, then planes."""
    if not len(gaps):
        return b""
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    # only the top plane has few values; the others are as good as random
    top = pa.compress(planes[-1].tobytes(), codec="zstd", asbytes=True)
    return bytes([width]) + len(gaps).to_bytes(4, "little") + planes[:-1].tobytes() + top


def unpack48(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, U64)
    width, n = data[0], int.from_bytes(data[1:5], "little")
    cut = 5 + (width - 1) * n
    planes = np.zeros((8, n), np.uint8)
    planes[: width - 1] = np.frombuffer(data[5:cut], np.uint8).reshape(width - 1, n)
    planes[width - 1] = np.frombuffer(pa.decompress(data[cut:], decompressed_size=n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(U64, copy=False)


def sized_pack(values: np.ndarray) -> bytes:
    """Integers relative to their least one, in the least width."""
    if not len(values):
        return b""
    low = int(values.min())
    small = narrow(values - low)
    return low.to_bytes(8, "little", signed=True) + bytes([small.itemsize]) + pack(small)


def sized_unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    low = int.from_bytes(data[:8], "little", signed=True)
    return unpack(data[9:], np.dtype(f"<u{data[8]}")).astype(np.int64) + low
