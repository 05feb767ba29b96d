"""Operator 4: SimHash near-duplicates, candidates by pigeonring filtering.

A fingerprint's 64 bits lie on a ring of 16 segments of 4 bits.  If two
fingerprints differ in at most 4 bits, some segment starts a chain in which any
run of l segments differs in at most floor(l * 4 / 16) bits (the strong form of
the pigeonhole principle on a ring).  So from that start 3 segments are equal
and the next 4 differ in at most one bit, so that 3 of these 4 are equal too:
each start and choice of 3 gives one 24-bit key, 64 keys a fingerprint.  Of more
than ``SHORT_KEYS`` fingerprints too many would share a key by chance; there 11
segments with at most two touched give 352 keys of 36 bits.  Within a key the
cumulative differences of the whole chain are checked against their budgets
before the full Hamming distance.

Only distinct fingerprints are keyed.  A bucket of one key is searched for a
spanning forest of its links (never for all pairs): a found fingerprint leaves
the search, so a dense bucket costs little.  A bucket above ``BUCKET_ROWS`` is
split into parts, and each pair of parts is searched by a task of its own.

Cases: a null or empty text has fingerprint 0, linked like any other; rows of a
null doc_id have a fingerprint and the least id of their component (null if it
has none); repeated rows and exact copies share a fingerprint; a bit that half of
the shingles set is 0; a very long text is hashed in a block of its own, in memory
in proportion to its length; an empty table gives no rows;
``drop_near_duplicates`` carries further columns unchanged.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clusterio import checkpointed, read, shielded, small_side, summed_vectors
from .components import components
from .textcore import LOWER, U64, Block, blocks, mix, words_of

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS, WIDTH = 16, 4
#: Fingerprints up to which keys take 7 segments of the ring (24 bits); beyond, 11 (36 bits).
SHORT_KEYS = 1 << 26
BUCKET_ROWS = 20_000
#: Cells of the count that shows whether a bucket can be large.
CELLS = 1 << 20
SMALL_RUN = 16


def fingerprints(column, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text."""
    digest, seed = xxhash.xxh64_intdigest, SEED
    out = np.zeros(len(column), U64)
    for b in blocks(column):
        low = LOWER[b.data]
        joined = [b" ".join(low[i:j].tobytes().split()) for i, j in zip(b.offsets[:-1], b.offsets[1:], strict=True)]
        lengths = np.fromiter(map(len, joined), np.int64, b.n)
        flat = b"".join(joined)
        w = words_of(Block(0, np.frombuffer(flat, np.uint8), np.concatenate([[0], np.cumsum(lengths)])))
        counts = w.counts
        per = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
        first = np.concatenate([[0], np.cumsum(per)])
        doc = np.repeat(np.arange(b.n), per)
        begin = w.first[doc] + np.arange(first[-1]) - first[doc]
        end = np.minimum(begin + shingle, w.first[doc + 1]) - 1
        hashes = np.fromiter((digest(flat[s:e], seed) for s, e in zip(w.starts[begin].tolist(), w.ends[end].tolist(), strict=True)), U64, len(doc))
        out[b.first_row : b.first_row + b.n] = _majority(hashes, first)
    return out


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per range of hashes, the bits set in over half of them."""
    full = np.flatnonzero(np.diff(first) > 0)
    result = np.zeros(len(first) - 1, U64)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[:-1][full], axis=0, dtype=np.int32)
        most = 2 * ones > np.diff(first)[full, None]
        result[full] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fp = fingerprints(batch.column("text")).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fp)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _ring(values: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Fingerprints turned so that segment ``start`` comes first (lowest)."""
    k = np.asarray(start).astype(U64) * U64(WIDTH)
    return (values >> k) | (values << ((U64(64) - k) & U64(63)))


class Keys:
    """The kinds of keys: a start on the ring and the segments that must be equal.

    In the chain from some start, any first l of its segments differ in at most
    l * MAX_BITS // SEGMENTS bits, so no more of them are touched.  Over
    ``4 * touched + 3`` segments at most ``touched`` are; each way to touch as many
    leaves the others equal, and these are a key.
    """

    def __init__(self, touched: int):
        per = SEGMENTS // MAX_BITS
        length = per * touched + per - 1
        allowed = [t for t in combinations(range(length), touched) if all(sum(x < n for x in t) <= n // per for n in range(length))]
        kept = [[s for s in range(length) if s not in t] for t in allowed]
        self.kinds = [(start, k) for start in range(SEGMENTS) for k in kept]
        self.bits = WIDTH * (length - touched)
        self.starts = np.array([start for start, _ in self.kinds])

    def of(self, prints: np.ndarray) -> np.ndarray:
        """Keys of all kinds, kind by kind."""
        turned = [_ring(prints, s) for s in range(SEGMENTS)]
        return np.concatenate([self._packed(turned[start], kept, number) for number, (start, kept) in enumerate(self.kinds)])

    def _packed(self, turned: np.ndarray, kept: list[int], number: int) -> np.ndarray:
        out = np.full(len(turned), number << self.bits, U64)
        for at, s in enumerate(kept):
            out |= ((turned >> U64(WIDTH * s)) & U64((1 << WIDTH) - 1)) << U64(WIDTH * at)
        return out.view(np.int64)


def keys_for(count: int) -> Keys:
    """Keys whose length follows the number of fingerprints, so that buckets stay small."""
    return Keys(1 if count <= SHORT_KEYS else 2)


#: (bits of the chain's first l segments, budget) where the budget is about to grow
CHAIN = [((1 << (WIDTH * n)) - 1, n * MAX_BITS // SEGMENTS) for n in range(1, SEGMENTS) if (n + 1) * MAX_BITS // SEGMENTS > n * MAX_BITS // SEGMENTS]


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Indexes of the pairs that pass the chain from ``start`` and then the Hamming check."""
    x = _ring(a ^ b, start)
    ok = np.arange(len(x))
    for mask, budget in [*CHAIN, ((1 << 64) - 1, MAX_BITS)]:
        ok = ok[np.bitwise_count(x[ok] & U64(mask)) <= budget]
    return ok


def forest(left: np.ndarray, right: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that join all of ``left`` and ``right`` that links join.

    With ``right`` empty, links within ``left``; else between the two only.
    """
    edges: list[tuple[int, int]] = []
    sides = [left, right] if len(right) else [left]
    free = [np.arange(len(s)) for s in sides]
    while len(free[0]):
        seed, free[0] = int(free[0][0]), free[0][1:]
        queue = [(0, seed)]
        while queue:
            side, i = queue.pop()
            other = side ^ 1 if len(sides) == 2 else side
            rest = free[other]
            if not len(rest):
                continue
            hit = linked(sides[side][i], sides[other][rest], start)
            if len(hit):
                found = rest[hit]
                free[other] = np.delete(rest, hit)
                a = int(sides[side][i])
                edges += [(a, int(x)) for x in sides[other][found]]
                queue += [(other, int(x)) for x in found]
    return edges


def links(prints: DataFrame, bucket_rows: int = BUCKET_ROWS, keys: Keys | None = None) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that join all that link."""
    keys = keys or keys_for(prints.count())

    def key(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(U64)
            for at in range(0, len(fp), 2000):
                own = fp[at : at + 2000]
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys.of(own)), "fp": pa.array(np.tile(own, len(keys.kinds)).view(np.int64))})

    def cells(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(U64)
            for at in range(0, len(fp), 2000):
                cell = mix(keys.of(fp[at : at + 2000]).view(U64)) & U64(CELLS - 1)
                total += np.bincount(cell.astype(np.int64), minlength=CELLS)
        return total

    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.repartition(tasks, "fp")
    keyed = spread.mapInArrow(key, "key long, fp long")
    # a bucket has at most as many rows as its cell, so mostly no bucket needs a count of its own
    if summed_vectors(prints, cells, CELLS).max(initial=0) <= bucket_rows:
        return _searched(keyed.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("part"), "fp"), keys)
    large = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows))
    sized = keyed.join(small_side(large), "key", "left")
    n = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(bucket_rows)).cast("int")
    part = F.pmod(F.xxhash64("fp"), n).cast("int")
    sized = sized.select("key", "fp", n.alias("k"), part.alias("part"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j"))))
    return _searched(sized.select("key", "fp", "part", pair.alias("p")).select("key", "p.i", "p.j", "part", "fp"), keys)


def _searched(parts: DataFrame, keys: Keys) -> DataFrame:
    """Searches each (key, i, j) in sorted order, without a group per key.

    Rows are dealt by (key, i, j) and sorted, so a bucket is a run of rows; runs
    of one row are passed over in bulk.
    """

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            cut = _last_run(rows)
            if cut:
                yield from _runs(rows.slice(0, cut), keys)
                held = [x for x in rows.slice(cut).to_batches() if x.num_rows]
        if held:
            yield from _runs(pa.Table.from_batches(held), keys)

    dealt = parts.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _columns(rows: pa.Table):
    return [rows[c].to_numpy() for c in ("key", "i", "j", "part", "fp")]


def _breaks(key, i, j) -> np.ndarray:
    return np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1


def _last_run(rows: pa.Table) -> int:
    key, i, j, _, _ = _columns(rows)
    cut = _breaks(key, i, j)
    return int(cut[-1]) if len(cut) else 0


def _within_small(keys: Keys, key, whole, fp, run, size) -> list[tuple[int, int]]:
    """Links within runs of up to SMALL_RUN rows, all runs at once."""
    edges: list[tuple[int, int]] = []
    small = np.flatnonzero(whole & (size > 1) & (size <= SMALL_RUN))
    for d in range(1, SMALL_RUN):
        a = small[small + d < len(fp)]
        a = a[run[a] == run[a + d]]
        if not len(a):
            break
        starts = keys.starts[key[a] >> keys.bits]
        ok = a[linked(fp[a], fp[a + d], starts)]
        edges += zip(fp[ok].tolist(), fp[ok + d].tolist(), strict=True)
    return edges


def _runs(rows: pa.Table, keys: Keys):
    key, i, j, part, fp = _columns(rows)
    fp = fp.view(U64)
    bounds = np.concatenate([[0], _breaks(key, i, j), [len(key)]])
    sizes = np.diff(bounds)
    edges = _within_small(keys, key, i == j, fp, np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes, sizes))
    for r in np.flatnonzero((sizes > 1) & ((sizes > SMALL_RUN) | (i != j)[bounds[:-1]])):
        s, e = int(bounds[r]), int(bounds[r + 1])
        start = int(keys.starts[int(key[s]) >> keys.bits])
        if i[s] == j[s]:
            edges += forest(fp[s:e], fp[:0], start)
        else:
            own = part[s:e] == i[s]
            if own.any() and not own.all():
                edges += forest(fp[s:e][own], fp[s:e][~own], start)
    if edges:
        ab = np.array(edges, dtype=U64).view(np.int64)
        yield pa.RecordBatch.from_pydict({"a": pa.array(ab.min(axis=1)), "b": pa.array(ab.max(axis=1))})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable) of each row."""
    prints = checkpointed(fingerprinted(docs))
    least = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("own")))
    roots = checkpointed(components(links(least.select("fp"))))
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    rooted = checkpointed(rooted)
    ids = checkpointed(rooted.groupBy("root").agg(F.min("own").alias("component_id")))
    label = checkpointed(rooted.join(small_side(ids), "root").select(F.col("fp").alias("_fp"), "component_id"))
    return prints.join(small_side(label), F.col("fp") == F.col("_fp"), "left").drop("_fp")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays, the one of the least doc_id.

    Rows that repeat the staying doc_id are that document and stay as they are;
    a row of a null doc_id is never dropped; all columns stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"))
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = small_side(checkpointed(gone))
    return shielded(docs, ("doc_id",), lambda plain: plain.join(gone, plain["doc_id"] == gone["_gone"], "left_anti"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
