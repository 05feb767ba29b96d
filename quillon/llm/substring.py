"""Operator 3: substring dedup by Rabin-Karp hashes of token windows.

Every window of ``WINDOW`` consecutive words is hashed (a rolling hash of the
words' hashes) and counted in Spark: documents are dealt into bounded chunks,
and each chunk offers its distinct windows by a cut hash.  Windows that no other
document holds end there.  Of the others, chunks send 128 bits of two
independent hashes with the least doc_id that starts them, and the bucket of a
hash finds the least doc_id over all chunks.  A window whose sequence also
starts in a document of a smaller doc_id is repeated; repeated windows of a
document merge into maximal removal intervals.  Windows are judged on the input,
so the result doesn't depend on order.

Equal pairs of hashes are taken as equal sequences: 128 bits over n distinct
windows collide with probability about n * n / 2**129 (1e-13 at 100 TB).

Cases: a null text has no words; a text shorter than a window stays; a window
repeated only within its own document stays; rows of a null doc_id neither
remove nor lose words; rows that repeat a doc_id do not remove from each other;
a very long text is a chunk's largest part, hashed in one sweep, and takes memory
in proportion to its length; no result depends on ties; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from .clusterio import dealt, lean, lean_pair, read, steady, text_bytes, unpacked
from .exchange import ANSWER, SCHEMA, answered, bits_of, bucket_bits, flags_for, offer, offer_bits, received, send, shared
from .textcore import SECOND, U64, blocks, covered, slice_hashes, window_hashes, words_of

WINDOW = 50
BYTES_A_WORD = 6


class Windows:
    """Windows of a chunk: documents by doc_id, nulls aside."""

    def __init__(self, chunk: pa.Table, width: int, both: bool):
        self.rows = unpacked(chunk).sort_by([("doc_id", "ascending")]).combine_chunks()
        ids = self.rows["doc_id"]
        self.known = len(ids) - ids.null_count  # nulls sort last
        self.ids = ids.slice(0, self.known).to_numpy()
        hashes, checks, starts, docs = [], [], [], []
        self.counts = np.zeros(len(ids), np.int64)
        for b in blocks(self.rows["text"]):
            w = words_of(b)
            self.counts[b.first_row : b.first_row + b.n] = w.counts
            at, h = window_hashes(slice_hashes(b.data, w.starts, w.ends), w.first, width)
            doc = w.doc_of()[at]
            hashes.append(h)
            if both:
                checks.append(window_hashes(slice_hashes(b.data, w.starts, w.ends, SECOND), w.first, width, SECOND)[1])
            starts.append(at - w.first[doc])
            docs.append((doc + b.first_row).astype(np.int32))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.hash, self.check, self.start, self.doc = join(hashes, U64), join(checks, U64), join(starts, np.int64), join(docs, np.int32)
        usable = self.doc < self.known
        self.hash, self.start, self.doc = self.hash[usable], self.start[usable], self.doc[usable]
        self.check = self.check[usable] if both else self.check

    def cut(self, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes of ``wide`` bits, which are of several documents, each window's index."""
        keys, at, inverse = np.unique(self.hash >> U64(64 - wide), return_index=True, return_inverse=True)
        several = np.zeros(len(keys), bool)
        if len(keys):
            several[inverse[self.ids[self.doc] != self.ids[self.doc[at]][inverse]]] = True
        return keys, several, inverse

    def keep(self, flags: np.ndarray) -> None:
        """Forgets all windows that are not flagged."""
        self.hash, self.check, self.start, self.doc = self.hash[flags], self.check[flags], self.start[flags], self.doc[flags]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """First window of each distinct pair of hashes, in their order, and each window's index."""
        order = np.lexsort((self.doc, self.check, self.hash))
        h, c = self.hash[order], self.check[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]) if len(h) else np.zeros(0, bool)
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return order[new], inverse


def _offer(width: int, bits: int, wide: int):
    def run(chunk: pa.Table) -> pa.Table:
        keys, several, _ = Windows(chunk, width, False).cut(wide)
        return offer(chunk["chunk"][0].as_py(), keys, several, bits, wide)

    return run


def _held_elsewhere(chunk: pa.Table, answers: pa.Table, width: int, bits: int, wide: int) -> Windows:
    """The windows of a chunk that other documents may hold, too."""
    w = Windows(chunk, width, True)
    keys, _, inverse = w.cut(wide)
    w.keep(flags_for(keys, wide, answers, 0, bits)[inverse])
    return w


def _claim(width: int, bits: int, wide: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(chunk):
            return send(0, np.zeros(0, U64), np.zeros(0, np.int64), bits)
        w = _held_elsewhere(chunk, answers, width, bits, wide)
        first, _ = w.distinct()
        return send(chunk["chunk"][0].as_py(), w.hash[first], w.ids[w.doc[first]], bits, more=w.check[first])

    return run


def _late(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        """Which of each chunk's windows start in a smaller doc_id elsewhere."""
        keys, ids, origin = received(rows)
        check = np.frombuffer(b"".join(rows["more"].to_pylist()), U64)
        order = np.lexsort((ids, check, keys))
        k, c = keys[order], check[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
        late = np.zeros(len(keys), bool)
        late[order] = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1] < ids[order]
        answers = answered(rows, origin, late, bits_of)
        # told apart from the answers to the offers
        return answers.set_column(1, "bucket", pa.compute.add(answers["bucket"], pa.scalar(1 << bits, pa.int32())))

    return run


_RESULT = "doc_id long, n_words long, n_removed long, removed_start array<long>, removed_end array<long>, kept_sha256 string"


def _remove(width: int, texts: bool, bits: int, wide: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        w = _held_elsewhere(chunk, answers, width, bits, wide)
        first, inverse = w.distinct()
        late = flags_for(w.hash[first], 64, answers, 1 << bits, bits)
        ids = w.ids
        repeated = late[inverse] | (ids[w.doc[first][inverse]] < ids[w.doc]) if len(first) else np.zeros(0, bool)
        base = np.concatenate([[0], np.cumsum(w.counts)])
        gone = covered(base[w.doc[repeated]] + w.start[repeated], width, int(base[-1]))
        out: dict[str, list] = {k: [] for k in ("removed_start", "removed_end", "kept_sha256", "text")}
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = np.diff(total[base])
        for b in blocks(w.rows["text"]):
            for i in range(b.n):
                r = b.first_row + i
                words = b.raw(i).split()
                s = e = ()
                if removed[r]:
                    own = gone[base[r] : base[r + 1]]
                    edge = np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))
                    s, e = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                    words = compress(words, (~own).tolist())
                kept = b" ".join(words)
                out["removed_start"].append(s)
                out["removed_end"].append(e)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if texts:
                    out["text"].append(kept.decode("utf-8"))
        return pa.table(
            {
                "doc_id": w.rows["doc_id"],
                "n_words": pa.array(w.counts),
                "n_removed": pa.array(removed, pa.int64()),
                "removed_start": pa.array(out["removed_start"], pa.list_(pa.int64())),
                "removed_end": pa.array(out["removed_end"], pa.list_(pa.int64())),
                "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
            }
            | ({"kept_text": pa.array(out["text"], pa.string())} if texts else {})
        )

    return run


def substring_dedup(docs: DataFrame, width: int = WINDOW, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, removal intervals in words, kept_sha256.

    ``texts`` adds kept_text, the kept words joined by single spaces.
    """
    docs = steady(docs)
    size = text_bytes(docs)
    windows = size // BYTES_A_WORD
    bits, wide = bucket_bits(windows), offer_bits(windows)
    base = dealt(docs.select("doc_id", "text"))
    offered = base.groupBy("chunk").applyInArrow(lean(_offer(width, bits, wide)), SCHEMA)
    held = offered.groupBy("bucket").applyInArrow(lean(shared), ANSWER)
    claimed = base.groupBy("chunk").cogroup(held.groupBy("chunk")).applyInArrow(lean_pair(_claim(width, bits, wide)), SCHEMA)
    late = claimed.groupBy("bucket").applyInArrow(lean(_late(bits)), ANSWER)
    schema = _RESULT + (", kept_text string" if texts else "")
    return base.groupBy("chunk").cogroup(held.union(late).groupBy("chunk")).applyInArrow(lean_pair(_remove(width, texts, bits, wide)), schema)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
