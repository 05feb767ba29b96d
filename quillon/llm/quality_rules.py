"""Operator 2: quality rules by hashed n-gram log-likelihood ratio.

Byte n-grams are hashed into a fixed number of cells.  Two smoothed multinomials
are counted over all rows: one over the trusted target (documents labelled of
quality 1), one over the raw corpus.  The target is first brought to the raw
corpus's size, so that its share of the corpus does not matter.  A document's
score is the mean, per n-gram, of log p(target) - log p(raw); it is kept if that
reaches the threshold, the same for every document.  Simple counted rules reject
first.

Cases: a null or empty text has no words and fails the base rules; a text
shorter than an n-gram scores 0; without any labelled document the target equals
the raw corpus and every score is 0, so only the base rules decide; a doc_id
labelled twice is trusted once if any of its rows says 1; null ids are never
trusted; repeated rows get equal results; a very long text is judged whole, in
memory in proportion to its length; no result depends on ties; an empty table
gives no rows; ``filter_quality`` carries further columns unchanged, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clusterio import read, shielded, small_side, summed_vectors
from .textcore import PLAIN_WORD, U64, Block, blocks, covered, mix, per_doc_sum, slice_hashes, window_hashes, words_of

NGRAM = 4
CELLS = 1 << 16
#: Pseudo-count of a cell as a share of the raw corpus's mean cell (1 at least), so
#: that wordings too rare to be judged weigh little at every corpus size.
SMOOTHING = 0.05
#: n-grams of the raw distribution that are added to the target, so that a target of
#: few labelled texts comes near the raw corpus and little is rejected on its word.
EVIDENCE = CELLS // 2
#: Mean log-likelihood ratio (nats per n-gram) from which a document is kept.
THRESHOLD = -0.5
MIN_WORDS = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def ngram_cells(block: Block, n: int = NGRAM, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each byte n-gram that stays in its document, and their first."""
    size = len(block.data)
    per_doc = np.maximum(np.diff(block.offsets) - (n - 1), 0)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    if size < n:
        return np.zeros(0, np.int64), first
    wide = block.data.astype(np.uint32)
    code = wide[: size - n + 1].copy()
    for k in range(1, n):
        code = code * np.uint32(257) + wide[k : size - n + 1 + k]
    code *= np.uint32(0x9E3779B1)
    cell = (code >> np.uint32(32 - int(cells).bit_length() + 1)).astype(np.int64)
    inside = np.ones(size - n + 1, bool)
    for back in range(1, n):
        edge = block.offsets[1:-1] - back
        inside[edge[(edge >= 0) & (edge < len(inside))]] = False
    return cell[inside], first


def _counted(batches) -> np.ndarray:
    total = np.zeros(2 * CELLS, np.int64)
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for b in blocks(batch.column("text")):
            cells, first = ngram_cells(b)
            total[CELLS:] += np.bincount(cells, minlength=CELLS)
            own = np.repeat(trusted[b.first_row : b.first_row + b.n], np.diff(first))
            total[:CELLS] += np.bincount(cells[own], minlength=CELLS)
    return total


def log_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log p(target) - log p(raw) of each cell, counted over all rows."""
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select("doc_id", "text").join(small_side(trusted), F.col("doc_id") == F.col("_id"), "left")
    counts = summed_vectors(rows.select("text", F.col("_id").isNotNull().alias("trusted")), _counted, 2 * CELLS)
    target, raw = counts[:CELLS], counts[CELLS:]
    if not target.sum():
        target = raw
    size = max(1, raw.sum())
    prior = max(1.0, SMOOTHING * size / CELLS)
    # both add up to the size of the raw corpus
    scaled = raw if target is raw else (target * (size / EVIDENCE) + raw) / (target.sum() / EVIDENCE + 1)
    return np.log(scaled + prior) - np.log(raw + prior)


def measures(b: Block) -> dict[str, np.ndarray]:
    """Counts of the base rules for each document of a block."""
    w = words_of(b)
    is_word = PLAIN_WORD[b.data]
    chars = is_word & ((b.data & 0xC0) != 0x80)
    return {
        "n_words": w.counts,
        "word_chars": per_doc_sum(chars, b.offsets),
        "n_symbols": per_doc_sum(SYMBOLS[b.data], b.offsets),
        "n_dup_lines": _dup_lines(b, is_word),
        "n_repeat_words": _repeat_words(b, w),
    }


def _dup_lines(b: Block, is_word: np.ndarray) -> np.ndarray:
    breaks = np.flatnonzero(b.data == 10)
    starts = np.union1d(b.offsets[:-1], breaks + 1)
    starts = starts[starts < len(b.data)]
    if not len(starts):
        return np.zeros(b.n, np.int64)
    ends = np.append(starts[1:], len(b.data))
    # the newline itself is not part of its line
    ends = ends - ((ends > starts) & (b.data[ends - 1] == 10))
    sums = np.concatenate([[0], np.cumsum(is_word)])
    full = sums[ends] > sums[starts]
    starts, ends = starts[full], ends[full]
    doc = np.searchsorted(b.offsets, starts, side="right") - 1
    key = mix(slice_hashes(b.data, starts, ends) + mix(doc.astype(U64)))
    _, at = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[at] = False
    return np.bincount(doc[later], minlength=b.n)


def _repeat_words(b: Block, w) -> np.ndarray:
    at, h = window_hashes(slice_hashes(b.data, w.starts, w.ends), w.first, 3)
    doc = w.doc_of()
    key = mix(h + mix(doc[at].astype(U64)))
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    twice = at[order[same[1:] | same[:-1]]]
    return per_doc_sum(covered(twice, 3, len(w.starts)), w.first)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(table, threshold: float):
    def run(batches):
        ratio = table.value
        for batch in batches:
            out = {k: np.zeros(batch.num_rows, np.int64) for k in _COUNTS}
            score = np.zeros(batch.num_rows)
            for b in blocks(batch.column("text")):
                rows = slice(b.first_row, b.first_row + b.n)
                for k, v in measures(b).items():
                    out[k][rows] = v
                cells, first = ngram_cells(b)
                score[rows] = per_doc_sum(ratio[cells], first) / np.maximum(np.diff(first), 1)
            failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name) for name in batch.schema.names}
                | {k: pa.array(v) for k, v in out.items()}
                | {"base_failed": pa.array(failed), "score": pa.array(score), "kept": pa.array(~failed & (score >= threshold))}
            )

    return run


_ADDED = [*((k, T.LongType()) for k in _COUNTS), ("base_failed", T.BooleanType()), ("score", T.DoubleType()), ("kept", T.BooleanType())]


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus the base counts, base_failed, score and kept."""
    table = docs.sparkSession.sparkContext.broadcast(log_ratio(docs, labels))
    docs = docs.drop(*(k for k, _ in _ADDED))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(k, t) for k, t in _ADDED)])
    return docs.mapInArrow(_judge(table, threshold), schema)


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, unchanged, with all their columns."""
    return shielded(docs, ("doc_id", "text"), lambda plain: judged(plain, labels).filter("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", *_COUNTS, "base_failed", "kept", "score")
