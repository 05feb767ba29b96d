"""Operator 10: quality classifier, a linear-chain conditional random field.

Every line of a text is one position of the chain, good (1) or bad (0).  Its
features are shares and lengths measured on its own bytes and on those of the
lines before and after it; a document's label is the label of all its lines in
training.  Forward-backward gives each line's marginal, and the marginals,
weighted by the lines' lengths, average into the document's quality.

The model is fitted on a sample: all lines of at most ``SAMPLE`` labelled
documents, those of the least seeded hash of their id.  Scoring reads every line of every document.

Cases: a null or empty text has no line and gets the base rate of label 1 in the
sample; without any label the score is 0.5 everywhere; a doc_id labelled twice
counts with its greatest label, and of rows that repeat an id one text is trained
on, the same in every run; ties of the hash are broken by doc_id; repeated rows get
equal scores; a very long text is scored whole, in memory in proportion to its
length; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusterio import checkpointed, read
from .textcore import PLAIN_WORD, U64, Block, blocks, mix, slice_hashes, words_of

#: Labelled documents that the model is fitted on at most, and their lines in all; both bound what the driver holds (34 MB).
SAMPLE, LINES, SEED = 3_000, 200_000, 17
HELD_OUT_FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3
STEPS, RATE, DECAY = 250, 0.1, 1e-4

_BYTES = {
    "symbols": b"#*$%&|<>",
    "shouts": b"!",
    "ends": b".,;:?",
    "digits": b"0123456789",
    "upper": bytes(range(65, 91)),
    "brackets": b"()[]{}=\"'_/\\@",
}
_TABLES = np.stack([np.isin(np.arange(256), list(v)) for v in _BYTES.values()])
OWN = [*_BYTES, "no_words", "log_words", "word_length", "distinct_words", "repeated_next", "dup_line", "log_bytes"]
#: own features, those of the line before and after, first and last line, bias
N_FEATURES = 3 * len(OWN) + 3


@dataclass
class Lines:
    """Lines of a block that hold a byte, with their features."""

    doc: np.ndarray
    length: np.ndarray
    features: np.ndarray


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def lines_of(b: Block) -> Lines:
    breaks = np.flatnonzero(b.data == 10)
    starts = np.union1d(b.offsets[:-1], breaks + 1)
    starts = starts[starts < len(b.data)]
    ends = np.append(starts[1:], len(b.data))
    ends = ends - ((ends > starts) & (b.data[ends - 1] == 10)) if len(starts) else ends
    full = ends > starts
    starts, ends = starts[full], ends[full]
    doc = np.searchsorted(b.offsets, starts, side="right") - 1
    size = (ends - starts).astype(float)
    columns = [_sums(t[b.data], starts, ends) / size for t in _TABLES]

    w = words_of(b)
    first, last = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
    n = (last - first).astype(float)
    letters = _sums(PLAIN_WORD[b.data] & ((b.data & 0xC0) != 0x80), starts, ends)
    h = slice_hashes(b.data, w.starts, w.ends)
    line = np.repeat(np.arange(len(starts)), last - first) if len(starts) else np.zeros(0, np.int64)
    # every word lies in exactly one line
    _, at = np.unique(mix(h + mix(line.astype(U64))), return_index=True)
    distinct = np.bincount(line[at], minlength=len(starts))
    again = np.zeros(len(w.starts))
    again[1:] = h[1:] == h[:-1]
    _, at = np.unique(mix(slice_hashes(b.data, starts, ends) + mix(doc.astype(U64))), return_index=True)
    dup = np.ones(len(starts))
    dup[at] = 0
    some = np.maximum(n, 1)
    columns += [n == 0, np.log1p(n) / 5, letters / some / 10, distinct / some, _sums(again, first, last) / some, dup, np.log1p(size) / 8]
    own = np.stack(columns, axis=1) if len(starts) else np.zeros((0, len(OWN)))
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    end = np.ones(len(doc), bool)
    end[:-1] = new[1:]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[new] = 0
    after[:-1] = own[1:]
    after[end] = 0
    return Lines(doc, size, np.concatenate([own, before, after, new[:, None], end[:, None], np.ones((len(doc), 1))], axis=1))


def _by_length(sizes: np.ndarray):
    """Chains from longest to shortest, and how many have more than t lines."""
    order = np.argsort(-sizes, kind="stable")
    steps = int(sizes.max()) if len(sizes) else 0
    alive = np.searchsorted(-sizes[order], -np.arange(steps), side="left")
    return order, alive


@dataclass
class Chain:
    """Weights of label 1 against 0 per feature, and of each pair of labels."""

    emit: np.ndarray
    move: np.ndarray  # 2 x 2
    centre: np.ndarray
    scale: np.ndarray
    base_rate: float
    slope: float = 1.0
    shift: float = 0.0

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return (features - self.centre) / self.scale

    def marginals(self, scaled: np.ndarray, first: np.ndarray, weight: np.ndarray | None = None):
        """P(label 1) of each line; and the expected counts of moves, weighted by
        the line that is moved to.

        ``scaled`` are the features by the chain's own scale; ``first`` holds the first
        line of each document and the end.
        """
        potential = scaled @ self.emit
        sizes = np.diff(first)
        order, alive = _by_length(sizes)
        begin, end = first[:-1][order], first[1:][order] - 1
        unary = np.stack([np.zeros(len(potential)), potential], axis=1)
        ahead, back = unary.copy(), np.zeros_like(unary)
        for t in range(1, len(alive)):
            i = begin[: alive[t]] + t
            prev = ahead[i - 1]
            for y in (0, 1):
                ahead[i, y] += np.logaddexp(prev[:, 0] + self.move[0, y], prev[:, 1] + self.move[1, y])
        for t in range(1, len(alive)):
            i = end[: alive[t]] - t
            nxt = back[i + 1] + unary[i + 1]
            for y in (0, 1):
                back[i, y] = np.logaddexp(nxt[:, 0] + self.move[y, 0], nxt[:, 1] + self.move[y, 1])
        both = ahead + back
        log_z = np.logaddexp(both[:, 0], both[:, 1])
        p = np.exp(both[:, 1] - log_z)
        inner = np.ones(len(potential), bool)
        inner[first[:-1][sizes > 0]] = False
        i = np.flatnonzero(inner)
        own = 1.0 if weight is None else weight[i]
        moves = np.zeros((2, 2))
        for a in (0, 1):
            for c in (0, 1):
                moves[a, c] = (own * np.exp(ahead[i - 1, a] + self.move[a, c] + unary[i, c] + back[i, c] - log_z[i])).sum()
        return p, moves

    def quality(self, p: np.ndarray, length: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(doc, weights=length, minlength=n)
        mean = np.bincount(doc, weights=length * p, minlength=n) / np.maximum(total, 1e-9)
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        scaled = 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.shift)))
        return np.where(total > 0, scaled, self.base_rate)


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, length: np.ndarray) -> Chain:
    """Gradient ascent with momentum, then a calibration.

    The objective is the mean over documents of a document's log-likelihood per
    line: emissions and moves of a line have one weight, 1 / lines of its document.
    """
    centre, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale < 1e-6, 1.0, scale)
    centre = np.where(features.std(axis=0) < 1e-6, 0.0, centre)
    chain = Chain(np.zeros(features.shape[1]), np.zeros((2, 2)), centre, scale, float(labels.mean()))
    sizes = np.diff(first)
    y = np.repeat(labels, sizes).astype(float)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    # each document counts alike, however many lines it has
    weight = np.repeat(1 / np.maximum(sizes, 1), sizes)
    x = chain.scaled(features)
    counted = np.zeros((2, 2))
    for v in (0, 1):
        counted[v, v] = (np.maximum(sizes - 1, 0) / np.maximum(sizes, 1))[labels == v].sum()
    speed_e, speed_m = np.zeros_like(chain.emit), np.zeros((2, 2))
    total = max(float(weight.sum()), 1.0)
    for _ in range(STEPS):
        p, moves = chain.marginals(x, first, weight)
        step_e = x.T @ (weight * (y - p)) / total - DECAY * chain.emit
        step_m = (counted - moves) / total - DECAY * chain.move
        speed_e = 0.9 * speed_e + step_e
        speed_m = 0.9 * speed_m + step_m
        chain.emit += RATE * speed_e
        chain.move += RATE * speed_m
    p, _ = chain.marginals(x, first)
    mean = np.clip(np.bincount(doc, weights=length * p, minlength=len(sizes)) / np.maximum(np.bincount(doc, weights=length, minlength=len(sizes)), 1e-9), 1e-6, 1 - 1e-6)
    logit = np.log(mean / (1 - mean))[sizes > 0]
    own = labels[sizes > 0]
    slope, shift = 1.0, 0.0
    for _ in range(200):
        error = own - 1 / (1 + np.exp(-(slope * logit + shift)))
        slope += 0.05 * float((error * logit).mean()) / max(float((logit**2).mean()), 1e-9) * 4
        shift += 0.2 * float(error.mean())
    chain.slope, chain.shift = max(slope, 0.1), shift
    return chain


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> Chain | None:
    """Fits on labelled documents outside the held-out fold; None without any.

    Of the sample, documents are taken in its order while their lines add up to
    ``lines`` at most; one of more lines than that is scored, but not learned from.
    """
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    picked = checkpointed(known.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def measure(batches):
        for batch in batches:
            label = batch.column("quality").to_numpy()
            ids = batch.column("doc_id").to_numpy()
            for b in blocks(batch.column("text")):
                x = lines_of(b)
                first = np.searchsorted(x.doc, np.arange(b.n + 1))
                for i in range(b.n):
                    own = slice(int(first[i]), int(first[i + 1]))
                    if first[i + 1] - first[i] > lines:
                        continue
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([ids[b.first_row + i]], pa.int64()),
                            "quality": pa.array([label[b.first_row + i]], pa.int32()),
                            "x": pa.array([x.features[own].astype("<f4").tobytes()], pa.binary()),
                            "length": pa.array([x.length[own].astype("<f4").tobytes()], pa.binary()),
                        }
                    )

    rows = texts.mapInArrow(measure, "doc_id long, quality int, x binary, length binary")
    # of rows that repeat an id, the one whose lines come first in byte order
    rows = checkpointed(rows.groupBy("doc_id").agg(F.min(F.struct("x", "length", "quality")).alias("r")).select("doc_id", "r.*"))
    # at most ``sample`` rows: those whose lines fit
    in_order = Window.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = rows.select("doc_id", (F.octet_length("length") / 4).alias("n")).withColumn("n", F.sum("n").over(in_order)).filter(F.col("n") <= lines)
    rows = rows.join(F.broadcast(sized.select("doc_id")), "doc_id", "left_semi").orderBy("doc_id").collect()
    if not rows:
        return None
    parts = [np.frombuffer(bytes(r["x"]), "<f4").reshape(-1, N_FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    length = np.concatenate([np.frombuffer(bytes(r["length"]), "<f4") for r in rows]).astype(float)
    quality = np.array([r["quality"] for r in rows])
    return fit(np.concatenate(parts).astype(float), first, quality, length)


def held_out(folds: int = HELD_OUT_FOLDS, fold: int = HELD_OUT_FOLD):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def scored(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        c = model.value
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if c is not None:
                for b in blocks(batch.column("text")):
                    x = lines_of(b)
                    first = np.searchsorted(x.doc, np.arange(b.n + 1))
                    p, _ = c.marginals(c.scaled(x.features), first)
                    score[b.first_row : b.first_row + b.n] = c.quality(p, x.length, x.doc, b.n)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(score)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
