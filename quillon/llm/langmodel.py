"""Operator 5: language-model scoring with an Elias-Fano n-gram trie.

A trigram model over all training documents (those whose crc32 of the id is not
in the held-out residue).  Tokens are the words with A-Z lower-cased and one end
per text; the start of a text is a context.  Each order is smoothed with the one
below:

    p(w) = (c(w) + 1) / (N + V + 1)
    p(w | v) = (c(vw) + MU_2 p(w)) / (c(v) + MU_2)
    p(w | uv) = (c(uvw) + MU_3 p(w | v)) / (c(uv) + MU_3)

Documents are dealt into bounded chunks as they come.  A chunk learns the counts of its words
and of those bigrams and trigrams that other chunks may hold (see ``exchange``);
of the others its own counts are all there are.  N-grams are dealt by a hash of
the whole n-gram, so a common word or pair is no hot key.  The chunk then builds
the trie of the n-grams that its texts can ask for: words, bigrams and trigrams
of a count above 0, each with its quantised smoothed log-probability, contexts
with their back-off.  An n-gram that the trie has not backs off to the order
below, which is what the formulas say for a count of 0.

Cases: a null or empty text has the one token end; rows of a null doc_id train;
rows that repeat a document count each time; without any training token N = V =
0 and every token has probability 1; a very long text is a chunk's largest part
and takes memory in proportion to its length; no result depends on ties; an
empty table gives no rows; further columns are ignored.  Words and n-grams are
told apart by 64-bit hashes; log-probabilities are exact to 1 / 8000 a level.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clusterio import checkpointed, dealt, lean, lean_pair, read, steady, text_bytes, unpacked
from .exchange import ANSWER, SCHEMA, bucket_bits, flags_for, offer, offer_bits, received, send, shared, sums, values_for
from .textcore import LOWER, U64, Block, blocks, mix, slice_hashes, words_of
from .trie import Trie

HELD_OUT_MOD, HELD_OUT_REST = 7, 2
MU_2, MU_3 = 1000.0, 20.0
BYTES_A_WORD = 6
#: Tokens that no word hash is: end and start of a text.
END, START = U64(0x5EED0E4D00000001), U64(0x5EED57A470000002)
#: Kinds of rows: words, offered bigrams and trigrams, counted bigrams and trigrams.
WORDS, OFFERED, COUNTED = 0, (1, 2), (3, 4)


def is_held_out():
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MOD
    return F.coalesce(rest == HELD_OUT_REST, F.lit(False))


def block_tokens(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block, each text closed by END, and their first."""
    low = LOWER[b.data]
    w = words_of(Block(b.first_row, low, b.offsets))
    first = w.first + np.arange(b.n + 1)
    tokens = np.full(int(first[-1]), END)
    places = np.arange(len(w.starts)) + w.doc_of()
    tokens[places] = slice_hashes(low, w.starts, w.ends)
    return tokens, first


class Grams:
    """Distinct words, bigrams and trigrams of a chunk, each in trie order."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.combine_chunks()
        train = self.rows["train"].to_numpy(zero_copy_only=False)
        parts, sizes = [], []
        for b in blocks(self.rows["text"]):
            tokens, first = block_tokens(b)
            parts.append(np.insert(tokens, first[:-1], START))
            sizes.append(np.diff(first) + 1)
        sequence, size = np.concatenate(parts), np.concatenate(sizes)
        self.first = np.concatenate([[0], np.cumsum(size)])
        weight = None if train.all() else np.repeat(train, size)
        place = np.arange(len(sequence)) - np.repeat(self.first[:-1], size)
        self.names, at = np.unique(sequence, return_inverse=True)
        self.at = [at]
        self.counts = [self._counted(at, weight, len(self.names))]
        self.parent, self.word, self.hash = [], [], []
        for order in (2, 3):
            # where an n-gram of this order ends; others have the number -1
            ends = np.flatnonzero(place >= order - 1)
            before = self.at[-1][ends - 1]
            own, inverse = np.unique(before * len(self.names) + at[ends], return_inverse=True)
            numbers = np.full(len(sequence), -1)
            numbers[ends] = inverse
            self.at.append(numbers)
            self.counts.append(self._counted(inverse, weight if weight is None else weight[ends], len(own)))
            self.parent.append(own // len(self.names))
            self.word.append(own % len(self.names))
            above = self.hash[-1] if self.hash else self.names
            self.hash.append(mix(above[self.parent[-1]] * U64(2 * order + 1) + self.names[self.word[-1]]))

    def find_shorter(self) -> None:
        """Of each trigram, the number of the bigram of its last two words."""
        self.shorter = np.zeros(len(self.hash[1]), np.int64)
        ends = np.flatnonzero(self.at[2] >= 0)
        self.shorter[self.at[2][ends]] = self.at[1][ends]

    @staticmethod
    def _counted(at: np.ndarray, train: np.ndarray | None, n: int) -> np.ndarray:
        return np.bincount(at if train is None else at[train], minlength=n)

    def offered(self, k: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """N-grams of an order by their hash, the distinct cut hashes, and which begin one."""
        order = np.argsort(self.hash[k])
        keys = self.hash[k][order] >> U64(64 - wide)
        new = np.diff(keys, prepend=~keys[:1]) != 0
        return order, keys[new], new

    def held_elsewhere(self, k: int, wide: int, answers: pa.Table, bits: int) -> np.ndarray:
        """N-grams of an order that other chunks may hold, by their hash."""
        order, keys, new = self.offered(k, wide)
        return order[flags_for(keys, wide, answers, OFFERED[k] << bits, bits)[np.cumsum(new) - 1]]


def _offer(bits: int, wide: int):
    """What a chunk sends where it is cut (see ``dealt``)."""

    def run(number: int, rows: pa.Table):
        g = Grams(rows)
        yield from send(number, g.names, g.counts[0], bits).to_batches()
        for k in (0, 1):
            _, keys, _ = g.offered(k, wide)
            yield from offer(number, keys, np.zeros(len(keys)), bits, wide, base=OFFERED[k] << bits).to_batches()

    return run


def _count(bits: int, wide: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(chunk):
            return send(0, np.zeros(0, U64), np.zeros(0, np.int64), bits)
        g, number = Grams(unpacked(chunk)), chunk["chunk"][0].as_py()
        out = []
        for k in (0, 1):
            own = g.held_elsewhere(k, wide, answers, bits)
            out.append(send(number, g.hash[k][own], g.counts[k + 1][own], bits, base=COUNTED[k] << bits))
        return pa.concat_tables(out)

    return run


_KNOWN = ANSWER + ", total long, kinds long"


def _answer(bits: int):
    """Answers to words and offers; of words, also how many there are in training."""

    def run(rows: pa.Table) -> pa.Table:
        words = rows["bucket"][0].as_py() >> bits == WORDS
        out = sums(rows) if words else shared(rows)
        total, kinds = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        if words:
            keys, counts, _ = received(rows)
            counts[keys == START] = 0
            total[0], kinds[0] = counts.sum(), len(np.unique(keys[counts > 0]))
        return out.append_column("total", pa.array(total)).append_column("kinds", pa.array(kinds))

    return run


def chunk_trie(g: Grams, total: int, kinds: int, mu: tuple[float, float]) -> Trie:
    """The trie of a chunk whose counts are those of the whole corpus."""
    # every word ends nowhere or is a context as often as it occurs
    p = (g.counts[0] + 1) / (total + kinds + 1)
    backoff = lambda k, m: np.log10(m / (g.counts[k] + m))
    kept = np.flatnonzero(g.counts[0])
    number = np.cumsum(g.counts[0] > 0) - 1
    words = number
    trie = Trie(g.names[kept], np.minimum(np.log10(p[kept]), 0), backoff(0, mu[0])[kept])
    for k in (0, 1):
        context = g.counts[k][g.parent[k]]
        # of a longer n-gram, the order below is the n-gram without its first word
        below = p[g.word[k]] if k == 0 else p[g.shorter]
        p = (g.counts[k + 1] + mu[k] * below) / (context + mu[k])
        kept = np.flatnonzero(g.counts[k + 1])
        more = backoff(1, mu[1])[kept] if k == 0 else None
        trie.add_level(number[g.parent[k][kept]], words[g.word[k][kept]], np.log10(p[kept]), more)
        number = np.cumsum(g.counts[k + 1] > 0) - 1
    return trie


def token_scores(g: Grams, trie: Trie, unknown: float) -> np.ndarray:
    """log10 p of each token of the chunk; 0 at the starts of texts."""
    found = [trie.words.find(g.names)]
    for k in (0, 1):
        found.append(trie.levels[k].child(found[k][g.parent[k]], found[0][g.word[k]]))
    # a number of -1 (no n-gram ends here) picks the last entry; it is masked below
    place = [np.where(at >= 0, f[at] if len(f) else -1, -1) for f, at in zip(found, g.at, strict=True)]
    score = np.where(place[0] >= 0, trie.log_p[np.maximum(place[0], 0)] if len(trie.words) else 0.0, unknown)
    for k, level in enumerate(trie.levels):
        values = level.log_p if len(level.successors) else None
        weights = trie.log_backoff if k == 0 else trie.levels[0].log_backoff
        context = np.concatenate([[-1], place[k][:-1]])
        ends = g.at[k + 1] >= 0
        back = np.where(context >= 0, weights[np.maximum(context, 0)], 0.0) if len(weights.codes) else 0.0
        lower = score + back
        seen = values[np.maximum(place[k + 1], 0)] if values is not None else lower
        score = np.where(ends, np.where(place[k + 1] >= 0, seen, lower), score)
    score[g.first[:-1]] = 0
    return score


def _score(bits: int, wide: int, total: int, kinds: int, mu: tuple[float, float]):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        g = Grams(unpacked(chunk))
        g.counts[0] = values_for(answers, WORDS, bits)
        for k in (0, 1):
            own = g.held_elsewhere(k, wide, answers, bits)
            g.counts[k + 1][own] = values_for(answers, COUNTED[k] << bits, bits)
        g.find_shorter()
        n = np.diff(g.first) - 1
        sums_of = lambda x: np.add.reduceat(x, g.first[:-1])  # noqa: E731  every text has a start
        starts = g.first[:-1]
        single, known = np.log10(g.counts[0] + 1)[g.at[0]], (g.counts[0] > 0)[g.at[0]].astype(np.int64)
        single[starts] = known[starts] = 0
        score = token_scores(g, chunk_trie(g, total, kinds, mu), -np.log10(total + kinds + 1))
        return pa.table(
            {
                "doc_id": g.rows["doc_id"],
                "n_tokens": pa.array(n),
                "n_known": pa.array(sums_of(known)),
                "base_score": pa.array(sums_of(single) - n * np.log10(total + kinds + 1)),
                "score": pa.array(sums_of(score)),
            }
        )

    return run


def lm_scores(docs: DataFrame, mu: tuple[float, float] = (MU_2, MU_3)) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = steady(docs)
    size = text_bytes(docs)
    grams = size // BYTES_A_WORD
    bits, wide = bucket_bits(grams), offer_bits(grams)
    docs = docs.select("doc_id", "text", (~is_held_out()).alias("train"))
    base = dealt(docs)
    known = checkpointed(dealt(docs, work=_offer(bits, wide), schema=SCHEMA).groupBy("bucket").applyInArrow(lean(_answer(bits)), _KNOWN))
    total, kinds = (x or 0 for x in known.agg(F.sum("total"), F.sum("kinds")).first())
    known = known.drop("total", "kinds")
    asked = base.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(lean_pair(_count(bits, wide)), SCHEMA)
    counted = asked.groupBy("bucket").applyInArrow(lean(sums), ANSWER)
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    answers = known.union(counted).groupBy("chunk")
    out = base.groupBy("chunk").cogroup(answers).applyInArrow(lean_pair(_score(bits, wide, total, kinds, mu)), schema)
    return out.select("doc_id", is_held_out().alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))
