"""Operator 8: benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items build one automaton per block of at most about
``BLOCK_WORDS`` words, in a task of its own; a longer item is cut into pieces that
overlap by a window less one word, so no window is lost.  An automaton is a few
flat arrays: at most two states and three edges a word, about 11 MB a block.
``BLOCKS_A_PASS`` blocks are broadcast at a time; a larger benchmark makes more
passes.  Training tokens are streamed through the automaton, all runs of a block
of documents in step; at every token the longest matching length is known, and a
match of at least ``window`` tokens (or a whole shorter item) marks a span.  Tokens
that no item holds put the automaton back into its root, so they are skipped in
bulk, as are pairs of tokens that no item has side by side when every item has two
words.

Cases: a null text or item has no words; an item without words matches nothing;
an item of a null id marks words but is not listed; repeated rows get one result
each; with an empty benchmark nothing is hit; a very long text is streamed whole,
in memory in proportion to its length; no result depends on ties; an empty
documents table gives no rows; further columns are carried unchanged.  Words are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clusterio import checkpointed, read, shielded
from .textcore import ALNUM_WORD, LOWER, U64, Block, blocks, covered, slice_hashes, words_of

WINDOW = 10
#: Coverage (hit words over words) from which the whole document goes.
MAX_COVERAGE = 0.5
BLOCK_WORDS, BLOCKS_A_PASS = 1 << 17, 4


class _Growing:
    """A suffix automaton under construction; substrings never cross two sequences."""

    def __init__(self):
        self.length, self.link = [0], [-1]
        self.next: list[dict[int, int]] = [{}]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """The state of the shorter substrings of q that p reaches by token."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, tokens: list[int]) -> None:
        last = 0
        for t in tokens:
            if t in self.next[last]:
                last = self._split(last, t, self.next[last][t])
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and t not in self.next[p]:
                self.next[p][t] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, t, self.next[p][t])
            last = new


def _lists(keys: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each key below ``n``: where each key's begin, and all."""
    pairs = np.unique(np.stack([keys, values], axis=1), axis=0) if len(keys) else np.zeros((0, 2), np.int64)
    return np.searchsorted(pairs[:, 0], np.arange(n + 1)), pairs[:, 1]


def _listed(lists: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``keys``, value) for every value of every key."""
    first, values = lists
    n = first[keys + 1] - first[keys]
    at = np.repeat(np.arange(len(keys)), n)
    return at, values[np.repeat(first[keys], n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]


class SuffixAutomaton:
    """The substrings of several token sequences as flat arrays."""

    def __init__(self, sequences: list[tuple[int, list[int]]], window: int):
        """Sequences of (item, tokens); an item may have several."""
        self.window = window
        g = _Growing()
        for _, tokens in sequences:
            g.add(tokens)
        n = len(g.length)
        edges = np.array([(s << 32) | t for s, own in enumerate(g.next) for t in own], U64)
        targets = np.array([q for own in g.next for q in own.values()], np.int32)
        order = np.argsort(edges)
        self.edges, self.targets = edges[order], targets[order]
        self.length, self.link = np.array(g.length, np.int32), np.array(g.link, np.int32)
        windows, short = [], []
        for item, tokens in sequences:
            state = 0
            for k, t in enumerate(tokens, 1):
                state = g.next[state][t]
                if k >= window:
                    windows.append((state, item))
            if 0 < len(tokens) < window:
                short.append((state, len(tokens), item))
        del g
        # the state on the way to the root that holds the substring of a window's length
        self.window_state, self.short_up = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        has_short = np.zeros(n, bool)
        has_short[[s for s, _, _ in short]] = True
        for s in np.argsort(self.length, kind="stable").tolist():
            up = self.link[s]
            if self.length[s] >= window:
                self.window_state[s] = s if self.length[up] < window else self.window_state[up]
            # nearest state on that way, itself included, where a short item ends
            self.short_up[s] = s if has_short[s] else (self.short_up[up] if up >= 0 else -1)
        w = np.array(windows, np.int64).reshape(-1, 2)
        self.owners = _lists(self.window_state[w[:, 0]].astype(np.int64), w[:, 1], n)
        t = np.array(short, np.int64).reshape(-1, 3)
        self.short = _lists(t[:, 0], t[:, 2] * window + t[:, 1], n)

    def stream(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and longest matching length after each token of the runs
        ``first[i]:first[i + 1]``, all runs one token at a time."""
        states, matched = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        begin, ends = first[:-1][order], -sizes[order]
        state, length = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(ends, -step, side="left"))
            at = begin[:live] + step
            waiting = np.arange(live)
            while len(waiting):
                sought = (state[waiting].astype(U64) << U64(32)) | tokens[at[waiting]].astype(U64)
                place = np.minimum(np.searchsorted(self.edges, sought), len(self.edges) - 1)
                there = self.edges[place] == sought
                gone = waiting[there]
                state[gone] = self.targets[place[there]]
                length[gone] += 1
                waiting = waiting[~there]
                lost = waiting[state[waiting] == 0]
                length[lost] = 0
                waiting = waiting[state[waiting] > 0]
                state[waiting] = self.link[state[waiting]]
                length[waiting] = self.length[state[waiting]]
            states[at], matched[at] = state[:live], length[:live]
        return states, matched

    def matches(self, tokens: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, tuple]]:
        """(end, length, key, lists) of windows and whole short items; the lists
        tell the items of a key."""
        states, matched = self.stream(tokens, first)
        end = np.flatnonzero(matched >= self.window)
        out = [(end + 1, np.full(len(end), self.window), self.window_state[states[end]].astype(np.int64), self.owners)]
        place, up = np.arange(len(states)), self.short_up[states].astype(np.int64)
        while len(place := place[up > 0]):
            up = up[up > 0]
            at, code = _listed(self.short, up)
            size, item = code % self.window, code // self.window
            fits = size <= matched[place[at]]
            at, size, item = at[fits], size[fits], item[fits]
            every = (np.arange(int(item.max(initial=-1)) + 2), np.arange(int(item.max(initial=-1)) + 1))
            out.append((place[at] + 1, size, item, every))
            up = self.short_up[np.maximum(self.link[up], 0)].astype(np.int64)
        return out


class Index:
    """Vocabulary, neighbouring pairs and automaton of one block of pieces."""

    def __init__(self, pieces: list[tuple[str | None, np.ndarray]], window: int = WINDOW):
        """Pieces of (item id, word hashes)."""
        self.ids = sorted({x for x, _ in pieces if x is not None})
        number = {x: k for k, x in enumerate(self.ids)} | {None: len(self.ids)}
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, U64), *(h for _, h in pieces)]))
        coded = [(number[x], np.searchsorted(self.vocabulary, h)) for x, h in pieces if len(h)]
        self.shortest = min((min(len(s), window) for _, s in coded), default=window)
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(s[:-1] * len(self.vocabulary) + s[1:] for _, s in coded)]))
        self.automaton = SuffixAutomaton([(x, s.tolist()) for x, s in coded], window)

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start word, size) of all matches in a block, (document, item number) without repeats."""
        none = np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(hashes):
            return none, none, none, none
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        joined = known[:-1] & known[1:] & (doc[:-1] == doc[1:])
        inside = known
        if self.shortest >= 2:
            pair = at[:-1][joined] * len(self.vocabulary) + at[1:][joined]
            joined[joined] = np.isin(pair, self.pairs) if len(self.pairs) else False
            inside = np.zeros(len(hashes), bool)
            inside[:-1] |= joined
            inside[1:] |= joined
        places = np.flatnonzero(inside)
        if not len(places):
            return none, none, none, none
        # a run ends where the next token is not joined to this one
        cut = np.flatnonzero(~joined[places[:-1]] | (np.diff(places) > 1)) + 1
        bounds = np.concatenate([[0], cut, [len(places)]])
        run = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        places = places[(np.diff(bounds) >= self.shortest)[run]]
        run = run[(np.diff(bounds) >= self.shortest)[run]]
        begin = np.append(np.flatnonzero(np.diff(run, prepend=-1)), len(run))
        starts, sizes, owners = [none], [none], [np.zeros((0, 2), np.int64)]
        for end, size, key, lists in self.automaton.matches(at[places], begin):
            last = places[end - 1]
            starts.append(last + 1 - size)
            sizes.append(size)
            own = np.unique(np.stack([doc[last], key], axis=1), axis=0)
            which, item = _listed(lists, own[:, 1])
            owners.append(np.stack([own[which, 0], item], axis=1))
        owned = np.unique(np.concatenate(owners), axis=0)
        owned = owned[owned[:, 1] < len(self.ids)]
        return np.concatenate(starts), np.concatenate(sizes), owned[:, 0], owned[:, 1]


def indexes(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, index): the pickled index of each block of items, built by a task."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    words = items.agg(F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))).first()[0] or 0
    n = -(-words * 5 // (4 * block_words)) if words > block_words else 1
    piece = max(window, block_words // 8)

    def cut(batches):
        for batch in batches:
            ids, out = batch.column("item_id"), {"item_id": [], "part": [], "words": []}
            for b in blocks(batch.column("text")):
                h, w = _tokens(b)
                for i, (s, e) in enumerate(pairwise(w.first.tolist())):
                    for part, at in enumerate(range(s, max(e - window + 1, s + 1), piece)):
                        out["item_id"].append(ids[b.first_row + i].as_py())
                        out["part"].append(part)
                        out["words"].append(h[at : min(at + piece + window - 1, e)].tobytes())
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(out["item_id"], pa.string()), "part": pa.array(out["part"], pa.int32()), "words": pa.array(out["words"], pa.binary())})

    def build(rows: pa.Table) -> pa.Table:
        pieces = sorted(zip(rows["item_id"].to_pylist(), rows["words"].to_pylist(), strict=True), key=lambda x: (x[0] is None, x))
        index = Index([(x, np.frombuffer(h, U64)) for x, h in pieces], window)
        return pa.table({"block": rows["block"][:1], "index": pa.array([pickle.dumps(index)], pa.binary())})

    pieces = items.mapInArrow(cut, "item_id string, part int, words binary").filter(F.octet_length("words") > 0)
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "part", "words"), F.lit(n)).cast("int"))
    return keyed.groupBy("block").applyInArrow(build, "block int, index binary")


def _tokens(block: Block):
    low = Block(block.first_row, LOWER[block.data], block.offsets)
    w = words_of(low, ALNUM_WORD)
    return slice_hashes(low.data, w.starts, w.ends), w


_FIELDS = [("n_words", T.LongType()), ("span_start", T.ArrayType(T.LongType())), ("span_end", T.ArrayType(T.LongType())), ("items", T.ArrayType(T.StringType()))]


def _spans(hit: np.ndarray, first: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.concatenate([[0], hit[first[i] : first[i + 1]].astype(np.int8), [0]])
    edge = np.diff(own)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _mark(index, again: bool, cut: bool):
    """A mapInArrow function: one block of items over batches of documents."""

    def run(batches):
        held: list[Index] = [pickle.loads(x) for x in index.value]
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros(n, np.int64)
            spans: list[tuple] = [((), ())] * n
            items: list[list[str]] = [[] for _ in range(n)]
            texts: list[str | None] | None = batch.column("text").to_pylist() if cut else None
            for b in blocks(batch.column("text")):
                hashes, w = _tokens(b)
                counts[b.first_row : b.first_row + b.n] = w.counts
                found: dict[int, set[str]] = {}
                starts, sizes, rows = [], [], set()
                for idx in held:
                    start, size, doc, item = idx.hits(hashes, w.first)
                    starts += start.tolist()
                    sizes += size.tolist()
                    rows.update(np.unique(np.searchsorted(w.first, start, side="right") - 1).tolist())
                    for d, x in zip(doc.tolist(), item.tolist(), strict=True):
                        found.setdefault(d, set()).add(idx.ids[x])
                if again:
                    for i in range(b.n):
                        r = b.first_row + i
                        for s, e in zip(batch.column("span_start")[r].as_py(), batch.column("span_end")[r].as_py(), strict=True):
                            starts.append(int(w.first[i]) + s)
                            sizes.append(e - s)
                            rows.add(i)
                if not rows:
                    continue
                hit = covered(np.array(starts, np.int64), np.array(sizes, np.int64), len(hashes))
                for i in sorted(rows):
                    r = b.first_row + i
                    s, e = spans[r] = _spans(hit, w.first, i)
                    items[r] = sorted(found.get(i, set()).union(batch.column("items")[r].as_py() if again else ()))
                    if cut and len(s):
                        texts[r] = _without(b.raw(i), w, int(w.first[i]), int(b.offsets[i]), s, e)
            out = {name: batch.column(name) for name in batch.schema.names if name not in dict(_FIELDS)}
            if cut:
                out["clean_text"] = pa.array(texts, pa.string())
            out |= {
                "n_words": pa.array(counts),
                "span_start": pa.array([list(map(int, x[0])) for x in spans], pa.list_(pa.int64())),
                "span_end": pa.array([list(map(int, x[1])) for x in spans], pa.list_(pa.int64())),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_pydict(out)

    return run


def _without(raw: bytes, w, first: int, base: int, starts, ends) -> str:
    """The text with its hit spans cut out, from first to last word of each."""
    parts, at = [], 0
    for s, e in zip(starts, ends, strict=True):
        parts.append(raw[at : int(w.starts[first + s]) - base])
        at = int(w.ends[first + e - 1]) - base
    return b"".join([*parts, raw[at:]]).decode("utf-8")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cut: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (with text) plus n_words, span_start, span_end (words) and items.

    ``cut`` adds clean_text, the text without its spans.
    """
    spark = docs.sparkSession
    built = checkpointed(indexes(benchmark, window, block_words))
    numbers = sorted(r["block"] for r in built.select("block").collect())
    out = docs.drop(*dict(_FIELDS), "clean_text")
    for k in range(0, max(len(numbers), 1), BLOCKS_A_PASS):
        rows = built.filter(F.col("block").isin(numbers[k : k + BLOCKS_A_PASS])).orderBy("block").collect()
        fields = [f for f in out.schema.fields if f.name not in {*dict(_FIELDS), "clean_text"}]
        fields += [T.StructField("clean_text", T.StringType())] * cut + [T.StructField(a, b) for a, b in _FIELDS]
        index = spark.sparkContext.broadcast([bytes(r["index"]) for r in rows])
        out = out.drop("clean_text").mapInArrow(_mark(index, k > 0, cut), T.StructType(fields))
        if k + BLOCKS_A_PASS < len(numbers):
            # one pass a plan: its automata leave driver and workers before the next ones come
            out = checkpointed(out)
            index.unpersist()
    return out


def n_hit():
    return F.aggregate(F.zip_with("span_end", "span_start", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Documents with contaminated spans cut; above the coverage limit they go.

    All columns stay; ``n_chars``, where there is one, follows the text.
    """

    def cut(plain: DataFrame) -> DataFrame:
        out = contamination(plain, benchmark, window, cut=True).withColumn("n_hit", n_hit())
        out = out.filter((F.col("n_hit") == 0) | (F.col("n_hit") < F.lit(max_coverage) * F.col("n_words")))
        hit = F.col("n_hit") > 0
        if "n_chars" in plain.columns:
            out = out.withColumn("n_chars", F.when(hit, F.length("clean_text").cast(plain.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
        return out.withColumn("text", F.when(hit, F.col("clean_text")).otherwise(F.col("text")))

    return shielded(docs, ("doc_id", "text", "n_chars"), cut)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination(docs, read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
    )
