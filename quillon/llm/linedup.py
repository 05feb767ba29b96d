"""Operator 6: line dedup by an exact set-similarity join.

A line is the set of its words; lines of at least ``least`` different words are
joined where their Jaccard similarity reaches 0.8, and of every such pair the later
line (by doc_id, then line) is removed.  Pairs are judged on the input, so a
removed line still removes later ones.  Every line that has a word is joined
unless a caller asks for longer ones.

Tokens are ordered by rarity: by their count in a table of fixed length over the
whole corpus, then by hash.  The order is total and the same for every line,
which is all that exactness needs.  The first n - ceil(0.8 n) + 1 tokens of a
line are its prefix; similar lines share one.  Round one deals prefix tokens to
shards, where length and positional filters and a parity bitmap of the tokens
discard pairs, and tells which lines have a partner left (not which pairs).  A
pair counts only at the first of several tokens that it shares in a row.

A token that more than ``HOT`` lines may hold is no key by itself.  Similar lines
share ceil(0.8 n) tokens, the first k of them within the first
n - ceil(0.8 n) + k, so a line deals the hot token together with each token that
may be the next shared one, and so on while the expected number of lines (counts
multiplied as if independent) stays above ``HOT``.  ``DEEPEST`` bounds how many
tokens a line of n words joins to a key; lines up to 5/4 beyond a bound deal both
forms, as their partners may be on either side of it.
Round two sends the whole token sets of those lines only, and verifies.  Equal
sets are joined apart, by their hash; sets of fewer than ``JOINED`` words have no
other partners.  Nothing but a line's own verdict leaves a
shard, so a group of many similar lines makes no pairs.

Sets are verified on 64-bit hashes of their words, equal sets by 96 bits: two
different lines of 25 words would have to meet in a word's hash (probability
about 3e-17 a pair), or in 96 bits.  The rank order needs 47 bits only; words that
fall together there are ordered by the rest.

Cases: a null text has no lines; a very long text or line takes memory in
proportion to its length; lines of fewer different words always stay, as
do rows of a null doc_id; of rows that repeat a doc_id the second counts as the
later one; a document may lose all its lines and then has an empty text; an
empty table gives no rows; ``dedup_documents`` carries further columns unchanged,
the query ignores them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clusterio import chunk_count, lean, lean_pair, read, shielded, summed_vectors, text_bytes
from .exchange import bucket_bits, pack48, received, send, sized_pack, sized_unpack, unpack48
from .textcore import U64, blocks, mix, slice_hashes, words_of

MIN_TOKENS = 1
#: Least size of a set that can be similar to another: 4 of 5 words are Jaccard 0.8.
JOINED = 4
RANK_BITS, HASH_BITS = 18, 29
ID_BITS = RANK_BITS + HASH_BITS
#: Lines with more tokens than this use both words of the bitmap.
WIDE = 70
#: Groups of one token up to this size are joined in blocks of pairs at once.
SMALL_RUN, VERIFY_RUN, PAIR_BLOCK = 4096, 64, 1 << 20
BYTES_A_KEY = 36
#: Lines expected under one key above which the key takes a further token.
HOT = 1 << 16
#: Greatest number of words of a line that may join a second, third and fourth token.
DEEPEST = (40, 20, 10)


def overlap(a, b):
    """Least intersection of sets of these sizes at Jaccard 4/5."""
    return (4 * (a + b) + 8) // 9


def prefix(n):
    return n - (4 * n + 4) // 5 + 1


def token_ranks(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each hash cell by its count over the whole corpus; the counts by rank, then the number of lines."""
    cells = 1 << RANK_BITS

    def count(batches):
        total = np.zeros(cells + 1, np.int64)
        for batch in batches:
            for b in blocks(batch.column("text")):
                w = words_of(b)
                h = slice_hashes(b.data, w.starts, w.ends)
                total[:cells] += np.bincount((h >> U64(64 - RANK_BITS)).astype(np.int64), minlength=cells)
                total[cells] += len(b.offsets) - 1 + np.count_nonzero(b.data == 10)
        return total

    counts = summed_vectors(docs.select("text"), count, cells + 1)
    order = np.argsort(counts[:cells], kind="stable")
    ranks = np.empty(cells, U64)
    ranks[order] = np.arange(cells, dtype=U64)
    return ranks, np.append(counts[order], counts[cells]).astype(np.float32)


def ordered(chunk: pa.Table) -> pa.Table:
    """Rows by doc_id (nulls last), equal ids by text: the order of lines."""
    return chunk.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()


class Lines:
    """Distinct token sets of a chunk's lines, each with its first line."""

    def __init__(self, rows: pa.Table, ranks: np.ndarray, least: int):
        known = len(rows) - rows["doc_id"].null_count
        sets, words, sizes, docs, numbers = [], [], [], [], []
        for b in blocks(rows["text"]):
            w = words_of(b)
            if not len(w.starts):
                continue
            h = slice_hashes(b.data, w.starts, w.ends)
            ids = (ranks[(h >> U64(64 - RANK_BITS)).astype(np.int64)] << U64(HASH_BITS)) | (h & U64((1 << HASH_BITS) - 1))
            # a line ends at a newline or with its document; lines are numbered over the block
            edges = np.union1d(b.offsets[1:-1], np.flatnonzero(b.data == 10) + 1)
            line = np.searchsorted(edges, w.starts, side="right")
            first_line = np.searchsorted(edges, b.offsets[:-1], side="right")
            for low in range(0, int(line[-1]) + 1, 1 << (64 - ID_BITS)):
                s, e = np.searchsorted(line, [low, low + (1 << (64 - ID_BITS))])
                if s == e:
                    continue
                key = ((line[s:e] - low).astype(U64) << U64(ID_BITS)) | ids[s:e]
                order = np.argsort(key)
                key, word = key[order], h[s:e][order]
                same = key[1:] == key[:-1]
                if (word[1:][same] != word[:-1][same]).any():  # two words of one rank and 29 equal bits
                    order = np.lexsort((word, key))
                    key, word = key[order], word[order]
                    same = key[1:] == key[:-1]
                new = np.concatenate([[True], ~same | (word[1:] != word[:-1])])
                key, word = key[new], word[new]
                own = (key >> U64(ID_BITS)).astype(np.int64)
                at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                n = np.diff(np.append(at, len(own)))
                number = own[at] + low
                doc = np.searchsorted(first_line, number, side="right") - 1
                keep = (n >= least) & (doc + b.first_row < known)
                sets.append((key & U64((1 << ID_BITS) - 1))[np.repeat(keep, n)])
                words.append(word[np.repeat(keep, n)])
                sizes.append(n[keep])
                docs.append(doc[keep] + b.first_row)
                numbers.append((number - first_line[doc])[keep])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        flat, word, n = join(sets, U64), join(words, U64), join(sizes, np.int64)
        self.doc, self.number = join(docs, np.int64), join(numbers, np.int64)
        first = np.concatenate([[0], np.cumsum(n)])
        sign, check = (self._of_sets(mix(word ^ U64(salt)), first, n) for salt in (1, 0x5851F42D4C957F2D))
        # lines come in order, so the first of equal sets is the earliest
        self.sign, self.lead, inverse = np.unique(sign, return_index=True, return_inverse=True)
        self.repeats = np.flatnonzero(self.lead[inverse] != np.arange(len(sign)))
        self.n = n[self.lead]
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        pick = np.repeat(first[self.lead] - self.first[:-1], self.n) + np.arange(self.first[-1])
        self.flat, self.word = flat[pick], word[pick]
        self.check = (check[self.lead] >> U64(32)).astype(np.uint32)

    @staticmethod
    def _of_sets(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A hash of each set, whatever the order of its members."""
        total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
        return mix(total[first[1:]] - total[first[:-1]] + n.astype(U64))

    def bitmaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Parity of the tokens per bit of 128; small sets fold both words."""
        spread = mix(self.flat)
        bit = U64(1) << (spread & U64(63))
        high = (spread >> U64(6)) & U64(1)
        if not len(self.flat):
            return bit, bit
        one = np.bitwise_xor.reduceat(np.where(high == 0, bit, U64(0)), self.first[:-1])
        two = np.bitwise_xor.reduceat(np.where(high == 1, bit, U64(0)), self.first[:-1])
        small = self.n <= WIDE
        return np.where(small, one ^ two, one), np.where(small, U64(0), two)


_ASK = "shard int, chunk int, first long, gaps binary, data binary, lines binary, sizes binary, more binary"
_ASK_NAMES = [x.split()[0] for x in _ASK.split(", ")]


def _shard_rows(chunk: int, shard: np.ndarray, token: np.ndarray, row) -> dict[str, list]:
    """One row per shard of entries sorted by (shard, token)."""
    out: dict[str, list] = {k: [] for k in _ASK_NAMES}
    bounds = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out["shard"].append(int(shard[s]))
        out["chunk"].append(chunk)
        out["first"].append(int(token[s]))
        out["gaps"].append(pack48(np.diff(token[s:e])))
        for k, v in row(s, e).items():
            out[k].append(v)
    return out


def _as_table(out: dict[str, list]) -> pa.Table:
    kinds = {"shard": pa.int32(), "chunk": pa.int32(), "first": pa.int64()}
    n = len(out["shard"])
    return pa.table({k: pa.array(out[k] or [None] * n, kinds.get(k, pa.binary())) for k in _ASK_NAMES})


def _spread(token: np.ndarray, bits: int) -> np.ndarray:
    return ((token & U64((1 << HASH_BITS) - 1)) >> U64(HASH_BITS - bits)).astype(np.int64)


def _keys(x: Lines, counts: np.ndarray | None, hot: int) -> tuple[np.ndarray, ...]:
    """Line, place, key and preceding token's hash of each line's prefix keys.

    A key of k tokens stands k - 1 places before its last one: so many of the
    tokens up to there are shared.
    """
    p = np.where(x.n >= JOINED, prefix(x.n), 0)
    line = np.repeat(np.arange(len(x.n)), p)
    place = np.arange(int(p.sum())) - np.repeat(np.cumsum(p) - p, p)
    key = x.flat[x.first[line] + place]
    before = x.flat[np.maximum(x.first[line] + place - 1, 0)]
    before = np.where(place > 0, (mix(before) >> U64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0)).astype(np.uint32)
    if counts is None:
        return line, place, key, before
    count = counts[:-1].astype(np.float64)
    share = np.minimum(count / max(float(counts[-1]), 1.0), 1.0)
    expected = count[(key >> U64(HASH_BITS)).astype(np.int64)]
    done = []
    for depth, most in enumerate(DEEPEST, 1):
        n = x.n[line]
        stays = (expected <= hot) | (n > most)
        goes = np.flatnonzero((expected > hot) & (4 * n <= 5 * most))
        done.append((line[stays], place[stays] - (depth - 1), key[stays], before[stays]))
        room = p[line[goes]] + depth - 1 - place[goes]
        own = np.repeat(goes, room)
        line, key, before, expected = line[own], key[own], before[own], expected[own]
        place = place[own] + 1 + np.arange(len(own)) - np.repeat(np.cumsum(room) - room, room)
        token = x.flat[x.first[line] + place]
        key = mix(mix(key) ^ token) >> U64(64 - ID_BITS)
        expected = expected * share[(token >> U64(HASH_BITS)).astype(np.int64)]
    done.append((line, place - len(DEEPEST), key, before))
    return tuple(np.concatenate(c) for c in zip(*done, strict=True))


def _ask_first(ranks, bits: int, least: int = MIN_TOKENS, counts=None, hot: int = HOT):
    """Round one: set hashes (shards below 2**bits) and prefix keys (above)."""

    def run(chunk: pa.Table) -> pa.Table:
        rows, number = ordered(chunk), chunk["chunk"][0].as_py()
        x = Lines(rows, ranks.value, least)
        ids = rows["doc_id"].fill_null(0).to_numpy()
        same = send(number, x.sign, ids[x.doc[x.lead]], bits, more=x.check)
        out = {"shard": same["bucket"].to_pylist()} | {k: same[k].to_pylist() for k in ("chunk", "first", "gaps", "data", "more")}
        same = _as_table(out | {k: [] for k in ("lines", "sizes")})
        line, place, token, before = _keys(x, None if counts is None else counts.value, hot)
        shard = _spread(token, bits)
        order = np.lexsort((token, shard))
        line, place, token, before, shard = line[order], place[order], token[order], before[order], shard[order]
        one, two = x.bitmaps()
        n, check = x.n[line], (x.sign[line] >> U64(32)).astype(np.uint32)

        def row(s: int, e: int) -> dict[str, bytes]:
            own = line[s:e]
            wide = own[n[s:e] > WIDE]
            return {
                "data": sized_pack(place[s:e]),
                "lines": sized_pack(own),
                "sizes": sized_pack(n[s:e]),
                "more": one[own].tobytes() + check[s:e].tobytes() + before[s:e].tobytes() + two[wide].tobytes(),
            }

        return pa.concat_tables([same, _as_table(_shard_rows(number, shard + (1 << bits), token, row))])

    return run


def _tokens(first: int, gaps: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.array([first]).astype(U64), unpack48(gaps)]), dtype=U64)


_TELL = "chunk int, kind int, keys binary, lines binary"


def _told(chunk: np.ndarray, kind: int, keys: np.ndarray, lines: np.ndarray) -> pa.Table:
    """One row per chunk of its keys and lines."""
    order = np.argsort(chunk, kind="stable")
    chunk, keys, lines = chunk[order], keys[order], lines[order]
    at = np.flatnonzero(np.diff(chunk, prepend=-1))
    cut = list(zip(at.tolist(), [*at[1:].tolist(), len(chunk)], strict=True)) if len(chunk) else []
    return pa.table(
        {
            "chunk": pa.array(chunk[at], pa.int32()),
            "kind": pa.array([kind] * len(cut), pa.int32()),
            "keys": pa.array([keys[s:e].tobytes() for s, e in cut], pa.binary()),
            "lines": pa.array([lines[s:e].astype(np.int64).tobytes() for s, e in cut], pa.binary()),
        }
    )


def _equal_sets(rows: pa.Table) -> pa.Table:
    """Set hashes whose first line lies in an earlier document elsewhere."""
    keys, ids, origin = received(rows)
    check = np.frombuffer(b"".join(rows["more"].to_pylist()), np.uint32)
    order = np.lexsort((ids, check, keys))
    k, c = keys[order], check[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
    late = order[ids[order][np.flatnonzero(new)][np.cumsum(new) - 1] < ids[order]]
    return _told(rows["chunk"].to_numpy()[origin[late]], 0, keys[late], np.zeros(len(late), np.int64))


class Entries:
    """Prefix keys of a shard, sorted by (key, size)."""

    def __init__(self, rows: pa.Table):
        parts = []
        for chunk, first, gaps, data, lines, sizes, more in zip(*(rows[k].to_pylist() for k in ("chunk", "first", "gaps", "data", "lines", "sizes", "more")), strict=True):
            token, n = _tokens(first, gaps), sized_unpack(sizes)
            size = len(token)
            two = np.zeros(size, U64)
            two[n > WIDE] = np.frombuffer(more[16 * size :], U64)
            parts.append((token, n, sized_unpack(data), sized_unpack(lines), np.frombuffer(more, U64, size), np.frombuffer(more, np.uint32, size, 8 * size), np.frombuffer(more, np.uint32, size, 12 * size), two, np.full(size, chunk, np.int32)))
        token, n, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((n, token))
        self.token, self.n = token[order], n[order]
        self.place, self.line, self.one, self.check, self.before, self.two, self.chunk = (x[order] for x in rest)

    def pass_filters(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of entries of one token may be similar and not equal."""
        na, nb = self.n[a], self.n[b]
        need = overlap(na, nb)
        ok = np.flatnonzero((na - self.place[a] >= need) & (nb - self.place[b] >= need))
        a, b, most = a[ok], b[ok], (na + nb - 2 * need)[ok]
        ones = self.one[a] ^ self.one[b]
        twos = self.two[a] ^ self.two[b]
        wide = (self.n[a] > WIDE) & (self.n[b] > WIDE)
        apart = np.where(wide, np.bitwise_count(ones).astype(np.int64) + np.bitwise_count(twos), np.bitwise_count(ones ^ twos))
        equal = (ones == 0) & (twos == 0) & (self.check[a] == self.check[b]) & (self.n[a] == self.n[b])
        # a pair that shares the token before, too, was found there
        earlier = (self.before[a] == self.before[b]) & (self.before[a] != 0)
        return ok[(apart <= most) & ~equal & ~earlier]


def _partners(rows: pa.Table) -> pa.Table:
    """Lines with a partner that the filters leave, and the token they share."""
    e = Entries(rows)
    size = len(e.token)
    new = np.concatenate([[True], e.token[1:] != e.token[:-1]])
    run = np.cumsum(new) - 1
    key = (run << 32) | e.n
    # the smaller set of a pair shares a token early on; only such entries are partners
    index = np.flatnonzero(e.place <= e.n - overlap(e.n, e.n))
    keys = key[index]
    low = np.searchsorted(keys, (run << 32) | ((4 * e.n + 4) // 5))
    # the place of the shared token bounds the partner's size from above
    most = np.minimum(e.n, 9 * (e.n - e.place) // 4 - e.n)
    high = np.searchsorted(keys, (run << 32) | np.maximum(most, 0), side="right")
    flagged = np.zeros(size, bool)
    sizes = np.bincount(run)
    small = (sizes <= SMALL_RUN)[run]
    count = np.where(small, np.maximum(high - low, 0), 0)
    total = np.cumsum(count)
    begin = 0
    while begin < size:
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIR_BLOCK, side="right")))
        c = count[begin:end]
        a = np.repeat(np.arange(begin, end), c)
        b = index[np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(low[begin:end], c)]
        ok = e.pass_filters(a, b)
        flagged[a[ok]] = flagged[b[ok]] = True
        begin = end
    starts = np.flatnonzero(new)
    early = np.zeros(size, bool)
    early[index] = True
    for r in np.flatnonzero(sizes > SMALL_RUN):
        # an entry that has a partner leaves the search; it still serves as one
        s, t = int(starts[r]), int(starts[r] + sizes[r])
        n = e.n[s:t]
        for i in range(s, t):
            if flagged[i]:
                continue
            # smaller or equal partners by the index; larger ones are any entries, if this one is of the index
            b = index[low[i] : max(low[i], high[i])]
            if early[i]:
                lo, hi = np.searchsorted(n, [e.n[i] + 1, (5 * e.n[i]) // 4 + 1])
                b = np.concatenate([b[b != i], np.arange(s + lo, s + hi)])
            ok = e.pass_filters(np.full(len(b), i), b)
            if len(ok):
                flagged[i] = True
                flagged[b[ok]] = True
    got = np.flatnonzero(flagged)
    return _told(e.chunk[got], 1, e.token[got], e.line[got])


def _answer_first(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        return _equal_sets(rows) if rows["shard"][0].as_py() < 1 << bits else _partners(rows)

    return run


def _ask_second(ranks, bits: int, least: int = MIN_TOKENS):
    """Round two: token sets of lines with partners, and what is settled."""

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        rows = ordered(chunk)
        if not len(rows):
            return _as_table({k: [] for k in _ASK_NAMES})
        number = chunk["chunk"][0].as_py()
        x = Lines(rows, ranks.value, least)
        ids = rows["doc_id"].fill_null(0).to_numpy()
        kinds = told["kind"].to_numpy()
        pick = lambda name, kind, dtype: np.concatenate([np.zeros(0, dtype), *(np.frombuffer(v.as_py(), dtype) for v, k in zip(told[name], kinds, strict=True) if k == kind)])
        gone = np.zeros(len(x.sign), bool)
        late = pick("keys", 0, U64)
        gone[np.searchsorted(x.sign, late)] = True
        lost = np.concatenate([x.repeats, x.lead[gone]])
        settled = {k: [] for k in _ASK_NAMES} | {"shard": [-1 - number], "chunk": [number], "data": [x.doc[lost].tobytes()], "lines": [x.number[lost].tobytes()]}
        settled = _as_table({k: v or [None] for k, v in settled.items()})
        token, line = pick("keys", 1, U64), pick("lines", 1, np.int64)
        live = ~gone[line]
        token, line = token[live], line[live]
        shard = _spread(token, bits)
        order = np.lexsort((line, token, shard))
        token, line, shard = token[order], line[order], shard[order]
        # a line counts once under a key, even if two of its keys were equal
        once = np.concatenate([[True], (token[1:] != token[:-1]) | (line[1:] != line[:-1])])[: len(token)]
        token, line, shard = token[once], line[once], shard[once]
        doc, no = x.doc[x.lead], x.number[x.lead]

        def row(s: int, e: int) -> dict[str, bytes]:
            own = line[s:e]
            words = np.concatenate([x.word[x.first[i] : x.first[i + 1]] for i in own])
            docs, numbers = sized_pack(doc[own]), sized_pack(no[own])
            return {
                "data": sized_pack(ids[doc[own]]),
                "lines": len(docs).to_bytes(4, "little") + docs + numbers,
                "sizes": sized_pack(x.n[own]),
                "more": words.tobytes(),
            }

        return pa.concat_tables([settled, _as_table(_shard_rows(number, shard, token, row))])

    return run


def _verify(rows: pa.Table) -> pa.Table:
    """Verified later lines of each shard; settled rows are passed on."""
    if rows["shard"][0].as_py() < 0:
        return pa.table({"chunk": rows["chunk"], "docs": rows["data"], "lines": rows["lines"]})
    parts = []
    for chunk, first, gaps, data, lines, sizes, more in zip(*(rows[k].to_pylist() for k in ("chunk", "first", "gaps", "data", "lines", "sizes", "more")), strict=True):
        token = _tokens(first, gaps)
        cut = 4 + int.from_bytes(lines[:4], "little")
        parts.append((token, sized_unpack(data), sized_unpack(lines[4:cut]), sized_unpack(lines[cut:]), sized_unpack(sizes), np.full(len(token), chunk, np.int32), np.frombuffer(more, U64)))
    *cols, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
    token, ids, doc, no, n, chunk = cols
    first = np.concatenate([[0], np.cumsum(n)])
    # words by number: a pair of lines and a word then fit one key
    flat = np.unique(flat, return_inverse=True)[1].astype(U64)
    order = np.lexsort((no, doc, ids, token))
    starts = np.flatnonzero(np.concatenate([[True], token[order][1:] != token[order][:-1]]))
    sizes = np.diff(np.append(starts, len(order)))
    gone = np.zeros(len(order), bool)
    at = np.arange(len(order))
    back = np.where((sizes <= VERIFY_RUN)[np.repeat(np.arange(len(sizes)), sizes)], at - np.repeat(starts, sizes), 0)
    begin, total = 0, np.cumsum(back * (n[order] + 1))
    while begin < len(order):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIR_BLOCK, side="right")))
        c = back[begin:end]
        later = np.repeat(at[begin:end], c)
        earlier = later - 1 - (np.arange(len(later)) - np.repeat(np.cumsum(c) - c, c))
        a, b = order[later], order[earlier]
        fit = 5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])
        a, b = a[fit], b[fit]
        gone[a[_common(flat, first, a, b) >= overlap(n[a], n[b])]] = True
        begin = end
    for r in np.flatnonzero(sizes > VERIFY_RUN):
        own = order[starts[r] : starts[r] + sizes[r]]
        left = np.arange(1, len(own))  # later lines not yet removed
        for i in range(len(own)):
            left = left[left > i]
            if not len(left):
                break
            a = own[left]
            hit = _common(flat, first, a, np.full(len(a), own[i])) >= overlap(n[a], n[own[i]])
            gone[a[hit]] = True
            left = left[~hit]
    got = np.flatnonzero(gone)
    table = _told(chunk[got], 0, doc[got].astype(np.int64), no[got])
    return pa.table({"chunk": table["chunk"], "docs": table["keys"], "lines": table["lines"]})


def _common(flat: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets a[i] and b[i]."""
    if not len(a):
        return np.zeros(0, np.int64)
    out = np.zeros(len(a), np.int64)
    step = 1 << 14
    for s in range(0, len(a), step):
        both = np.concatenate([a[s : s + step], b[s : s + step]])
        n = first[both + 1] - first[both]
        pick = np.repeat(first[both] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pair = np.repeat(np.concatenate([np.arange(len(both) // 2)] * 2), n)
        key = np.sort((pair.astype(U64) << U64(48)) | flat[pick])
        twice = key[1:][key[1:] == key[:-1]] >> U64(48)
        out[s : s + step] = np.bincount(twice.astype(np.int64), minlength=len(both) // 2)
    return out


_ADDED = [("n_lines", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType()), ("kept_sha256", T.StringType())]


def _cut(names: list[str]):
    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        rows = ordered(chunk)
        docs = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(v.as_py(), np.int64) for v in told["docs"])])
        lines = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(v.as_py(), np.int64) for v in told["lines"])])
        gone: dict[int, set[int]] = {}
        for d, n in zip(docs.tolist(), lines.tolist(), strict=True):
            gone.setdefault(d, set()).add(n)
        texts, counts = rows["text"].to_pylist(), []
        for i, text in enumerate(texts):
            parts = (text or "").split("\n")
            counts.append((len(parts) if text else 0, len(gone.get(i, ()))))
            if i in gone:
                texts[i] = "\n".join(p for k, p in enumerate(parts) if k not in gone[i])
        digests = [hashlib.sha256((t or "").encode("utf-8")).hexdigest() for t in texts]
        out = {k: rows[k] for k in names}
        out |= {"n_lines": pa.array([c[0] for c in counts], pa.int64()), "n_removed": pa.array([c[1] for c in counts], pa.int64())}
        return pa.table(out | {"kept_text": pa.array(texts, pa.string()), "kept_sha256": pa.array(digests, pa.string())})

    return run


def line_dedup(docs: DataFrame, least: int = MIN_TOKENS, hot: int = HOT) -> DataFrame:
    """``docs`` without text, plus n_lines, n_removed, kept_text, kept_sha256.

    ``hot`` moves work between keys; the result does not depend on it.
    """
    docs = docs.drop("chunk", *(k for k, _ in _ADDED))
    size = text_bytes(docs)
    bits = bucket_bits(2 * size // BYTES_A_KEY)
    ranks, counts = (docs.sparkSession.sparkContext.broadcast(a) for a in token_ranks(docs))
    # all rows of one id in one chunk, so that chunks differ in their ids
    owner = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    base = docs.withColumn("chunk", F.pmod(owner, F.lit(chunk_count(size))).cast("int"))
    asked = base.groupBy("chunk").applyInArrow(lean(_ask_first(ranks, bits, least, counts, hot)), _ASK)
    told = asked.groupBy("shard").applyInArrow(lean(_answer_first(bits)), _TELL)
    again = base.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(lean_pair(_ask_second(ranks, bits, least)), _ASK)
    final = again.groupBy("shard").applyInArrow(lean(_verify), "chunk int, docs binary, lines binary")
    names = [f.name for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*(docs.schema[k] for k in names), *(T.StructField(k, t) for k, t in _ADDED)])
    return base.groupBy("chunk").cogroup(final.groupBy("chunk")).applyInArrow(lean_pair(_cut(names)), schema)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines taken out; every document and column stays.

    ``n_chars``, where there is one, follows the text.
    """

    def cut(plain: DataFrame) -> DataFrame:
        out = line_dedup(plain, least=1).withColumn("text", F.col("kept_text"))
        if "n_chars" in plain.columns:
            out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("kept_text").cast(plain.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
        return out

    return shielded(docs, ("doc_id", "text", "n_chars"), cut)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "kept_sha256")
