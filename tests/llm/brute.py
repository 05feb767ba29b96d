"""Plain re-statements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NULLS_LAST = lambda r: (r[0] is None, r[0] or 0, r[1:])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    text = text or ""
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
        ("hex", re.compile("[0-9a-f]+"), 0, 16),
    ]
    spans = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(kinds) for m in p.finditer(text) if len(m[g]) >= least]
    counts = Counter(k for _, k, _ in spans)
    return counts[0], counts[1], counts[2], sha(",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(spans)))


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = [False] * len(words)
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit[i : i + 3] = [True] * 3
    n, r = len(words), sum(hit)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, r, n < 50 or 100 * r > 50 * n


def substring(docs, width):
    first = {}
    for d, t in docs:
        words = WORD.findall(t or "")
        for i in range(len(words) - width + 1):
            if d is not None:
                key = tuple(words[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if d is not None and first[tuple(words[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out.append((d, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))))
    return sorted(out, key=NULLS_LAST)


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_roots(prints, bits=4):
    """Position of the first fingerprint reachable from each."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def language_model(docs, mu):
    tokens = lambda t: [*WORD.findall((t or "").translate(LOWER)), None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    one, grams = Counter(), Counter()
    for d, t in docs:
        if not held(d):
            w = ["<s>", *tokens(t)]
            one.update(w[1:])
            grams[("<s>",)] += 1
            grams.update((x,) for x in w[1:])
            grams.update(zip(w, w[1:], strict=False))
            grams.update(zip(w, w[1:], w[2:], strict=False))
    total, kinds = sum(one.values()), len(one)
    out = []
    for d, t in docs:
        w = ["<s>", *tokens(t)]
        p1 = [(one[x] + 1) / (total + kinds + 1) for x in w[1:]]
        score = 0.0
        for i, p in enumerate(p1, 1):
            p = (grams[w[i - 1], w[i]] + mu[0] * p) / (grams[w[i - 1],] + mu[0])
            if i > 1:
                p = (grams[tuple(w[i - 2 : i + 1])] + mu[1] * p) / (grams[w[i - 2], w[i - 1]] + mu[1])
            score += math.log10(p)
        out.append((d, held(d), len(p1), sum(one[x] > 0 for x in w[1:]), total, sum(map(math.log10, p1)), score))
    return sorted(out, key=NULLS_LAST)


def lines(docs, least=1):
    docs = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    flat = [(k, n, frozenset(WORD.findall(line))) for k, (d, t) in enumerate(docs) if d is not None for n, line in enumerate((t or "").split("\n"))]
    flat = [x for x in flat if len(x[2]) >= least]
    gone = {}
    for i, (k, n, s) in enumerate(flat):
        if any(9 * len(s & o) >= 4 * (len(s) + len(o)) for _, _, o in flat[:i]):
            gone.setdefault(k, set()).add(n)
    out = []
    for k, (d, t) in enumerate(docs):
        parts = (t or "").split("\n")
        out.append((d, len(parts) if t else 0, len(gone.get(k, ())), sha("\n".join(p for i, p in enumerate(parts) if i not in gone.get(k, ())))))
    return sorted(out, key=NULLS_LAST)


def contamination(docs, items, window=10):
    tokens = lambda t: ALNUM.findall((t or "").translate(LOWER))
    owners = {}
    for i, t in items:
        w = tokens(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            owners.setdefault(tuple(w[j : j + k]), set()).add(i)
    out = []
    for d, t in docs:
        w, found = tokens(t), set()
        hit = [False] * len(w)
        for k in {len(x) for x in owners}:
            for j in range(len(w) - k + 1):
                if own := owners.get(tuple(w[j : j + k])):
                    found |= own
                    hit[j : j + k] = [True] * k
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), sum(hit), len(ids), sha(",".join(ids)), any(hit)))
    return sorted(out, key=NULLS_LAST)


def fill_levels(sizes, weights=(5, 2, 1), cap=3):
    """Targets by repeated sharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: cap * sizes[s] for s in over})


def prefix_trie(rows):
    """Nodes over rows (conv_id, turn, role, text) whose turns do not tie."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(vs)] for c, vs in own.items()}
    whole = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved, out = Counter(), Counter(), []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = leaves[k] or 1
        if k:
            saved[k] += (len(members[k]) - 1) * len(k[-1][1].encode())
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if len(whole[c]) == len(k))
        out.append((m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(kids[k]), leaves[k], saved[k], sha(ends)))
    return sorted(out, key=lambda r: r[:2])


AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
LEGAL = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def cheapest_edits(turns):
    """(cost, audit) for turns (initial, fault: 0 sound, 1 truncated, 2 to be deleted): shortest path over whole audits."""
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, s = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(turns) and s in ("", "a"):
            return cost, audit
        heapq.heappush(heap, (cost + 5, audit + "I", i, AFTER[s]))
        if i < len(turns):
            x, fault = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, s))
            if fault < 2:
                heapq.heappush(heap, (cost + 1 + 5 * fault, audit + "R", i + 1, AFTER[s]))
                if (s, x) in LEGAL:
                    heapq.heappush(heap, (cost + 5 * fault, audit + "K", i + 1, x))


def repaired(rows):
    """Rows of operator 12 for (conv_id, turn, role, text) whose turns do not tie."""
    convs = {}
    spaced = lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        turns = convs.setdefault(c, [])
        kind = zlib.crc32(f"{spaced(c)}:{spaced(t)}".encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", spaced(x)) if kind == 2 else spaced(x)
        r = "user" if kind == 4 else spaced(r)
        turns += [(t is not None, t or 0, r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for c, turns in convs.items():
        turns.sort()
        seen, codes, n = set(), [], Counter()
        for *_, r, x in turns:
            words = WORD.findall(x)
            fault = "blank" if not words else "duplicate" if (r, x) in seen else "truncated" if words[-1][-1] not in ".!?" else ""
            seen.add((r, x))
            n[fault] += 1
            codes.append((r[:1] if r[:1] in ("s", "u", "a") else "x", {"": 0, "truncated": 1}.get(fault, 2)))
        at = [t for known, t, _, _ in turns if known]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit = cheapest_edits(codes)
        state, kept, rest = "", [], iter(turns)
        for step in audit:
            role, text = ("", "") if step == "I" else next(rest)[2:]
            if step != "D":
                state = role[0] if step == "K" else AFTER[state]
                kept.append((role if step == "K" else {"u": "user", "a": "assistant"}[state]) + ":" + text)
        out.append((c, max(at) - min(at) + 1 - len(set(at)) if at else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha("\n".join(kept))))
    return sorted(out, key=NULLS_LAST)


def top_products(rows, k=5, every=50):
    """Rows of operator 13 for (vec_id, vector), in unbounded integers."""
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, x) in enumerate(sound):
        if i is not None and i % every == 0:
            scores = [(-max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(x, y, strict=True)))), j is None, j or 0) for b, (j, y) in enumerate(sound) if b != a and len(y) == len(x)]
            out += [(i, rank + 1, None if unnamed else j, -s) for rank, (s, unnamed, j) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=by_rank)


def by_rank(r):
    return r[0], r[1], r[3], r[2] is None, r[2] or 0


def gram_scores(docs, trusted, cells=1 << 16, evidence=1 << 15, smoothing=0.05):
    """Scores of operator 2 for (id, text), by the mean log ratio of hashed byte 4-grams."""

    def grams(text):
        b = (text or "").encode()
        codes = (((b[i] * 257 + b[i + 1]) * 257 + b[i + 2]) * 257 + b[i + 3] for i in range(len(b) - 3))
        return [(c % 2**32 * 0x9E3779B1) % 2**32 // (2**32 // cells) for c in codes]

    raw, target = Counter(), Counter()
    for d, t in docs:
        raw.update(grams(t))
        if d is not None and d in trusted:
            target.update(grams(t))
    size = max(1, sum(raw.values()))
    prior = max(1.0, smoothing * size / cells)
    n = sum(target.values())
    ratio = lambda c: math.log(((target[c] * (size / evidence) + raw[c]) / (n / evidence + 1) if n else raw[c]) + prior) - math.log(raw[c] + prior)
    out = []
    for d, t in docs:
        own = grams(t)
        out.append((d, sum(map(ratio, own)) / len(own) if own else 0.0))
    return out


def url_cells(host, path, cells=2048, sizes=(3, 4, 5)):
    """Cells of operator 7: hashed n-grams, the kind's hash as seed of the gram's."""
    return [
        xxhash.xxh64_intdigest(text[i : i + n].encode(), xxhash.xxh64_intdigest(kind.encode(), 42)) % cells
        for kind, text in (("h", f"^{host}$"), ("p", f"{path}$")) for n in sizes for i in range(len(text) - n + 1)
    ]


def url_weights(rows, rounds, rate, decay, cells=2048):
    """(weights, bias) of logistic regression on rows (cells, label), by sums over rows."""
    weights, bias = [0.0] * cells, 0.0
    rows = [(Counter(c), 1 / math.sqrt(max(len(c), 1)), y) for c, y in rows]
    for _ in range(rounds):
        step, total = [0.0] * cells, 0.0
        for own, unit, y in rows:
            error = 1 / (1 + math.exp(-(sum(weights[c] * k for c, k in own.items()) * unit + bias))) - y
            error /= len(rows)
            total += error
            for c, k in own.items():
                step[c] += error * k * unit
        weights = [w - rate * (s + decay * w) for w, s in zip(weights, step, strict=True)]
        bias -= rate * total
    return weights, bias


def chain_ascent(docs, steps, rate, decay):
    """(emit, move) of operator 10's chain on docs (rows of scaled features, label), by enumeration of all labellings."""
    width = len(docs[0][0][0])
    emit, move = [0.0] * width, [[0.0, 0.0], [0.0, 0.0]]
    speed_e, speed_m = [0.0] * width, [[0.0, 0.0], [0.0, 0.0]]
    for _ in range(steps):
        step_e, step_m = [0.0] * width, [[0.0, 0.0], [0.0, 0.0]]
        for rows, label in docs:
            n = len(rows)
            weights = {}
            for code in range(2**n):
                y = [code >> k & 1 for k in range(n)]
                weights[tuple(y)] = math.exp(sum(sum(e * f for e, f in zip(emit, x, strict=True)) for x, v in zip(rows, y, strict=True) if v) + sum(move[a][b] for a, b in zip(y, y[1:], strict=False)))
            z = sum(weights.values())
            for k, x in enumerate(rows):
                p = sum(w for y, w in weights.items() if y[k]) / z
                for i, f in enumerate(x):
                    step_e[i] += f * (label - p) / n
                if k:
                    step_m[label][label] += 1 / n
                    for y, w in weights.items():
                        step_m[y[k - 1]][y[k]] -= w / z / n
        total = len(docs)
        for i in range(width):
            speed_e[i] = 0.9 * speed_e[i] + step_e[i] / total - decay * emit[i]
            emit[i] += rate * speed_e[i]
        for a in (0, 1):
            for b in (0, 1):
                speed_m[a][b] = 0.9 * speed_m[a][b] + step_m[a][b] / total - decay * move[a][b]
                move[a][b] += rate * speed_m[a][b]
    return emit, move


def pipeline(docs, trusted, items, weights=(5, 2, 1)):
    """Rows (doc_id, text, source, copies) of the pipeline for docs (doc_id, text, source) of different ids."""
    # quality rules
    score = dict(gram_scores([d[:2] for d in docs], trusted))
    docs = [d for d in docs if not base_rules(d[1])[-1] and score[d[0]] >= -0.5]
    # line dedup
    docs.sort()
    seen, kept = [], []
    for d, t, s in docs:
        out = []
        for line in (t or "").split("\n"):
            words = frozenset(WORD.findall(line))
            if words and any(9 * len(words & o) >= 4 * (len(words) + len(o)) for o in seen):
                seen.append(words)
                continue
            if words:
                seen.append(words)
            out.append(line)
        kept.append((d, "\n".join(out), s))
    # near duplicates: the first document of each component
    roots = component_roots([fingerprint(t) for _, t, _ in kept])
    docs = [x for k, x in enumerate(kept) if roots[k] == k]
    # benchmark passages
    owners = set()
    for t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        owners |= {tuple(w[j : j + min(10, len(w))]) for j in range(len(w) - min(10, len(w)) + 1) if w}
    kept = []
    for d, t, s in docs:
        places = list(ALNUM.finditer(t.translate(LOWER)))
        w, hit = [m[0] for m in places], [False] * len(places)
        for k in {len(x) for x in owners}:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in owners:
                    hit[j : j + k] = [True] * k
        if any(hit) and sum(hit) >= 0.5 * len(w):
            continue
        parts, at, j = [], 0, 0
        while j < len(w):
            if hit[j]:
                parts.append(t[at : places[j].start()])
                while j < len(w) and hit[j]:
                    at = places[j].end()
                    j += 1
            j += 1
        kept.append((d, "".join([*parts, t[at:]]), s))
    # copies
    unit = 1.0 / (1 << 53)
    of = lambda data, seed: xxhash.xxh64_intdigest(data, seed)
    seeded = lambda seed: of(seed.to_bytes(4, "little"), 42)
    size = {d: len(WORD.findall(t)) for d, t, _ in kept}
    sizes = Counter()
    for d, _, s in kept:
        sizes[s] += size[d]
    targets, out = fill_levels(sizes, weights), []
    for s in sizes:
        rate = min(targets[s] / sizes[s], 3.0)
        whole = math.floor(rate + 1e-12)
        own = sorted((((of(t.encode(), of(d.to_bytes(8, "little"), seeded(20240229)))) >> 11) * unit, d, t) for d, t, x in kept if x == s)
        wanted, before, extra = (rate - whole) * sizes[s], 0, set()
        if rate > whole:
            chance = (of(s.encode(), seeded(20240230)) >> 11) * unit
            for _, d, _ in own:
                if before + size[d] < wanted or chance < (wanted - before) / size[d]:
                    extra.add(d)
                before += size[d]
                if before >= wanted:
                    break
        out += [(d, t, s, whole + (d in extra)) for _, d, t in own]
    return sorted(r for r in out if r[3])
