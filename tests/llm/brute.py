"""Plain versions of the operators, by definition and without Spark."""
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    count = [0] * 64
    for s in runs:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(runs))


def groups(fps, bits):
    """Component number by position, all pairs compared."""
    a, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= bits):
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def without_repeats(rows, window):
    """Sorted (id, words, removed, sha) by the window rule."""
    every = [words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + window]) for w in every for i in range(len(w) - window + 1))
    out = []
    for (k, _), w in zip(rows, every):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((k, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def base_spans(text):
    """Pattern spans kind:start:end with the lengths checked after matching."""
    word = "".join
    either = lambda s: word(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key")
    kinds = [(rf"""(?P<n>{names})["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""", 6), (r"(?P<v>AKIA[A-Z0-9]+)", 20),
             (r"(?P<v>[0-9a-f]+)", 24)]
    found = [(m.start(), k, m.end()) for k, (p, least) in enumerate(kinds) for m in re.finditer(p, text or "")
             if len(m["v"]) >= least]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def word_base(rows):
    """id -> (held out, tokens, known, training tokens, base score)."""
    every = [(k, words((t or "").translate(LOWER))) for k, t in rows]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2
    count = collections.Counter(x for k, w in every if not held(k) for x in [*w, None])
    total, distinct = sum(count.values()), len(count)
    return [(k, held(k), len(w) + 1, sum(x in count for x in [*w, None]), total,
             sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in [*w, None])) for k, w in every]


def tree_score(train, test, depth, share):
    """log10 probabilities by context-tree weighting as defined: the quotient of the weighted
    probabilities with and without each further bit."""
    def symbols(text):
        before = [255] * depth
        for c in [*text.encode().lower(), 255]:
            yield tuple(reversed(before[-depth:])), c
            before.append(c)

    data = [s for t in train for s in symbols(t)]
    least = math.ceil(len(data) / share)
    count = collections.Counter(c[:d] for c, _ in data for d in range(depth + 1))
    kept = {c for c, n in count.items() if n >= least}
    kids = collections.defaultdict(set)
    for c in kept - {()}:
        kids[c[:-1]] |= {c, c[:-1] + ("rest",)}

    def path(c):
        out = [()]
        for d in range(1, depth + 1):
            if c[:d] in kept:
                out.append(c[:d])
            else:
                out += [c[:d - 1] + ("rest",)] * (c[:d - 1] in kids)
                break
        return out

    seen = collections.defaultdict(lambda: [0, 0])

    def bits(symbol):
        v = 1
        for i in range(7, -1, -1):
            yield v, symbol >> i & 1
            v = 2 * v + (symbol >> i & 1)

    def weight(node, v):
        a, b = seen[node, v] if (node, v) in seen else (0, 0)
        own = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
        if node not in kids:
            return own
        return math.log(.5) + float(np.logaddexp(own, sum(weight(k, v) for k in kids[node])))

    for c, s in data:
        for v, bit in bits(s):
            for node in path(c):
                seen[node, v][bit] += 1
    out = []
    for t in test:
        total = 0.0
        for c, s in symbols(t):
            for v, bit in bits(s):
                before = weight((), v)
                for node in path(c):
                    seen[node, v][bit] += 1
                total += weight((), v) - before
                for node in path(c):
                    seen[node, v][bit] -= 1
        out.append(total / math.log(10))
    return out


def segments(scores):
    """Best segment (shortest on ties), then those left and right of it."""
    best = (0, 0, 0.0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > best[2] + 1e-9 or abs(s - best[2]) < 1e-9 and s > 0 and j - i < best[1] - best[0]:
                best = (i, j, s)
    if best[2] <= 0:
        return []
    i, j, _ = best
    return segments(scores[:i]) + [best] + [(a + j, b + j, s) for a, b, s in segments(scores[j:])]


def paragraphs(text):
    return set(re.findall(r"[^\n]{1,160}", text))


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def runs(ws, least=12):
    """(start, length, period) of every run, by definition: all stretches of each period."""
    n, best = len(ws), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and ws[i] == ws[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q - s), q)
    return sorted((s, m, q) for (s, m), q in best.items())


def collapsed(ws, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def planted(doc_id, text):
    ws, h = words(text), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(ws), h // 10
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def divergence(rows, least, top):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows, every term priced for every pair."""
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)) for t, _, _ in rows]
    out = []
    for lang in {g for _, g, _ in rows}:
        mine = [(s, ts) for (_, g, s), ts in zip(rows, terms) if g == lang]
        docs = collections.Counter(x for _, ts in mine for x in set(ts))
        kept = [x for x, n in docs.items() if n >= least]

        def shares(sources):
            n = collections.Counter(x for s, ts in mine for x in ts if s in sources)
            total = sum(n[x] for x in kept) + 5 * len(kept)
            return n, {x: 1 + 10**9 * (n[x] + 5) // total for x in kept}

        sources = {s for s, _ in mine}
        whole = shares(sources)[1]
        each = {s: shares({s}) for s in sources}
        for s in sources:
            n, p = each[s]
            pair = [(o, sum(abs(p[x] - each[o][1][x]) for x in kept)) for o in sources if o != s]
            term = [(x, p[x] - whole[x]) for x in kept if n[x] and p[x] > whole[x]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, x, v, i) for i, (x, v) in enumerate(found[:most], 1)]
    return out
