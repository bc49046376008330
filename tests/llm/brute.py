"""Plain readings of the operators' rules, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def near_duplicates(docs, percent=85, width=5):
    """doc_id -> (n_shingles, component_id) of (doc_id, text) pairs."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeats(docs, width=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept bytes)."""
    first, out = {}, {}
    for i, text in sorted(docs, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if first.setdefault(raw[p : p + width], i) < i:
                gone[p : p + width] = b"\x01" * width
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1])), kept)
    return out


def mixed(docs, weights=(3, 1, 2), share=1.5, epochs=2, seed=0):
    """One (doc_id, size, source_size, target, taken) for each (doc_id, text, source), by clamping and resharing in rounds."""
    sizes = [(i, len(WORD.findall(t or "")), s) for i, t, s in docs]
    names = sorted({s for _, _, s in sizes}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for _, n, x in sizes if x == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = {}, share * sum(total.values()), list(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= epochs * total[s]]
        for s in over or open_:
            target[s] = min(epochs * total[s], level * weight[s])
            left -= target[s] if over else 0
        open_ = [s for s in open_ if s not in over] if over else []
    out = []
    for s in names:
        whole = int(target[s]) // total[s] if total[s] else 0
        extra = int(target[s] + 1e-9) - whole * total[s]
        for _, i, n in sorted((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i, n) for i, n, x in sizes if x == s):
            part = max(0, min(n, extra))
            extra -= part
            out.append((i, n, total[s], target[s], whole * n + part))
    return out


def folded(text):
    out = " "
    for c in (text or "") + " ":
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        if c != " " or out[-1] != " ":
            out += c
    return out


class KneserNey:
    """Interpolated Kneser-Ney over dictionaries, one language."""

    def __init__(self, texts, alphabet, order=5):
        grams = Counter()
        for t in texts:
            s = folded(t)[1:]
            padded = " " * (order - 1) + s
            for i in range(len(s)):
                grams[padded[i : i + order]] += 1
        self.counts = {order: grams}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.discount, self.total, self.types = {}, defaultdict(Counter), defaultdict(Counter)
        for n, c in self.counts.items():
            ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            self.discount[n] = min(0.9, max(0.1, (ones + 0.5) / (ones + 2 * twos + 1.0)))
            for g, v in c.items():
                self.total[n][g[:-1]] += v
                self.types[n][g[:-1]] += 1
        self.base, self.order = 1 / alphabet, order

    def p(self, gram):
        if not gram:
            return self.base
        n, context = len(gram), gram[:-1]
        if not self.total[n][context]:
            return self.p(gram[1:])
        d = self.discount[n]
        return max(self.counts[n][gram] - d, 0) / self.total[n][context] + d * self.types[n][context] / self.total[n][context] * self.p(gram[1:])

    def entropy(self, text):
        s = folded(text)[1:]
        padded = " " * (self.order - 1) + s
        return -sum(math.log(self.p(padded[i : i + self.order])) for i in range(len(s))) / max(1, len(s))
