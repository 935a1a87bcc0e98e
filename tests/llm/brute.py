"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def sha(b):
    return hashlib.sha256(b).hexdigest()


def by_text(rows):
    return sorted(rows, key=str)


class Union:
    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def join(self, a, b):
        self.p[self.find(a)] = self.find(b)

    def least(self, ids):
        groups = defaultdict(list)
        for n, i in enumerate(ids):
            groups[self.find(n)].append(i)
        out = []
        for n in range(len(ids)):
            known = [i for i in groups[self.find(n)] if i is not None]
            out.append(min(known) if known else None)
        return out


def window_dedup(docs, width=13):
    rank = lambda i: float("inf") if i is None else i
    split = [(i, WORD.findall((t or "").encode())) for i, t in docs]
    first = {}
    for i, w in split:
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, float("inf")), rank(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < rank(i):
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return by_text(out)


def decontaminate(docs, bench, width=10):
    windows = defaultdict(set)
    for i, t in bench:
        w = ALNUM.findall(lower(t))
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(i)
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t))
        hit, items = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k:k + n]))):
                    items |= found
                    hit[k:k + n] = [True] * n
        items = sorted(str(x) for x in items if x is not None)
        out.append((i, len(w), sum(hit), len(items), sha(",".join(items).encode()), any(hit)))
    return by_text(out)


def shingles(text, k):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard(docs, k=3, t=90):
    sets = [shingles(x, k) for _, x in docs]
    union, links = Union(len(docs)), [0] * len(docs)
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        shared = Counter(m for g in s for m in holders[g])
        for m, v in shared.items():
            if 100 * v >= t * (len(s) + len(sets[m]) - v):
                links[n] += 1
                links[m] += 1
                union.join(n, m)
        for g in s:
            holders[g].append(n)
    return by_text((i, len(s), n, c) for (i, _), s, n, c in zip(docs, sets, links, union.least([i for i, _ in docs])))
