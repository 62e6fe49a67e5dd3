"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_duplicates(docs, words, percent):
    """{id: (set size, component)} for {id: text}."""
    sets = {}
    for i, t in docs.items():
        w = ASCII_WORD.findall(low(t))
        k = min(words, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    g = Groups(sets)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                g.join(a, b)
    return {i: (len(s), g.find(i)) for i, s in sets.items()}


def contamination(docs, items, window=10):
    """{id: (words, hit words, items)}."""
    windows = collections.defaultdict(set)
    for i, t in items:
        w = BENCH_WORD.findall(low(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[k:k + window])].add(i)
    lengths = {len(x) for x in windows}
    out = {}
    for i, t in docs.items():
        w, hit, found = BENCH_WORD.findall(low(t)), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out[i] = (len(w), len(hit), found)
    return out


def repeated_bytes(rows, length):
    """[(kept bytes, removed spans)] for a list of texts."""
    data = [(t or "").encode() for t in rows]
    count = collections.Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = set()
        for k in range(len(d) - length + 1):
            if count[d[k:k + length]] > 1:
                gone |= set(range(k, k + length))
        spans = [k for k in gone if k - 1 not in gone]
        out.append((bytes(b for k, b in enumerate(d) if k not in gone), len(spans), len(gone)))
    return out


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
