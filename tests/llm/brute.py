"""Plain Python versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class UnionFind:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, n):
    w = WORD.findall((text or "").translate(FOLD))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def jaccard_components(sets, percent):
    """Smallest reachable key of each key, over an inverted index of all elements."""
    uf, index = UnionFind(), defaultdict(list)
    for k, s in sets.items():
        uf.find(k)
        shared = defaultdict(int)
        for e in s:
            for other in index[e]:
                shared[other] += 1
            index[e].append(k)
        for other, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[other]) - both):
                uf.join(k, other)
    return {k: uf.find(k) for k in sets}


def line_sets(line, k):
    u = line.encode("utf-16-be")
    n = max(len(u) // 2 - k + 1, 1)
    return frozenset(u[2 * i : 2 * (i + k)] for i in range(n))


def smallest_capacity(sizes, n):
    lo, hi = 0, sum(sizes)

    def need(cap):
        shards, left = 0, 0
        for s in sizes:
            if s > cap:
                return n + 1
            if s > left:
                shards, left = shards + 1, cap
            left -= s
        return shards

    while lo < hi:
        mid = (lo + hi) // 2
        if need(mid) <= n:
            hi = mid
        else:
            lo = mid + 1
    return lo
