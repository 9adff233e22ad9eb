"""Plain versions that the tests hold results against."""

import re


def shingles(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, a):
        self.parent.setdefault(a, a)
        while self.parent[a] != a:
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def brute_force(texts):
    """``doc -> (size, component)``, comparing every pair of distinct sets that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    by_set = {}
    for i, s in sets.items():
        by_set.setdefault(s, []).append(i)
    union, holders = Union(), {}
    for s, ids in by_set.items():
        for i in ids if s else []:
            union.join(ids[0], i)
        for token in s:
            holders.setdefault(token, []).append(s)
    seen = set()
    for group in holders.values():
        for k, a in enumerate(group):
            for b in group[:k]:
                if (id(a), id(b)) not in seen:
                    seen.add((id(a), id(b)))
                    if 100 * len(a & b) >= 75 * len(a | b):
                        union.join(by_set[a][0], by_set[b][0])
    return {i: (len(s), union.find(i)) for i, s in sets.items()}
