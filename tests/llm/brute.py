"""Plain re-implementations that the corpus operators are compared with."""

from __future__ import annotations

import re
from collections import defaultdict


def shingle_set(text: str | None, size: int) -> frozenset:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(size)]))


def components(texts: dict[int, str | None], size: int, similarity: int) -> dict[int, int]:
    """Smallest reachable id of every id, over all pairs that share a shingle."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    for i, s in sets.items():
        shared = defaultdict(int)
        for shingle in s:
            for j in holders[shingle]:
                if j < i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= similarity * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in texts}
