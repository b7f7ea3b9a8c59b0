"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


def leaks(docs, items, window=10):
    """[(n_words, n_hit, item ids)] by trying every window at every place."""
    windows = {}
    for item_id, text in items:
        w = words(text, WORD)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows.setdefault(size, {}).setdefault(tuple(w[i : i + size]), set()).add(str(item_id))
    out = []
    for text in docs:
        w = words(text, WORD)
        hit, found = [False] * len(w), set()
        for size, known in windows.items():
            for i in range(len(w) - size + 1):
                ids = known.get(tuple(w[i : i + size]))
                if ids:
                    found |= ids
                    hit[i : i + size] = [True] * size
        out.append((len(w), sum(hit), sorted(found)))
    return out


def items_digest(ids):
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def shingles(text, n=5):
    w = words(text, TOKEN)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def link_classes(rows, n=5, percent=75):
    """{doc_id: (set size, smallest linked doc_id)} over all pairs."""
    sets = {i: shingles(t, n) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    having = {}
    for i, s in sets.items():
        for g in s:
            having.setdefault(g, []).append(i)
    pairs = {p for ids in having.values() for p in combinations(ids, 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}
