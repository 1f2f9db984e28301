"""Plain single-machine versions that the operators are held against."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(sets, percent=75):
    """Least key reachable over pairs of sets that meet the percentage."""
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for k in sorted(sets):
        for s in sets[k]:
            where[s].append(k)
    both = Counter()
    for ks in where.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1:]:
                both[a, b] += 1
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in sets}


def repeated_words(texts, size=50):
    """Words of each text inside a window of ``size`` words that occurs at two places."""
    places = defaultdict(list)
    for k, t in enumerate(texts):
        w = WORD.findall(t or "")
        for i in range(len(w) - size + 1):
            places[tuple(w[i:i + size])].append((k, i))
    out = defaultdict(set)
    for ps in places.values():
        if len(ps) > 1:
            for k, i in ps:
                out[k].update(range(i, i + size))
    return out


def edits_within(item, text, most):
    """Least edits of ``item`` against any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)
