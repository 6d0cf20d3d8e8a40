"""Plain versions of what the operators compute, for small tables only."""

from __future__ import annotations

import re

SPACES = " \t\n\x0b\f\r"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    w = words(folded(text))
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def near_duplicates(docs, size, percent):
    """docs: (doc_id, text); all pairs are compared."""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def repeat_words(text):
    w = words(text)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)})


def rule_counts(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n, r = len(w), repeat_words(text)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, r, n < 10 or 100 * r > 20 * n)
