"""Slow and plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def suffix_dedup(rows, size):
    """rows: (doc_id, text). Returns (doc_id, n_bytes, n_removed, n_spans, sha) of each row."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, x in texts:
        for s in range(len(x) - size + 1):
            w = x[s : s + size]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, x in texts:
        gone = bytearray(len(x))
        for s in range(len(x) - size + 1):
            if first[x[s : s + size]] < i:
                gone[s : s + size] = b"\1" * size
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        out.append((i, len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def substring_dedup(rows, size):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[s : s + size]) for _, w in words for s in range(len(w) - size + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s : s + size])] > 1:
                gone[s : s + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, width):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


def near_duplicates(rows, width, percent):
    """(doc_id, n_shingles, component_id, kept) of each row; ids are distinct or their texts equal."""
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i), find(i) == i) for i, _ in rows]


def edit_distance_within(item, text):
    """Least edit distance of item to any substring of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
