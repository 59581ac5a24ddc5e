"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingle_set(text, n=4):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def groups(nodes, links):
    """{node: smallest node that it reaches}"""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in nodes}


def near_duplicates(rows):
    """{doc_id: (n_shingles, component)} of (doc_id, text) rows with different ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = groups(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}


def dedup_lines(rows, least=20, docs=3):
    """[(doc_id, n_lines, n_dropped, kept)] of (doc_id, text) rows; every row is a document."""
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate(UPPER) for x in (t or "").split("\n")] for _, t in rows]
    held: dict = {}
    for (i, _), own in zip(rows, keys, strict=True):
        for k in {k for k in own if len(k) >= least}:
            held.setdefault(k, []).append(i)
    out = []
    for (i, t), own in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        gone = [
            len(held.get(k, ())) >= docs and (i is None or i < max(x for x in held[k] if x is not None))
            if any(x is not None for x in held.get(k, ()))
            else len(held.get(k, ())) >= docs
            for k in own
        ]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, len(lines), sum(gone), kept))
    return out


def repeated_bytes(rows, length=400):
    """[(doc_id, n_bytes, n_removed, n_spans, kept bytes)] of (doc_id, text) rows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen: dict = {}
    for _, t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
