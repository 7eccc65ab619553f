"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def spaced(text, lower=False):
    return SPACED.findall((text or "").translate(LOWER) if lower else text or "")


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def shingles(text, width):
    w = spaced(text, True)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def components(rows, width, num, den):
    """{doc_id: smallest reachable id} over rows (doc_id, text)."""
    nodes = [(i, shingles(t, width)) for i, t in rows if i is not None]
    root = {i: i for i, _ in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(nodes):
        for j, b in nodes[:k]:
            both = len(a & b)
            if both and den * both >= num * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in nodes}


def repeats(rows):
    """Per row (doc_id, text): bytes, removed, spans and the digest of the rest."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        edges = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), edges, hashlib.sha256(rest).hexdigest()))
    return out


def contamination(rows, items):
    windows = {}
    for name, text in items:
        w = alnum(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if name is None else str(name))
    lengths = {len(x) for x in windows}
    out = []
    for i, text in rows:
        w = alnum(text)
        hit, named = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    named |= found
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def rule_counts(text):
    w = spaced(text)
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = {p for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w),
    )


def places(text, phrases):
    w = alnum(text)
    found = []
    for phrase, label in phrases.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    return len(w), sorted(found)
