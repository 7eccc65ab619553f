"""Documents that share a passage meet, but meetings of unlike documents chain nothing."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import jaccard_join
from tidemark.llm.jaccard_join import jaccard_components, joinable, may_link, parities


def chain(n: int) -> list[tuple[int, str]]:
    """Each text shares three quarters with the next; every 25th has a copy with one more word."""
    draw = random.Random(5)
    passages = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(20)) for _ in range(n + 3)]
    texts = [(i, " ".join(passages[i : i + 4])) for i in range(n)]
    return texts + [(n + i, f"{t} more") for i, t in texts[::25]]


@pytest.mark.parametrize("limits", [{}, {"WIDE": 1, "MANY": 2, "PARITIES": 64}])
def test_unlike_documents_that_meet_are_not_verified(spark, monkeypatch, limits):
    monkeypatch.setattr(jaccard_join, "CELL_SHINGLES", 500)
    # A sample of a large table does not show passages of a few documents.
    monkeypatch.setattr(jaccard_join, "SAMPLE_DOCS", 0)
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    verified, verify = [], jaccard_join._verify

    def counted(ws, placed, *rest):
        verified.append(placed.count())
        return verify(ws, placed, *rest)

    monkeypatch.setattr(jaccard_join, "_verify", counted)
    rows = chain(300)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard_components(frame, 5, 80, 100).collect()}
    assert got == brute.components(rows, 5, 80, 100)
    if not limits:  # the copies and their originals, once
        assert sum(verified) == 2 * 12


def sets_of(seed: int):
    """Sets of sizes up to four times apart, near and far from a few others, with their sketches."""
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 63, (6, 400), dtype=np.uint64)
    sets = []
    for k in range(60):
        one = base[k % 6][: draw.integers(100, 400)] if k % 2 else base[k % 6]
        new = draw.integers(0, 1 << 63, draw.integers(0, 60), dtype=np.uint64)
        sets.append(np.unique(np.r_[one[len(new) // 2 :], new]))
    counts = np.array([len(s) for s in sets])
    flat, words = parities(np.concatenate(sets), counts)
    return sets, counts, flat, np.r_[0, np.cumsum(words)]


@pytest.mark.parametrize("num", [50, 80, 90])
def test_no_link_is_lost_to_sketches(num, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COMPARED", 100)
    sets, counts, flat, begin = sets_of(num)
    n = len(sets)
    root = np.arange(n) // 2  # some are joined already
    label = root.copy()
    for x, y in joinable(root, counts, flat, begin, num, 100):
        assert label[x] != label[y]
        label[label == label[y]] = label[x]
    passed = far = links = 0
    for x in range(n):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            link = 100 * both >= num * (counts[x] + counts[y] - both)
            a, b = (flat[begin[k] : begin[k + 1]][None] for k in (x, y))
            may = may_link(a, b, counts[[x]], counts[[y]], num, 100)[0]
            assert may or not link
            assert label[x] == label[y] or not may
            links += link
            far += both == 0
            passed += both == 0 and may
    assert links > 20 and far > 500 and 100 * passed < far
