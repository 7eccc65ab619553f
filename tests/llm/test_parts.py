"""Pieces of the operators that need no session."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm.jaccard_join import Signer, linked, plan_bands
from tidemark.llm.license_scan import TOKEN, evaluate, to_postfix
from tidemark.llm.mixing import min_cost_flow, targets
from tidemark.llm.suffix_dedup import SPAN, difference_cover, earlier


@pytest.mark.parametrize("num", [90, 80])
def test_similar_sets_share_a_signature(num):
    draw = np.random.default_rng(3)
    pool = draw.integers(1, 1 << 63, 5000, dtype=np.uint64)
    for frequent in (np.zeros(0, np.uint64), np.sort(pool[:4000])):
        signer = Signer(plan_bands(100_000, num, 100), frequent, num, 100)
        for n in (1, 2, 4, 5, 8, 9, 10, 19, 20, 40, 77, 150, 400, 1500):
            for _ in range(12):
                a = draw.choice(pool, n, replace=False)
                # As many shingles dropped and added as the threshold lets pass.
                out = draw.integers(0, n * (100 - num) // 100 + 1)
                b = np.r_[a[out:], draw.integers(1, 1 << 63, 1 + n // 8, dtype=np.uint64)]
                while 100 * (n - out) < num * (len(b) + out):
                    b = b[:-1]
                sets = [np.unique(a), np.unique(b)]
                sigs, row = signer.sign(np.concatenate(sets), np.array([len(x) for x in sets]))
                assert set(sigs[row == 0].tolist()) & set(sigs[row == 1].tolist())


def test_linked_is_exact():
    draw = np.random.default_rng(5)
    for _ in range(20):
        base = draw.integers(1, 1 << 60, 40, dtype=np.uint64)
        sets = []
        for _ in range(25):
            x = base.copy()
            x[: draw.integers(0, 6)] = draw.integers(1, 1 << 60, 1, dtype=np.uint64)
            sets.append(np.unique(np.r_[x, draw.integers(1, 1 << 60, draw.integers(0, 4), dtype=np.uint64)]))
        label = linked(np.concatenate(sets), np.array([len(x) for x in sets]), 90, 100)
        root = list(range(25))
        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                    old, new = root[i], root[j]
                    root = [new if r == old else r for r in root]
        assert len(set(zip(label.tolist(), root))) == len(set(root)) == len(set(label.tolist()))


@pytest.mark.parametrize("period", [7, 13, 16, 32])
def test_cover(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_earlier_is_exact():
    draw = np.random.default_rng(9)
    base = draw.integers(97, 100, 400).astype(np.uint8)
    text = np.concatenate([base, base[30:], base[:200], base[100:300]])
    at = np.arange(len(text) - SPAN + 1)
    doc = draw.integers(0, 5, len(at))
    bucket = text[at].astype(np.int64)
    first: dict = {}
    for p, d in zip(at.tolist(), doc.tolist()):
        s = text[p : p + SPAN].tobytes()
        first[s] = min(d, first.get(s, d))
    want = [first[text[p : p + SPAN].tobytes()] < d for p, d in zip(at.tolist(), doc.tolist())]
    assert earlier(text, at, bucket, doc).tolist() == want


def test_targets_stop_at_three_times():
    got = targets({"a": 10, "b": 100, "c": 0}, {"a": 5, "b": 2, "c": 1}, 110.0)
    assert got == {"a": 30.0, "c": 0.0, "b": 80.0}


def test_flow_prefers_fewer_repeats():
    # "x" can be served by either pattern; the shared one is spared for "y".
    supply = {"only x": (10, ["x"]), "both": (10, ["x", "y"])}
    assert min_cost_flow(supply, {"x": 10, "y": 10}) == {"only x": 10, "both": 10}
    repeated = min_cost_flow(supply, {"x": 15, "y": 10})  # either may be repeated, neither twice
    assert sum(repeated.values()) == 25 and all(10 <= n <= 15 for n in repeated.values())
    assert min_cost_flow(supply, {"x": 90, "y": 90}) == {"only x": 30, "both": 30}


def test_expressions():
    assert to_postfix("mit or gpl and apache".split()) == ["mit", "gpl", "apache", "and", "or"]
    assert to_postfix(["(", "mit", "or", "gpl", ")", "and", "isc"]) == [
        "mit", "gpl", "or", "isc", "and"
    ]
    assert to_postfix(["mit", "or"]) == ["mit"]
    assert evaluate(TOKEN.findall("gpl-2.0-only with classpath-exception-2.0 or mit")) == (
        {"gpl", "mit"}, 1.0
    )
    assert evaluate([]) == (set(), None)


def test_license_expression_goes_to_the_end_of_its_line():
    from tidemark.llm.license_scan import _automaton, scan

    text = "SPDX-License-Identifier: " + "MIT OR " * 100 + "ISC\nMPL-2.0"
    assert scan(text.encode(), _automaton())[5] == "isc,mit"
    twice = "SPDX-License-Identifier: MIT */ SPDX-License-Identifier: ISC"
    assert scan(twice.encode(), _automaton())[5] == "isc,mit"
