"""Centroid clusters against a plain version in whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm.centroids import centroid_clusters, nearest, sequency, transform

SCHEMA = "vec_id long, embedding array<double>, cluster string, n int, distance string"


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    kept = [
        (i, v, [math.floor(x * scale) if abs(x) < 2**40 else int(x) * scale for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def draw(row):
        word = f"1:{'' if row[0] is None else row[0]}"
        return hashlib.sha256(word.encode()).hexdigest(), row[1]

    cents = [list(r[2]) for r in sorted(kept, key=draw)[:k]]

    def assign():
        out = []
        for _, _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        near = assign()
        for c in range(len(cents)):
            mine = [v for (_, _, v), (n, _) in zip(kept, near) if n == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    near = assign()
    top = 2**63 - 1
    sums = [sum(d for n, d in near if n == c) for c in range(len(cents))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(
        (
            (i, n, min(d, top), min(sums[n], top), min(sum(sums), top), digest[n])
            for (i, _, _), (n, d) in zip(kept, near)
        ),
        key=repr,
    )


def made(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "d") for r in rows], SCHEMA).repartition(3)


def odd_rows(n=120, spread=1.0):
    draw = random.Random(n)
    rows = [(k, [draw.gauss(0, spread) for _ in range(64)]) for k in range(n)]
    same = rows[5][1]
    rows += [(5, same), (900, same), (901, same), (None, same), (None, rows[7][1])]
    rows += [(902, None), (903, []), (904, same[:63]), (905, [*same, 1.0]), (906, [None, *same[1:]])]
    rows += [(907, [math.nan, *same[1:]]), (908, [-math.inf, *same[1:]]), (909, [0.0] * 64)]
    return rows


@pytest.mark.parametrize("rows", [odd_rows(), odd_rows(9), odd_rows(40, 1e6), odd_rows(30, 1e30)])
def test_clusters(spark, rows):
    got = centroid_clusters(made(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_other_widths(spark):
    draw = random.Random(1)
    rows = [(k, [draw.random() for _ in range(5)]) for k in range(60)]
    got = centroid_clusters(made(spark, rows), k=4, rounds=2, dims=5, scale=100)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 4, 2, 5, 100)


def test_no_vector(spark):
    assert centroid_clusters(made(spark, [])).collect() == []
    assert centroid_clusters(made(spark, [(1, None), (2, [1.0])])).collect() == []


def test_progressive_search_is_exact():
    draw = np.random.default_rng(3)
    vectors = draw.integers(-9, 10, (5000, 64))
    cents = np.concatenate([vectors[:7], vectors[:3], draw.integers(-9, 10, (20, 64))])
    number, distance = nearest(vectors, cents)
    far = ((vectors[:, None] - cents[None]) ** 2).sum(2)
    assert (number == far.argmin(1)).all() and (distance == far.min(1)).all()


def test_transform_keeps_distances():
    rows = np.random.default_rng(4).integers(-50, 50, (20, 64))
    seen = transform(rows)
    assert ((seen[:10] - seen[10:]) ** 2).sum() == 64 * ((rows[:10] - rows[10:]) ** 2).sum()
    assert (seen[:, 0] == rows.sum(1)).all()
    assert sorted(sequency(64)) == list(range(64))
