"""More sources than the driver holds: the same mix from tables."""

from __future__ import annotations

import pytest

from tests.llm.test_operators import SCHEMA, key, rows
from tidemark.llm import mixing


@pytest.mark.parametrize("weights", [None, "own"])
def test_more_sources_than_the_driver_holds(spark, monkeypatch, weights):
    odd = rows() + [
        (100 + k, "w " * (3 * k % 50 + (900 if k == 7 else 0)), None, f"web{k}.\u00e9", *([None] * 10))
        for k in range(40)
    ]
    odd = spark.createDataFrame(odd, SCHEMA).repartition(3).cache()
    if weights:
        names = [r.source for r in odd.select("source").distinct().collect()]
        weights = {s: 1 + len(s or "") * k % 7 for k, s in enumerate(names)}
    want = sorted(map(tuple, mixing.mix_sources(odd, weights=weights).collect()), key=key)
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 5)
    got = sorted(map(tuple, mixing.mix_sources(odd, weights=weights).collect()), key=key)
    assert got == want and any(r[4] for r in got)


def test_rows_without_an_id_spread_over_buckets(spark):
    """A third of all rows may have no id: they are drawn by their texts, not all as one."""
    rows = [(None if k % 3 else k, "w " * (k % 7 + 1) + str(k), "s") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert docs.select(mixing.draw_order(1)).distinct().count() == 600
    got = mixing.mix_sources(docs, weights={"s": 1.0})
    sizes = sorted(r.size for r in got.collect())
    assert sizes == sorted(len(t.split()) for _, t, _ in rows)
    again = mixing.mix_sources(docs.repartition(5), weights={"s": 1.0})
    key = sorted((repr(r.doc_id), r.size, r.taken) for r in got.collect())
    assert key == sorted((repr(r.doc_id), r.size, r.taken) for r in again.collect())
