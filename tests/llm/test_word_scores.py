"""Word scores against dictionaries, on odd rows, small tables, and one text repeated."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from tests.llm.brute import spaced
from tests.llm.test_operators import SCHEMA, key, pairs, rows
from tidemark.llm import word_scores as module
from tidemark.llm.queries import QUERIES
from tidemark.llm.word_scores import word_scores


def backoff(docs, order=3, alpha=0.4, least=2):
    """Log scores by document under word grams, counted in dictionaries."""
    texts = [(i, spaced(t, True)) for i, t in docs]
    grams = Counter(
        tuple(w[k - n : k]) for _, w in texts for k in range(1, len(w) + 1)
        for n in range(min(k, order) + 1)
    )
    out = []
    for i, w in texts:
        score = 0.0
        for k in range(1, len(w) + 1):
            longest = min(k, order)
            for n in range(longest, 0, -1):
                gram = tuple(w[k - n : k])
                if grams[gram] >= least:
                    score += math.log(grams[gram] / grams[gram[:-1]] * alpha ** (longest - n))
                    break
            else:
                score += math.log(alpha**longest / grams[()])
        out.append((i, len(w), score))
    return out


def agree(frame):
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in word_scores(frame).collect()), key=key)
    want = sorted(backoff(pairs(frame)), key=key)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(a[2] == pytest.approx(b[2], abs=1e-6, rel=1e-9) for a, b in zip(got, want))


@pytest.mark.parametrize("size", [32 << 20, 2000])
def test_words(spark, sf_dir, monkeypatch, size):
    monkeypatch.setattr(module, "BUCKET_BYTES", size)
    monkeypatch.setattr(module, "PART_BYTES", size)
    monkeypatch.setattr(module, "CHUNK", size)
    agree(spark.createDataFrame(rows(), SCHEMA).repartition(3).cache())
    agree(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_empty(spark):
    assert word_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    agree(spark.createDataFrame([(1, None), (2, "one")], "doc_id long, text string"))


def test_the_query_scores_words(spark, sf_dir):
    got = QUERIES["op10_lm_scores"](spark, sf_dir).select("doc_id", "n_words", "log_score").collect()
    want = {i: (n, s) for i, n, s in
            backoff(pairs(spark.read.parquet(f"{sf_dir}/documents.parquet")))}
    assert len(got) == len(want)
    assert all(n == want[i][0] and s == pytest.approx(want[i][1]) for i, n, s in got)


def test_repeated_rows_spread_over_buckets(spark, monkeypatch):
    """Rows of one text, of one id or none, are no larger a bucket than others."""
    monkeypatch.setattr(module, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(module, "PART_BYTES", 20_000)
    text = "the same words again and again " * 20
    docs = [(None, text)] * 200 + [(1, text)] * 200 + [(2, "other words"), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2).cache()
    # A piece of small batches, as chunks are cut within one.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        agree(frame)
        packed = frame.mapInArrow(module._pack, module.PACKED).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r.bucket for r in packed}) == len(packed) > 10
    assert all(r.bytes <= 20_000 for r in packed)
    assert sum(len(r.doc_id) for r in packed) == len(docs)
