"""Language profiles, the positive-unlabelled fit, and licence labels against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_operators import SCHEMA, key, rows
from tidemark.llm import language_id, pu_quality
from tidemark.llm.language_id import identify
from tidemark.llm.license_scan import (
    BASE_PHRASES,
    FREEDOM,
    MORE_PHRASES,
    identifier_label,
    license_scan,
)


def plain_grams(text):
    """Counts of a text's n-grams of letters, a blank at either end of each word."""
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        found.update(word)
        framed = f" {word} "
        found.update(framed[k : k + 2] for k in range(len(framed) - 1))
        found.update(g for k in range(len(framed) - 2) if (g := framed[k : k + 3])[0] + g[2] != "  ")
    return found


def number(gram):
    out = len(gram) << 60
    for k, c in enumerate(reversed(gram)):
        out |= (0 if c == " " else ord(c)) << (16 * k)
    return out


def plain_profile(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:size]


def plain_languages(docs, size):
    """(doc_id, language, score) by out-of-place distances, as the method states them."""
    by_lang = {}
    for i, text, lang in docs:
        held = i is not None and zlib.crc32(str(i).encode()) % 3 == 1
        if lang is not None and text is not None and not held:
            by_lang.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {x: plain_profile(c, size) for x, c in sorted(by_lang.items())}
    out = []
    for i, text, _ in docs:
        own = plain_profile(plain_grams(text or ""), size)
        if not own or not profiles:
            out.append((i, "und", 0.0))
            continue
        far = {
            x: sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(own))
            for x, p in profiles.items()
        }
        best = min(far, key=lambda x: (far[x], x))
        bar = min((d for x, d in far.items() if x != best), default=size * len(own))
        out.append((i, best, 1 - far[best] / bar if bar else 0.0))
    return out


@pytest.mark.parametrize("size, block", [(300, 1 << 20), (40, 50)])
def test_languages_by_out_of_place_distance(spark, monkeypatch, size, block):
    monkeypatch.setattr(language_id, "PROFILE", size)
    monkeypatch.setattr(language_id, "BLOCK", block)
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = spark.createDataFrame(rows(), SCHEMA)
    for frame, cut in ((table, None), (small.orderBy("doc_id").limit(60), 400)):
        docs = [(r.doc_id, r.text if cut is None else r.text and r.text[:cut], r.lang)
                for r in frame.collect()]
        made = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
        got = [(r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(made).collect()]
        want = [(i, x, round(s, 9)) for i, x, s in plain_languages(docs, size)]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_blocks_end_between_words(monkeypatch):
    monkeypatch.setattr(language_id, "BLOCK", 7)
    for text in ["", "abc", "one two three four", "a" * 50, "x " + "b" * 30 + " c", "über straße 12"]:
        parts = list(language_id.blocks(text))
        assert "".join(parts) == text
        assert all(not (a[-1:].isalpha() and b[:1].isalpha()) for a, b in zip(parts, parts[1:]))


def risk(model, weight, bias, positive, unlabelled, prior):
    """The non-negative unbiased risk, with the penalty of the fit."""
    def margins(rows_):
        return np.array([weight[list(r)].sum() + bias for r in model.place(rows_)])

    def loss(z):
        return np.log1p(np.exp(-z))

    p, u = margins(positive), margins(unlabelled)
    negative = loss(-u).mean() - prior * loss(-p).mean()
    return prior * loss(p).mean() + max(0.0, negative), negative


@pytest.mark.parametrize("prior", [0.3, 0.6])
def test_the_first_step_goes_down_the_risk(monkeypatch, prior):
    monkeypatch.setattr(pu_quality, "STEPS", 1)
    draw = np.random.default_rng(4)
    positive, unlabelled = draw.normal(1, 1, (60, 3)), draw.normal(0, 1, (200, 3))
    model = pu_quality.Additive(np.concatenate([positive, unlabelled]))
    start = model.weight.copy()
    _, negative = risk(model, start, 0.0, positive, unlabelled, prior)
    assert negative > 0  # so the step is that of the whole risk
    slope = np.zeros(len(start))
    for k in range(len(start)):
        up, down = start.copy(), start.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        slope[k] = (risk(model, up, 0.0, positive, unlabelled, prior)[0]
                    - risk(model, down, 0.0, positive, unlabelled, prior)[0]) / 2e-5
    model.fit(positive, unlabelled, prior)
    clear = np.abs(slope) > 1e-6
    assert clear.any() and (np.sign(start - model.weight)[clear] == np.sign(slope)[clear]).all()


def test_the_fit_lowers_the_risk():
    draw = np.random.default_rng(5)
    positive, unlabelled = draw.normal(1, 1, (300, 3)), np.concatenate(
        [draw.normal(1, 1, (300, 3)), draw.normal(-1, 1, (700, 3))])
    model = pu_quality.Additive(np.concatenate([positive, unlabelled]))
    before, _ = risk(model, model.weight, 0.0, positive, unlabelled, 0.3)
    model.fit(positive, unlabelled, 0.3)
    after, _ = risk(model, model.weight, model.bias, positive, unlabelled, 0.3)
    assert after < 0.7 * before
    margins = [model.weight[list(r)].sum() + model.bias for r in model.place(unlabelled)]
    assert np.allclose(model.score(unlabelled), 1 / (1 + np.exp(-np.array(margins))))
    assert abs(pu_quality.estimate_prior(positive, unlabelled) - 0.3) < 0.12


@pytest.mark.parametrize("name, label", [
    ("mit", "mit"), ("mitre-1", "mitre-1"), ("mit-0", "mit"), ("apache-2.0", "apache"),
    ("gpl-3.0-or-later", "gpl"), ("gplv2", "gpl"), ("lgpl-2.1+", "lgpl"), ("cc0-1.0", "public-domain"),
    ("cc-by-4.0", "cc"), ("ccx", "ccx"), ("iscsi", "iscsi"), ("bsd-3-clause", "bsd"), ("foo+", "foo"),
])
def test_identifiers_are_whole(name, label):
    assert identifier_label(name) == label


def test_licence_labels_and_scores(spark):
    phrases = {**BASE_PHRASES, **MORE_PHRASES}
    texts = [f"some words, {p.upper()}; more" for p in phrases]
    texts += ["mit license or bsd license", "SPDX-License-Identifier: MITRE-1 OR Zlib", "nothing"]
    texts += ["SPDX-License-Identifier: (GPL-2.0 AND MIT) OR Apache-2.0", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    for i, text in enumerate(texts[: len(phrases)]):
        words = " " + " ".join(re.findall("[a-z0-9]+", text.lower())) + " "
        named = {label for p, label in phrases.items() if f" {p} " in words}
        assert got[i].labels == ",".join(sorted(named))
        assert got[i].score == min(FREEDOM[x] for x in named)
    n = len(phrases)
    assert (got[n].labels, got[n].score) == ("bsd,mit", 1.0)
    assert (got[n + 1].labels, got[n + 1].score) == ("mitre-1,zlib", 0.5)
    assert (got[n + 2].labels, got[n + 2].score) == ("", 1.0)
    assert (got[n + 3].labels, got[n + 3].score) == ("apache,gpl,mit", 1.0)
    assert (got[n + 4].labels, got[n + 4].score) == ("", 1.0)
