"""Every operator against a plain version: odd rows, the small tables, and empty ones."""

from __future__ import annotations

import random
import zlib

import pytest

from tests.llm import brute
from tidemark.llm import jaccard_join, suffix_dedup
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.language_id import identify
from tidemark.llm.license_scan import BASE_PHRASES, license_scan
from tidemark.llm.mixing import mix_sources
from tidemark.llm.pu_quality import quality_scores
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_counts import token_counts

# Extra columns carry names that the operators use inside or return.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, bucket int, gram long, "
    "n_shingles long, size string, taken long, target double, score double, doc long, items int"
)


def rows() -> list[tuple]:
    draw = random.Random(7)
    words = [f"wörd{k}" for k in range(400)]
    body = [draw.choice(words) for _ in range(300)]
    near = body.copy()
    near[150] = "changed"
    far = [draw.choice(words) for _ in range(60)] + body[:100]
    texts = {
        3: " ".join(body), 5: " ".join(near), 9: " ".join(far), 11: " ".join(body),
        2: "", 4: None, 6: " \n\t ", 7: "one two", 8: "ONE two",
        12: "MIT\nLicense and the Apache  LICENSE, the general public license. mit license",
        13: "a " * 5000 + "b" * 70_000 + " c d e " * 3000,
        14: "line of words\nline of words\nline of words\n" * 30,
        15: "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nprose follows",
        16: "漢字 テスト 1234 !!!", 17: "1234 5678 --- 90",
    }
    out = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", 1) for i, t in texts.items()]
    out += [(11, texts[11], "en", None, None), (None, texts[3], None, None, None)]
    out += [(7, "one two", None, "s1", 3), (7, " ".join(far), "en", "s1", 3)]
    return [(*r, 1, 2, 3, "x", 5, 0.5, 0.5, 7, 9) for r in out]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is not None, x) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


@pytest.mark.parametrize("cell", [400_000, 500])
def test_components(odd, small, monkeypatch, cell):
    monkeypatch.setattr(jaccard_join, "CELL_SHINGLES", cell)
    for frame, params in ((odd, (3, 90, 100)), (small, (5, 80, 100))):
        found = pairs(frame)
        want = brute.components(found, *params)
        got = jaccard_components(frame, *params).collect()
        same(
            got,
            [(i, len(brute.shingles(t, params[0])), want.get(i)) for i, t in found],
        )


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeats(odd, small, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    for frame in (odd, small):
        got = remove_repeats(frame).select(
            "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
        )
        same(got.collect(), brute.repeats(pairs(frame)))


def test_repeats_hand_columns_through(odd):
    got = remove_repeats(odd, ("text", "source")).select("doc_id", "carried.*").drop("doc_id")
    same(got.collect(), odd.select("doc_id", "text", "source").drop("doc_id").collect())


def test_repeats_over_small_batches(spark, small):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = remove_repeats(small).select(
            "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    same(got, brute.repeats(pairs(small)))


def test_contamination(spark, odd):
    text = next(r[1] for r in rows() if r[0] == 3)
    items = [(1, " ".join(text.split()[20:50])), (1, "one two"), (None, "the general public"),
             (4, None), (5, ""), (6, "--")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(odd, bench).drop("items", "hits").collect()
    same(got, brute.contamination(pairs(odd), items))
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(odd, empty).where("n_hit > 0 or contaminated").isEmpty()


def test_rules(odd):
    got = quality_rules(odd).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
    )
    same(got.collect(), [(i, *brute.rule_counts(t)) for i, t in pairs(odd)])


def test_licences(odd):
    got = license_scan(odd).collect()
    want = []
    for i, t in pairs(odd):
        n, found = brute.places(t, BASE_PHRASES)
        at = [k for k, _ in found]
        want.append((i, n, len(at), min(at, default=None), max(at, default=None),
                     ",".join(sorted({x for _, x in found}))))
    same([r[:6] for r in got], want)
    tagged = next(r for r in got if r.doc_id == 15)
    assert (tagged.labels, tagged.score) == ("apache,gpl,mit", 1.0)


def test_tokens(odd, small):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for frame in (odd, small):
        want = []
        for i, t in pairs(frame):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            want.append((i, len((t or "").encode()), n, n > 2048))
        same(token_counts(frame, path).collect(), want)


def test_languages(odd, small):
    got = {r.doc_id: r for r in identify(small).collect()}
    truth = {r.doc_id: r.lang for r in small.select("doc_id", "lang").collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    strange = identify(odd).collect()
    assert len(strange) == odd.count()
    assert {r.lang_pred for r in strange if r.doc_id in (2, 4, 6, 17)} == {"und"}


def test_quality(spark, odd, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    right = [r.predicted == r.quality for r in got]
    assert sum(right) >= 0.95 * len(right)
    marks = spark.createDataFrame([(3, 1), (5, None), (None, 1), (9, 0)], "doc_id long, quality int")
    for frame in (quality_scores(odd, marks), quality_scores(odd, marks.limit(0))):
        found = frame.collect()
        assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)


def test_mix(odd, small):
    for frame in (odd, small):
        found = {}
        for r in frame.select("source", "text").collect():
            found[r.source] = found.get(r.source, 0) + len(brute.spaced(r.text))
        got = mix_sources(frame).collect()
        assert sorted(map(tuple, got), key=key) == sorted(
            map(tuple, mix_sources(frame).collect()), key=key
        )
        assert len(got) == frame.count()
        assert all(0 <= r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
                   for r in got)
    by_id = {r.doc_id: r.source for r in small.collect()}
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(found))}
    total = sum(found.values())
    aims, fixed = {}, {}
    while True:
        free = {s: w for s, w in weights.items() if s not in fixed}
        left = total - sum(fixed.values())
        aims = fixed | {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if aims[s] > 3 * found[s]]
        if not over:
            break
        fixed |= {s: 3.0 * found[s] for s in over}
    taken = dict.fromkeys(found, 0)
    most = max(r["size"] for r in got)
    for r in got:
        s = by_id[r.doc_id]
        assert (r.source_size, round(r.target, 6)) == (found[s], round(aims[s], 6))
        taken[s] += r.taken
    assert all(abs(taken[s] - aims[s]) <= most for s in found)


@pytest.mark.parametrize(
    "run",
    [
        jaccard_components, remove_repeats, identify, quality_rules, license_scan,
        mix_sources,
    ],
    ids=lambda f: f.__name__,
)
def test_empty_tables(none, run):
    assert run(none).collect() == []


def test_empty_tables_with_a_second_input(spark, none):
    import public_tokenizers

    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert decontaminate(none, items).collect() == []
    assert quality_scores(none, labels).collect() == []
    assert token_counts(none, public_tokenizers.path("word_bpe_49k.json")).collect() == []
