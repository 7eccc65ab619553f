"""Registered queries against their SQL, and the pipeline against its own stages' rules."""

from __future__ import annotations

import pytest

from tests.harness import connect, difference
from tests.llm import brute
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(ORACLE[name]).df()
    # A whole number with nulls has one type on DuckDB and another in pandas.
    whole = {c: "Int64" for c in got if got[c].dtype.kind == "f" and want[c].dtype.kind == "i"}
    assert difference(got.astype(whole), want) is None


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == p.COLUMNS
        found = {r.doc_id: r.text for r in docs.collect()}
        if name == "n-gram Jaccard join":
            root = brute.components(list(kept.items()), 5, 80, 100)
            assert found == {i: t for i, t in kept.items() if root[i] == i}
        if name == "suffix-array dedup":
            cut = {r[0]: r[2] for r in brute.repeats(list(kept.items()))}
            assert all(found[i] == t for i, t in kept.items() if not cut[i])
        if name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in
                     spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            bad = {r[0] for r in brute.contamination(list(kept.items()), items) if r[5]}
            assert set(found) == set(kept) - bad
        kept = found
    last = p.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == set(kept)
    whole = {r.doc_id: r.taken for r in p.run(spark, sf_dir).collect()}
    assert whole == {r.doc_id: r.taken for r in last}


ODD = "doc_id long, text string, lang string, source string, n_chars long, key long, spans int"


def odd_documents():
    """Null and repeated ids, null and empty texts, equal rows, near and exact copies, ties."""
    prose = "the old house by the sea was empty and the wind went through it all day long while " \
        "nobody came to see what was left of the garden and its walls"
    near = prose.replace("garden", "orchard")
    shared = "a passage of more than fifty bytes that some of these documents hold in common"
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    texts = [
        (1, prose), (2, near), (None, prose), (None, None), (3, ""), (3, "short text here"),
        (4, f"start of it {shared} end of it"), (4, f"another one with {shared} in it"),
        (None, f"nobody owns this and {shared} too"), (5, "1234 --- 99"), (6, item), (None, item),
        (7, "equal rows are one document"), (7, "equal rows are one document"),
        (8, f"clean words before the item {item}" + " and more words" * 100), (9, "word " * 3000),
        (2, "the same id as a near copy but nothing like it at all"), (10, "x"),
    ]
    return [(i, t, "en", None if k % 3 else f"s{k}", 7, 0, 1) for k, (i, t) in enumerate(texts)]


def kept(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def bench_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bench"))
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = spark.createDataFrame([(1, item), (None, None), (2, "")], "item_id long, text string")
    rows.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_on_odd_rows(spark, bench_dir):
    import corpus_pipeline as p

    rows = [r[:2] for r in odd_documents()]
    docs = spark.createDataFrame(odd_documents(), ODD).repartition(3)
    stages = dict(p.STAGES)

    def after(name):
        found = stages[name](spark, docs, bench_dir)
        assert found.columns == p.COLUMNS
        return kept(found)

    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert after("language ID") == sorted(lettered, key=repr)

    # Places in the order of ids, null last; equal rows are one.
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    root = brute.components([(k, t) for k, (_, t) in enumerate(distinct)], 5, 80, 100)
    firsts = [r for k, r in enumerate(distinct) if root[k] == k]
    got = after("n-gram Jaccard join")
    assert len(got) == len(firsts) and len(got) < len(set(rows))
    assert (1, rows[0][1]) in got and (None, rows[0][1]) not in got and rows[16] in got

    cut = dict.fromkeys(after("suffix-array dedup"))
    assert (4, rows[6][1]) in cut or (4, rows[7][1]) in cut
    assert not {(4, rows[6][1]), (4, rows[7][1])} <= set(cut)
    assert rows[8] not in cut and (None, None) in cut and (3, "") in cut

    judged = brute.contamination([(k, t) for k, (_, t) in enumerate(rows)],
                                 [(1, rows[10][1]), (2, "")])
    clean = [r for r, j in zip(rows, judged) if not j[5]]
    assert after("benchmark decontamination") == sorted(clean, key=repr)
    assert rows[10] not in clean and rows[11] not in clean and rows[14] in clean

    mixed = stages["mixing sources"](spark, docs, bench_dir).collect()
    want = sorted((repr(i), len(brute.spaced(t))) for i, t in rows)
    assert sorted((repr(r.doc_id), r.size) for r in mixed) == want
    assert all(r.taken <= 3 * r.size for r in mixed)


def test_stages_without_rows(spark, bench_dir):
    import corpus_pipeline as p

    for _, stage in p.STAGES:
        assert stage(spark, spark.createDataFrame([], ODD), bench_dir).collect() == []
