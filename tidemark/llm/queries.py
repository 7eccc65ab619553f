"""The operators as queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.centroids import centroid_clusters
from tidemark.llm.common import documents
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.language_id import identify
from tidemark.llm.license_scan import license_scan
from tidemark.llm.mixing import mix_sources
from tidemark.llm.pii import personal_data
from tidemark.llm.prefix_trie import conversation_trie
from tidemark.llm.pu_quality import quality_scores
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_counts import token_counts
from tidemark.llm.word_scores import word_scores


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), width=3, num=90, den=100)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("spans", "kept_text", "carried")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(documents(spark, sf_dir), benchmark).drop("items", "hits")


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_scores(documents(spark, sf_dir))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_source_mix,
        op3_suffix_dedup,
        op4_language_id,
        op5_decontamination,
        op6_pu_quality,
        op7_token_counts,
        op8_quality_rules,
        op9_license_scan,
        op10_lm_scores,
        op11_personal_data,
        op12_conversation_trie,
        op13_centroid_clusters,
        pipeline,
    )
}

SPACED = "'[^ \\t\\n\\x0B\\f\\r]+'"
ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

ORACLE = {}

ORACLE["op1_jaccard_join"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER}, {SPACED}) AS w FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
      lambda i: [w[i], w[i + 1], w[i + 2]]))
    WHEN len(w) > 0 THEN [w] ELSE [] END AS s FROM words
), grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, coalesce(len(s), 0) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)
), reach(v, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.v
)
SELECT doc_id, n::BIGINT AS n_shingles, component_id FROM sizes
JOIN (SELECT v, min(r) AS component_id FROM reach GROUP BY v) ON v = doc_id
"""

ORACLE["op3_suffix_dedup"] = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), blocks AS (
  SELECT doc_id, b, substr(h, 200 * b + 1, 300) AS c
  FROM (SELECT doc_id, h, unnest(range(0, (len(h) // 2 + 99) // 100)) AS b FROM bytes)
), places AS (
  SELECT doc_id, 100 * b + o AS p, substr(c, 2 * o + 1, 100) AS s
  FROM (SELECT *, unnest(range(0, 100)) AS o FROM blocks) WHERE 2 * o < len(c)
), starts AS (
  SELECT doc_id, p, s FROM places WHERE len(s) = 100
), firsts AS (SELECT s, min(doc_id) AS first FROM starts GROUP BY s),
hits AS (
  SELECT doc_id, p FROM starts JOIN firsts USING (s) WHERE first < doc_id
), marked AS (
  SELECT doc_id, p, substr(s, 1, 2) AS c, last_hit >= p - 49 AS gone FROM (
    SELECT places.*, max(CASE WHEN hits.p IS NOT NULL THEN places.p END) OVER (
      PARTITION BY places.doc_id ORDER BY places.p) AS last_hit
    FROM places LEFT JOIN hits ON hits.doc_id = places.doc_id AND hits.p = places.p)
), runs AS (
  SELECT *, coalesce(gone, false) AS g,
    coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS before FROM marked
), cut AS (
  SELECT doc_id, count(*) FILTER (g) AS n_removed, count(*) FILTER (g AND NOT before) AS n_spans,
    string_agg(c, '' ORDER BY p) FILTER (NOT g) AS kept FROM runs GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
"""

ORACLE["op5_decontamination"] = f"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all({ASCII_LOWER}, {ALNUM}), []) AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({ASCII_LOWER}, {ALNUM}) AS w
  FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
  SELECT item, least(13, len(w)) AS n,
    unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
      lambda i: list_slice(w, i, i + least(13, len(w)) - 1))) AS g
  FROM items WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM words, lengths WHERE len(w) >= n
), met AS (
  SELECT doc_id, d.n, i, item FROM doc_windows d
  JOIN item_windows m ON m.n = d.n AND m.g = list_slice(d.w, d.i, d.i + d.n - 1)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op8_quality_rules"] = f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), again AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows SEMI JOIN again USING (doc_id, g))
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT x) AS d FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM words)
  WHERE regexp_matches(x, {SPACED}) GROUP BY doc_id
), counts AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words,
    len(list_aggregate(w, 'string_agg', ''))::BIGINT AS word_chars,
    (len(text) - len(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(lines.n - lines.d, 0)::BIGINT AS n_dup_lines, coalesce(lines.n, 0) AS n_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines,
  n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
    OR 5 * n_symbols > 2 * n_words
    OR (n_dup_lines >= 5 AND 2 * n_dup_lines > n_lines)
    OR word_chars > 25 * n_words OR word_chars < 2 * n_words
    OR 2 * (len(text) - len(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > word_chars
    OR 2 * (len(text) - len(translate(text, '!', ''))) > n_words
    OR 2 * (len(text) - len(translate(text, '0123456789', ''))) > word_chars) AS kept
FROM counts
"""

# Unsigned crc32 of a decimal number: eight steps a byte, the byte itself at the first of them.
ORACLE["op12_conversation_trie"] = """
WITH RECURSIVE own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, role, text) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, seq, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda s, e: xor(xor(s, e) >> 1, 3988292384 * (xor(s, e) & 1)))) % 6 AS h
  FROM own
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(list_slice(b.seq, 1, a.h), []),
    list_slice(a.seq, a.h + 1, len(a.seq))) AS seq
  FROM heads a LEFT JOIN own b ON b.conv_id = a.base
), paths AS (
  SELECT conv_id, d, list_slice(seq, 1, d) AS path, d = len(seq) AS ends
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, any_value(d)::BIGINT AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
      AS ends_sha256
  FROM paths GROUP BY path
), families AS (
  SELECT n.*, coalesce(c.n, 0)::BIGINT AS n_children, p.conv_id AS parent_conv_id,
    CASE WHEN depth > 0 THEN (n_convs - 1) * length(n.path[depth].t) ELSE 0 END AS saved
  FROM nodes n
  LEFT JOIN (SELECT list_slice(path, 1, depth - 1) AS over, count(*) AS n FROM nodes
    WHERE depth > 0 GROUP BY over) c ON c.over = n.path
  LEFT JOIN (SELECT path AS over, conv_id FROM nodes) p
    ON n.depth > 0 AND p.over = list_slice(n.path, 1, n.depth - 1)
), sums AS (
  SELECT above, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT n_children, saved, list_slice(path, 1, k) AS above
    FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM families)) GROUP BY above
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM families JOIN sums ON above = path
"""


def _nearest(vectors: str, centroids: str) -> str:
    """The vectors with the number of their nearest centroid and its squared distance."""
    return f"""
  SELECT vec_id, row_id, any_value(v) AS v, min(near).c AS c, min(near).d AS d FROM (
    SELECT k.*, {{'d': list_sum(list_transform(list_zip(k.v, m.v),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': m.c}} AS near
    FROM {vectors} k, {centroids} m) GROUP BY vec_id, row_id"""


def _moved(near: str, centroids: str) -> str:
    """The centroids after a round: exact floors of the means; empty ones stay."""
    return f"""
  SELECT m.c, coalesce(n.v, m.v) AS v FROM {centroids} m LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, unnest(range(len(v))) AS i FROM {near}) GROUP BY c, i)
    GROUP BY c) n ON n.c = m.c"""


ORACLE["op13_centroid_clusters"] = f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS row_id,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), m0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), row_id) - 1 AS c, v
  FROM kept QUALIFY c < 16
), n0 AS ({_nearest("kept", "m0")}
), m1 AS ({_moved("n0", "m0")}
), n1 AS ({_nearest("kept", "m1")}
), m2 AS ({_moved("n1", "m1")}
), n2 AS ({_nearest("kept", "m2")}
), m3 AS ({_moved("n2", "m2")}
), n3 AS ({_nearest("kept", "m3")}
)
SELECT vec_id, n3.c::INTEGER AS cluster, d AS distance,
  (sum(d) OVER (PARTITION BY n3.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(list_aggregate(list_transform(m3.v, lambda x: x::VARCHAR), 'string_agg', ','))
    AS centroid_sha256
FROM n3 JOIN m3 ON m3.c = n3.c
"""
