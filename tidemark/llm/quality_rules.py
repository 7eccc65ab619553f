"""Quality rules as a short-circuit cascade, in SQL expressions only.

The counts every document reports are computed once. The further rules are tried one after
another and the first that rejects ends the work on a document, so their order decides the cost
and not the verdict: cost and selectivity of each rule are measured on a sample, and rules run by
rejections per second, most first.

Scale. No shuffle and no join; everything is a projection of one row. Repeated windows are found
by sorting a row's own window hashes, and only in rows that have any.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

SAMPLE_ROWS = 2000
SEED = 8
RUNS = 2
LEAST_SECONDS = 0.001
WINDOW = 8
SPACE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Name -> condition that rejects; over the counts and `text`. Fixed thresholds.
RULES = {
    "symbols": "5 * n_symbols > 2 * n_words",
    "repeated lines": "n_dup_lines >= 5 and 2 * n_dup_lines > n_lines",
    "word length": "word_chars > 25 * n_words or word_chars < 2 * n_words",
    "capitals": f"2 * (length(text) - length(translate(text, '{CAPITALS}', ''))) > word_chars",
    "exclamations": "2 * (length(text) - length(translate(text, '!', ''))) > n_words",
    "digits": "2 * (length(text) - length(translate(text, '0123456789', ''))) > word_chars",
}


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of a text's words."""
    n = F.size(hashes)
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[hashes[i + k] for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return let(pairs, marked)

    def marked(s: Column) -> Column:
        last = F.size(s) - 1
        twice = F.filter(
            s,
            lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
            | ((k < last) & (s[F.least(k + 1, last)]["h"] == x["h"])),
        )
        return F.aggregate(
            F.array_sort(F.transform(twice, lambda x: x["at"])),
            F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
            lambda a, at: F.struct(
                (at + WINDOW).alias("end"),
                (a["n"] + at + WINDOW - F.greatest(at, a["end"])).alias("n"),
            ),
            lambda a: a["n"],
        )

    zero = F.lit(0).cast("long")
    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(covered(w)),
    )


def counted(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and the counts that the rules are written in."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all("text", F.lit("([^ \\t\\n\\x0B\\f\\r]+)"), F.lit(1))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    out = out.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w)))
    lines = F.filter(
        F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0
    )
    return out.select(
        "doc_id",
        "text",
        F.size("hashes").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias(
            "n_symbols"
        ),
        let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("all"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            ),
        ).alias("lines"),
        repeat_words(F.col("hashes")).alias("n_repeat_words"),
    ).select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols",
        F.col("lines.dup").alias("n_dup_lines"), F.col("lines.all").alias("n_lines"),
        "n_repeat_words",
    )


def rule_order(docs: DataFrame, ws: Workspace) -> list[str]:
    """Rule names by rejections per second on a sample of about SAMPLE_ROWS rows.

    A rule's cost is its time beyond that of an aggregate without a rule, the least of RUNS.
    """
    total = docs.count()
    drawn = docs.sample(fraction=min(1.0, SAMPLE_ROWS / max(1, total)), seed=SEED)
    sample = ws.save(counted(drawn), "sample")
    rejected = sample.agg(
        *[F.count_if(F.expr(rule)).alias(name) for name, rule in RULES.items()]
    ).first()

    def seconds(condition: str) -> float:
        took = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            sample.agg(F.count_if(F.expr(condition))).first()
            took.append(time.perf_counter() - begin)
        return min(took)

    idle = seconds("doc_id is null")
    rate = {
        name: rejected[name] / max(LEAST_SECONDS, seconds(rule) - idle)
        for name, rule in RULES.items()
    }
    return sorted(RULES, key=lambda name: -rate[name])


def quality_rules(docs: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """Counts and a verdict for each text.

    Columns `doc_id`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`,
    `base_failed` (under 20 words, or over 30 in 100 of them in repeated 8-word windows) and
    `kept` (not base_failed, and no rule of RULES rejects).

    Words are runs of anything but space and the controls 09-0D. One row per input row; a null
    text has no words and fails; a null doc_id stays null; repeated rows are repeated.
    """
    ws = ws or Workspace(docs.sparkSession, "rules")
    order = rule_order(docs, ws)
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    verdict = F.when(failed, False)
    for name in order:
        verdict = verdict.when(F.expr(RULES[name]), False)
    return counted(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), verdict.otherwise(True).alias("kept"),
    )
