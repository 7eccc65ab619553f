"""Benchmark decontamination by winnowing.

Of every window of 13 words the smallest hash among its 5-word grams is kept, on both sides, so a
span that a document shares with a benchmark item always leaves an equal fingerprint on each. The
fingerprints are joined, and each document that meets an item is then read again and its hits are
extended to all words inside an occurrence of one of the item's windows. An item of fewer than 13
words is one window; documents are winnowed once more for each such length that occurs.

Scale. About a fifth of the words leave a fingerprint, folded per Arrow batch and row. The join
is left to Spark: the benchmark's side is broadcast when it is small and shuffled when it is not.
Candidates are (document, item) pairs, bounded by the words of the document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, maybe_broadcast, trimmed
from tidemark.llm.text_arrays import (
    ALNUM,
    LOWER,
    chunks,
    constant,
    gram_hashes,
    longs,
    mix,
    utf8,
    word_hashes,
    word_spans,
)

WINDOW = 13
GRAM = 5

RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, items array<string>, hits array<long>"
)


def words_of(column: pa.Array, low: int, high: int, data, offsets):
    at = offsets[low : high + 1] - offsets[low]
    lowered = LOWER[data[offsets[low] : offsets[high]]]
    starts, ends, first = word_spans(lowered, at, ALNUM)
    return lowered, starts, ends, first


def winnow(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of every window of `length` words, and the rows they are from."""
    gram = min(GRAM, length)
    hashes = mix(gram_hashes(words, gram) + constant(100 + length))
    reach = length - gram + 1
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = hashes[:n].copy()
    for k in range(1, reach):
        np.minimum(least, hashes[k : k + n], out=least)
    row = np.searchsorted(first, np.arange(n), "right") - 1
    inside = np.arange(n) + length <= first[row + 1]
    least, row = least[inside], row[inside]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    return least[new], row[new]


def _fingerprints(lengths: list[int], whole: bool):
    """Rows (id, mark). With `whole`, a row of fewer than 13 words is one window (items)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, offsets = utf8(batch.column(1))
            for low, high in chunks(offsets):
                lowered, starts, ends, first = words_of(batch.column(1), low, high, data, offsets)
                words = word_hashes(lowered, starts, ends)
                if whole:
                    marks, rows = [], []
                    for i in range(high - low):
                        mine = words[first[i] : first[i + 1]]
                        if len(mine):
                            found, _ = winnow(mine, np.array([0, len(mine)]), min(WINDOW, len(mine)))
                            marks.append(found)
                            rows.append(np.full(len(found), i))
                else:
                    marks, rows = zip(*(winnow(words, first, n) for n in lengths))
                if not len(marks):
                    continue
                mark, row = np.concatenate(marks), np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row + low)), longs(mark)], names=["id", "mark"]
                )

    return run


def _windows(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """Length and hashes of the windows of each item."""
    column = pa.array(texts, pa.string())
    data, offsets = utf8(column)
    out = []
    for low, high in chunks(offsets):
        lowered, starts, ends, first = words_of(column, low, high, data, offsets)
        words = word_hashes(lowered, starts, ends)
        for i in range(high - low):
            mine = words[first[i] : first[i + 1]]
            length = min(WINDOW, len(mine))
            out.append((length, np.unique(gram_hashes(mine, length)) if length else mine))
    return out


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, hit words and items of every document; `items` lists its candidates or is null."""
    seen: dict[str, tuple[int, np.ndarray]] = {}
    for batch in batches:
        column, items = batch.column(1), batch.column(2)
        data, offsets = utf8(column)
        n = len(column)
        n_words, n_hit = np.zeros(n, np.int64), np.zeros(n, np.int64)
        named: list[list[str]] = [[] for _ in range(n)]
        spans: list[list[int]] = [[] for _ in range(n)]
        asked = np.asarray(items.is_valid())
        for low, high in chunks(offsets):
            lowered, starts, ends, first = words_of(column, low, high, data, offsets)
            n_words[low:high] = np.diff(first)
            for i in np.flatnonzero(asked[low:high]):
                a, b = first[i], first[i + 1]
                mine = word_hashes(lowered, starts[a:b], ends[a:b])
                wanted = items[int(low + i)].as_py()
                if len(seen) > 100_000:
                    seen.clear()
                new = [x["text"] for x in wanted if x["text"] not in seen]
                seen.update(zip(new, _windows(new)))
                hit = np.zeros(len(mine), bool)
                found = set()
                grams: dict[int, np.ndarray] = {}
                for x in wanted:
                    length, hashes = seen[x["text"]]
                    if not length or length > len(mine):
                        continue
                    if length not in grams:
                        grams[length] = gram_hashes(mine, length)
                    at = np.flatnonzero(np.isin(grams[length], hashes))
                    if len(at):
                        found.add(x["item"])
                        hit[(at[:, None] + np.arange(length)).ravel()] = True
                n_hit[low + i] = hit.sum()
                named[low + i] = sorted(found)
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False]))
                spans[low + i] = edge.tolist()
        digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in named]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                longs(n_words),
                longs(n_hit),
                longs([len(x) for x in named]),
                pa.array(digest, pa.string()),
                pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
                pa.array(named, pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.int64())),
            ],
            names=[x.split()[0] for x in RESULT.split(", ")],
        )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, ws: Workspace | None = None
) -> DataFrame:
    """Words of each document that lie inside a window of a benchmark item.

    Columns `doc_id`, `n_words`, `n_hit`, `n_items`, `items_sha256`, `contaminated`, `items` (ids
    as sorted strings) and `hits` (starts and ends of the runs of hit words, in turn).

    Words are runs of letters, digits and bytes over 7F, with A-Z lower-cased. A window is 13
    consecutive words of an item; an item of fewer words, but not none, is one window. A document
    is contaminated if at least one word in twenty is hit.

    One row per input row. A null text has no words; a null doc_id stays null and its row is
    judged like any other. Items with a null or wordless text match nothing; a null item_id counts
    as the empty string. Rows that repeat a doc_id share candidates and are judged by their own text.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "decontaminate")
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text"
    ).where("text is not null").distinct()
    short = (
        items.mapInArrow(_item_lengths, "n long").where(f"n between 1 and {WINDOW - 1}").distinct()
    )
    lengths = [WINDOW, *sorted(r.n for r in short.collect())]  # at most 12 more
    item_marks = items.mapInArrow(_fingerprints([], True), "id string, mark long").distinct()
    # Candidates go by doc_id; those of rows without one by a fingerprint of the text.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns(
        {
            "odd": F.col("doc_id").isNull(),
            "key": F.coalesce(F.col("doc_id"), F.xxhash64("text")),
        }
    )
    marks = [
        texts.where(F.col("odd") == odd)
        .select("key", "text")
        .mapInArrow(trimmed(_fingerprints(lengths, False)), "id long, mark long")
        .select(F.lit(odd).alias("odd"), F.col("id").alias("key"), "mark")
        for odd in (False, True)
    ]
    met = (
        marks[0]
        .unionByName(marks[1])
        .join(item_marks.withColumnRenamed("id", "item"), "mark")
        .select("odd", "key", "item")
        .distinct()
    )
    found = met.join(items.select(F.col("id").alias("item"), "text"), "item")
    found = found.groupBy("odd", "key").agg(
        F.collect_set(F.struct("item", "text")).alias("items")
    )
    found = ws.save(found, "candidates")
    size = found.agg(
        F.sum(F.expr("aggregate(items, 100L, (n, x) -> n + 60 + length(x.text))"))
    ).first()[0]
    asked = texts.join(maybe_broadcast(found, size or 0), ["odd", "key"], "left")
    return asked.select("doc_id", "text", "items").mapInArrow(trimmed(_extend), RESULT)


def _item_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        counts = [np.zeros(0, np.int64)]
        for low, high in chunks(offsets):
            counts.append(np.diff(words_of(batch.column(1), low, high, data, offsets)[3]))
        yield pa.RecordBatch.from_arrays([longs(np.concatenate(counts))], names=["n"])
