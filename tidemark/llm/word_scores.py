"""Stupid-backoff scores of documents under word n-grams of all documents.

Words are split at white space, ASCII letters folded. A word's score is the count of the gram of
ORDER words that ends with it over the count of the words before it, or 0.4 times the score with
one word less before it, and so on; a gram seen fewer than MIN_COUNT times counts as unseen. The
first words of a text start from the longest gram they have. The empty gram is counted once a
word, so its count is the number of words, under which single words are scored.

Scale. Rows are packed where they lie into buckets of about BUCKET_BYTES, whatever their ids and
texts, so no value decides how large a bucket is; only a longer text makes a larger one. A
bucket's grams of all orders are counted in place and leave it as hashes of 62 bits and an order,
sorted and packed, one row per bucket and part of the hash range. Each part sums its grams over
the buckets and returns the sums alone, in the order of the bucket's grams, which the bucket finds
again from its texts. Distinct grams are nearly as many as words, so what is gathered grows with
the corpus. Nothing is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace
from tidemark.llm.text_arrays import (
    CHUNK,
    LOWER,
    SPACED,
    chunks,
    gram_hashes,
    longs,
    utf8,
    word_hashes,
    word_spans,
)

ORDER = 3
BACKOFF = 0.4
MIN_COUNT = 2
BUCKET_BYTES = 32 << 20
# A part sums the grams of about so much text.
PART_BYTES = 16 << 20
LEVEL = 6

PACKED = (
    "bucket long, doc_id array<long>, size array<long>, bytes long, many array<long>, "
    "pieces array<binary>"
)
CELLS = "part int, bucket long, n long, grams binary, counts binary"
FOUND = "part int, bucket long, n long, counts binary"
RESULT = "doc_id long, n_words long, log_score double, score double"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket, numbered within the partition: ids and sizes of its texts, which are
    compressed in pieces of about two megabytes, and the number of texts of each piece."""
    codec = pa.Codec("zstd", compression_level=LEVEL)
    bucket = TaskContext.get().partitionId() << 33
    ids, sizes, many, pieces, filled = [], [], [], [], 0

    def batch_of() -> pa.RecordBatch:
        size = np.concatenate(sizes)
        listed = [pa.concat_arrays(ids), longs(size), longs(many), pa.array(pieces, pa.binary())]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in listed]
        return pa.RecordBatch.from_arrays(
            [longs([bucket]), *lists[:2], longs([size.sum()]), *lists[2:]],
            names=["bucket", "doc_id", "size", "bytes", "many", "pieces"],
        )

    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for low, high in chunks(offsets):
            size = np.diff(offsets[low : high + 1])
            if pieces and filled + int(size.sum()) > BUCKET_BYTES:
                yield batch_of()
                bucket, filled = bucket + 1, 0
                ids, sizes, many, pieces = [], [], [], []
            # An empty text takes space as well.
            filled += int(size.sum()) + 64 * len(size)
            ids.append(batch.column(0).slice(low, high - low))
            sizes.append(size)
            many.append(high - low)
            text = data[offsets[low] : offsets[high]].tobytes()
            pieces.append(codec.compress(text, asbytes=True))
    if pieces:
        yield batch_of()


def _words(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket: hashes of its words, the longest gram that ends at each, words by text."""
    size, many = np.asarray(row["size"].values), np.asarray(row["many"].values)
    found, longest, words, low = [], [], [], 0
    for held, rows in zip(row["pieces"].values, many):
        offsets = np.r_[0, np.cumsum(size[low : low + rows])]
        low += rows
        data = np.zeros(0, np.uint8)
        if offsets[-1]:
            text = pa.Codec("zstd").decompress(held.as_buffer(), int(offsets[-1]))
            data = LOWER[np.frombuffer(text, np.uint8)]
        starts, ends, first = word_spans(data, offsets, SPACED)
        words.append(np.diff(first))
        place = np.arange(len(starts)) - np.repeat(first[:-1], words[-1])
        longest.append(np.minimum(place + 1, ORDER).astype(np.int8))
        found.append(word_hashes(data, starts, ends))
    return np.concatenate(found), np.concatenate(longest), np.concatenate(words)


def _codes(words: np.ndarray, longest: np.ndarray, order: int) -> np.ndarray:
    """The grams of an order, each at the word that ends it."""
    out = np.zeros(len(words), np.uint64)
    for low in range(0, len(words), CHUNK):
        code = gram_hashes(words[low : low + CHUNK + order - 1], order)
        out[low + order - 1 : low + order - 1 + len(code)] = code
    return out[longest >= order] & ~np.uint64(3) | np.uint64(order)


def _distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value among them."""
    order = np.argsort(code)
    code = code[order]
    new = np.r_[True, code[1:] != code[:-1]][: len(code)]
    at = np.empty(len(code), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return code[new], at


def _squeeze(values: np.ndarray) -> bytes:
    """64-bit values, byte by byte so that leading zeros compress."""
    planes = values.view(np.uint8).reshape(len(values), 8).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _spread(held: pa.BinaryScalar, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(held.as_buffer(), 8 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()


def _grams(parts: int):
    """Counts of distinct grams by bucket and part of the hash range, from packed buckets."""
    width = (1 << 64) // parts
    edges = np.array([k * width for k in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held = {k: batch.column(k)[row] for k in ("bucket", "size", "many", "pieces")}
                words, longest, _ = _words(held)
                if len(words):
                    yield cells(held["bucket"].as_py(), words, longest)

    def cells(bucket: int, words: np.ndarray, longest: np.ndarray) -> pa.RecordBatch:
        grams, counts = [np.zeros(1, np.uint64)], [np.array([len(words)], np.uint32)]
        for order in range(1, ORDER + 1):
            code, n = np.unique(_codes(words, longest, order), return_counts=True)
            grams.append(code)
            counts.append(n.astype(np.uint32))
        code, n = np.concatenate(grams), np.concatenate(counts)
        del grams, counts
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        cuts = np.r_[0, np.searchsorted(code, edges), len(code)]
        used = np.flatnonzero(np.diff(cuts))
        spans = [slice(cuts[k], cuts[k + 1]) for k in used]
        steps = [_squeeze(np.diff(code[x], prepend=np.uint64(0))) for x in spans]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                longs(np.full(len(used), bucket)),
                longs(np.diff(cuts)[used]),
                pa.array(steps, pa.binary()),
                pa.array([_squeeze(n[x].astype(np.uint64)) for x in spans], pa.binary()),
            ],
            names=["part", "bucket", "n", "grams", "counts"],
        )

    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Sums of a part's grams over all buckets, returned to each bucket; 0 if they are unseen."""
    sizes = table.column("n").to_pylist()
    grams = [np.cumsum(_spread(x, n)) for x, n in zip(table.column("grams"), sizes)]
    counts = [_spread(x, n) for x, n in zip(table.column("counts"), sizes)]
    at = np.unique(np.concatenate(grams), return_inverse=True)[1]
    total = np.bincount(at, np.concatenate(counts)).astype(np.uint64)
    total[total < MIN_COUNT] = 0
    total = total[at]
    ends = np.cumsum(sizes)
    sums = [_squeeze(total[b - n : b]) for b, n in zip(ends, sizes)]
    return table.drop_columns(["grams", "counts"]).append_column("counts", [sums])


def _sum_up(texts: pa.Table, found: pa.Table) -> pa.Table:
    """Scores of a bucket's documents from the sums of its grams."""
    found = found.sort_by("part")
    held = zip(found.column("counts"), found.column("n").to_pylist())
    total = np.concatenate([np.zeros(0, np.uint64), *(_spread(x, n) for x, n in held)])
    row = {k: texts.column(k)[0] for k in ("doc_id", "size", "many", "pieces")}
    hashes, longest, words = _words(row)
    first = np.r_[0, np.cumsum(words)]
    known, at = [np.zeros(1, np.uint64)], []
    for order in range(1, ORDER + 1):
        distinct, where = _distinct(_codes(hashes, longest, order))
        known.append(distinct)
        at.append(where)
    del hashes, distinct
    kind = np.concatenate(known)
    del known
    kind.sort(kind="stable")
    kind = (kind & np.uint64(3)).astype(np.int8)
    out = np.zeros(len(words))
    if first[-1]:
        if len(kind) != len(total):
            raise RuntimeError(f"{len(total)} sums for the {len(kind)} grams of a bucket")
        # One word in all is counted once, which the sums give as unseen.
        whole = max(1, int(total[0]))
        value = longest * math.log(BACKOFF) - math.log(whole)
        before = np.full(len(value), whole, np.uint64)
        for k in range(1, ORDER + 1):
            here = np.zeros(len(value), np.uint64)
            here[longest >= k] = total[kind == k][at.pop(0)]
            seen = here > 0
            share = here[seen] / np.maximum(before, here)[seen]
            value[seen] = np.log(share) + (longest[seen] - k) * math.log(BACKOFF)
            before = np.r_[np.zeros(1, np.uint64), here[:-1]]
        some = words > 0  # each sum by itself, so that it does not depend on the bucket
        out[some] = np.add.reduceat(value, first[:-1][some])
    return pa.table(
        {
            "doc_id": row["doc_id"].values,
            "n_words": longs(words),
            "log_score": pa.array(out),
            "score": pa.array(out / np.maximum(words, 1)),
        }
    )


def word_scores(docs: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """Stupid-backoff scores under a model of the words of all documents.

    Columns `doc_id`, `n_words`, `log_score` (sum of the natural logs of each word's score) and
    `score` (its mean per word, higher for more usual text).

    One row per input row. A null text is empty and scores 0; a null doc_id stays null; repeated
    rows count and are scored as often as they occur.
    """
    ws = ws or Workspace(docs.sparkSession, "words")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = ws.save(texts.mapInArrow(_pack, PACKED), "packed")
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    parts = 1 << (max(1, math.ceil(size / PART_BYTES)) - 1).bit_length()
    counts = packed.mapInArrow(_grams(parts), CELLS)
    found = counts.groupBy("part").applyInArrow(_add_up, FOUND)
    pieces = packed.select("bucket", "doc_id", "size", "many", "pieces")
    return pieces.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(_sum_up, RESULT)
