"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams, by rank. A document's own
profile is compared with each by the out-of-place distance: the sum, over the document's n-grams,
of how far their ranks lie apart, or the profile's length for one it lacks. The nearest language
is predicted.

Scale. Profiles are learned from about TRAIN_DOCS documents per language, drawn by a hash of
ids and texts; n-grams are counted per batch before the shuffle, and only the profiles (PROFILE rows a
language) reach the driver. Prediction is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, maybe_broadcast

PROFILE = 300  # n-grams of a profile, for languages and documents
TRAIN_DOCS = 5000  # documents per language that profiles are learned from, about
ORDERS = (1, 2, 3)
BLOCK = 1 << 20  # characters worked on at once

RESULT = "doc_id long, lang_pred string, score double"


def letter_table() -> np.ndarray:
    """Which code points of the basic plane are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


def blocks(text: str) -> Iterator[str]:
    """A text in blocks that end between words, so that its n-grams do not depend on them."""
    low = 0
    while True:
        high = low + BLOCK
        if high >= len(text):
            yield text[low:]
            return
        end = high
        while end > low and text[end - 1].isalpha():
            end -= 1
        if end == low:  # one word: to its end
            end = high
            while end < len(text) and text[end].isalpha():
                end += 1
        yield text[low:end]
        low = end


def grams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text's words, with a blank at either end of a word, and counts.

    An n-gram is a number: its order, then 16 bits a character. Letters above the basic plane are
    folded into it by their low bits.
    """
    found, counts = [], []
    for part in blocks(text):
        part = part.lower()
        code = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        high = code >> 16 > 0
        if high.any():
            wide = [chr(c).isalpha() for c in code[high]]
            code = code & 0xFFFF
            is_letter = letters[code]
            is_letter[high] = wide
        else:
            is_letter = letters[code]
        code = np.where(is_letter, code, 0).astype(np.uint64)
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]  # one blank after a word
        code = np.r_[np.uint64(0), code[keep], np.uint64(0)]
        parts = [code[code > 0] | np.uint64(1 << 60)]
        for n in ORDERS[1:]:
            total = code[: len(code) - n + 1]
            for k in range(1, n):
                total = (total << np.uint64(16)) | code[k : len(code) - n + 1 + k]
            # No blank inside, and not blanks alone.
            inner = np.ones(len(total), bool)
            for k in range(1, n - 1):
                inner &= code[k : k + len(total)] > 0
            ends = (code[: len(total)] > 0) | (code[n - 1 : n - 1 + len(total)] > 0)
            parts.append(total[inner & ends] | np.uint64(n << 60))
        a, b = np.unique(np.concatenate(parts), return_counts=True)
        found.append(a)
        counts.append(b)
    if len(found) == 1:
        return found[0], counts[0]
    a, at = np.unique(np.concatenate(found), return_inverse=True)
    return a, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def top(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, most first; ties by number."""
    return found[np.lexsort((found, -counts))[:PROFILE]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_table()
    for batch in batches:
        by_lang: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_lang.setdefault(lang, []).append(grams(text.as_py() or "", letters))
        for lang, rows in by_lang.items():
            a, at = np.unique(np.concatenate([x for x, _ in rows]), return_inverse=True)
            n = np.bincount(at, np.concatenate([x for _, x in rows]), len(a)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(a.astype(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"],
            )


def learn(labelled: DataFrame) -> dict[str, list[int]]:
    """Profiles from rows (doc_id, text, lang)."""
    known = labelled.where("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("docs"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    sizes = Workspace(labelled.sparkSession, "languages").save(sizes, "sizes")
    size = sizes.agg(F.sum(F.octet_length("lang") + 48)).first()[0] or 0
    part = sizes.select("lang", (F.lit(TRAIN_DOCS) / F.col("docs")).alias("part"))
    drawn = known.join(maybe_broadcast(part, size), "lang").where(draw < F.col("part"))
    counts = drawn.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(
        _count, "lang string, gram long, n long"
    )
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE)
    out: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():
        out.setdefault(row.lang, []).append(row.gram)
    return out


class Ranks:
    """Ranks of all profiles' n-grams, for lookups."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.names = sorted(profiles)
        self.keys = np.unique(
            np.array([g for p in profiles.values() for g in p], np.uint64)
        )
        self.rank = np.full((len(self.names), len(self.keys) + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            own = np.array(profiles[name], np.uint64)
            self.rank[i, np.searchsorted(self.keys, own)] = np.arange(len(own))

    def nearest(self, own: np.ndarray) -> tuple[str, float]:
        """The nearest language, ties by name, and one less its share of the next distance."""
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        at[self.keys[at] != own] = len(self.keys)
        rank = self.rank[:, at]
        apart = np.where(rank < 0, PROFILE, np.abs(rank - np.arange(len(own))))
        far = apart.sum(axis=1)
        best = int(far.argmin())
        others = np.delete(far, best)
        bar = others.min() if len(others) else PROFILE * len(own)
        return self.names[best], float(1 - far[best] / bar) if bar else 0.0


def _predict(profiles: dict[str, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(profiles)
        letters = letter_table()
        for batch in batches:
            named, scores = [], []
            for text in batch.column(1):
                found, counts = grams(text.as_py() or "", letters)
                if not len(found) or not ranks.names:
                    named.append("und")
                    scores.append(0.0)
                    continue
                name, score = ranks.nearest(top(found, counts))
                named.append(name)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(named, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def held_out():
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return F.coalesce(fold == 1, F.lit(False))


def identify(docs: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Language of each text: columns `doc_id`, `held_out`, `lang_pred`, `score`.

    Profiles are learned from the texts and non-null `lang` of documents that are not held out
    (crc32 of the doc_id's text modulo 3 is not 1); a prediction uses the text alone. `und`, with
    score 0, is a null text, one without letters, or any text when nothing could be learned. The
    score is 0 when the two nearest languages are equally far and 1 when the nearest fits exactly.

    `asked` are the rows that are predicted, by default the rows that are learned from. One row
    per row of it; a null doc_id stays null and is not held out; repeated rows count as often as
    they occur.
    """
    texts = (docs if asked is None else asked).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    labelled = docs.select("doc_id", "text", "lang").where(~held_out())
    found = texts.mapInArrow(_predict(learn(labelled)), RESULT)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
