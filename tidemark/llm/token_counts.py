"""Token counts by the whole-token shortcut.

Most pre-tokens of a text are vocabulary strings that the tokenizer keeps whole. Which of them
encode alone as one token is proved beforehand by encoding every vocabulary string with the
library itself; their occurrences are counted without any merge. Only the other pre-tokens are
encoded, each distinct one once per task while it stays in a bounded table.

The split into pre-tokens repeats the vocabulary file's own normalizer and pattern. No pre-token
holds white space, so a text is first cut there and the count of each distinct cut is kept too. A text that
holds one of the file's special strings, or a character on which the two could disagree, is
encoded whole by the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text_arrays import longs

LIMIT = 2048
MEMO = 400_000  # distinct strings whose counts a task keeps

# Characters on which lower-casing, normal form and classes of the pattern are plain: ASCII and
# the letters of Latin-1 and Latin Extended-A in composed form. Fixed by the Unicode standard;
# the dotted capital I, whose lower case is two characters, is left out.
UNUSUAL = r"[^\x09-\x0D\x20-\x7E¡-¬®-įı-ňŊ-ž]"

RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counts:
    """Token counts of texts under one vocabulary file."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        parts = [x["pattern"]["Regex"] for x in _parts(spec["pre_tokenizer"], "pretokenizers")
                 if x["type"] == "Split"]
        kinds = [x["type"] for x in _parts(spec["normalizer"], "normalizers")]
        self.special = [x["content"] for x in spec["added_tokens"]]
        # The shortcut is valid for this shape of file only; others are left to the library.
        self.split = None
        if len(parts) == 1 and kinds == ["NFC", "Replace", "Lowercase"]:
            self.split = regex.compile(parts[0]).findall
            self.unusual = re.compile(UNUSUAL).search
            self.whole = self._prove(spec["model"]["vocab"]) if whole is None else whole
        self.letters = {b: c for c, b in _byte_letters().items()}
        self.memo: dict[str, int] = {}  # by pre-token
        self.cuts: dict[str, int] = {}  # by string between white space

    def _prove(self, vocab: dict[str, int]) -> frozenset[str]:
        """Pre-tokens that are one token alone, each proved by encoding it."""
        letters = _byte_letters()
        strings = set()
        for token in vocab:
            word = token.removesuffix("</w>")
            try:
                strings.add(bytes(letters[c] for c in word).decode())
            except (KeyError, UnicodeDecodeError):
                continue
        strings = [s for s in strings if self.split(s) == [s] and s.lower() == s]
        codes = self.library.encode_batch(strings, add_special_tokens=False)
        return frozenset(s for s, e in zip(strings, codes) if len(e.ids) == 1)

    def of(self, text: str) -> int:
        if self.split is None or any(x in text for x in self.special) or self.unusual(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        cuts = text.lower().split()
        known = self.cuts
        new = {x for x in cuts if x not in known}
        if new:
            if len(known) + len(new) > MEMO:
                known.clear()
                new = set(cuts)
            known.update(self._count(new))
        return sum(map(known.__getitem__, cuts))

    def _count(self, cuts: set[str]) -> Iterator[tuple[str, int]]:
        """Tokens of each string: one for each whole token, merges for the other pre-tokens."""
        pieces = {x: self.split(x) for x in cuts}
        memo, whole = self.memo, self.whole
        rest = {p for found in pieces.values() for p in found if p not in whole}
        if len(memo) > MEMO:
            memo.clear()
        new = [p for p in rest if p not in memo]
        merge = self.library.model.tokenize
        memo.update((p, len(merge(self._written(p)))) for p in new)
        for x, found in pieces.items():
            yield x, sum(1 if p in whole else memo[p] for p in found)


    def _written(self, piece: str) -> str:
        """A pre-token in the characters that stand for its bytes."""
        return piece if piece.isascii() else "".join(map(self.letters.get, piece.encode()))


def _parts(spec: dict | None, name: str) -> list[dict]:
    return [] if spec is None else spec.get(name, [spec])


def _byte_letters() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write bytes as."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _counter(path: str, limit: int, whole: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path, whole)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(counts.of(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    longs(sizes),
                    longs(tokens),
                    pa.array(np.array(tokens, np.int64) > limit),
                ],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Tokens of each text: columns `doc_id`, `n_bytes`, `n_tokens`, `over_limit`.

    `path` names a vocabulary file of the tokenizers library that driver and executors can read. Counts are
    those of the library without begin, end or added special tokens, truncation or padding;
    special strings inside a text are handled as the library does by default.

    One row per input row, a null text being empty (0 bytes, 0 tokens). A null doc_id stays null,
    repeated ids give repeated rows, and no other column is read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = Counts(path)  # proves the whole tokens once; a vocabulary bounds their number
    whole = counts.whole if counts.split else None
    return texts.mapInArrow(_counter(path, limit, whole), RESULT)
