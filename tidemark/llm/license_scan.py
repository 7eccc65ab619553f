"""License scans: Aho-Corasick finds notice phrases and identifier tags, and a shunting-yard
parser evaluates the licence expressions that follow a tag.

One pass over the texts, no shuffle. A text is reduced to its words, one space apart, so that a
phrase is found as consecutive words whatever stands between them; all phrases are looked for at
once. Only texts with a tag are read again for the expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text_arrays import ALNUM, LOWER, longs

# Notice phrases and the labels they stand for.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "boost software license": "boost",
    "isc license": "isc",
    "creative commons": "cc",
    "licensed under cc": "cc",
    "cc by": "cc",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
# Identifiers in tags, up to their version or clause, and their labels.
IDENTIFIERS = {
    "mit": "mit",
    "apache": "apache",
    "gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "mpl": "mpl",
    "epl": "epl",
    "bsd": "bsd",
    "bsl": "boost",
    "isc": "isc",
    "cc0": "public-domain",
    "cc": "cc",
    "unlicense": "public-domain",
}
# How freely a text under the label may be used, 0 to 1.
FREEDOM = {
    "public-domain": 1.0, "mit": 1.0, "isc": 1.0, "bsd": 1.0, "boost": 1.0, "apache": 1.0,
    "cc": 0.6, "mpl": 0.5, "epl": 0.5, "lgpl": 0.4, "gpl": 0.2, "agpl": 0.1, "proprietary": 0.0,
}
TAG = "spdx license identifier"
TAG_TEXT = re.compile(r"spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier\s*:?")
TOKEN = re.compile(r"\(|\)|[0-9a-z][0-9a-z.+-]*")
BINDS = {"with": 3, "and": 2, "or": 1}

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


IDENTIFIER = re.compile(
    "(%s)(?=v?[0-9]|[-+.]|$)" % "|".join(sorted(IDENTIFIERS, key=len, reverse=True))
)


def identifier_label(name: str) -> str:
    """The label of an identifier, whose name ends at a hyphen, a plus, a dot or its version; one
    that is not known is its own label."""
    known = IDENTIFIER.match(name)
    return IDENTIFIERS[known[1]] if known else name.rstrip("+.-")


def to_postfix(tokens: Iterable[str]) -> list[str]:
    """Dijkstra's shunting yard over identifiers, and / or / with, and parentheses.

    Reading stops at the first token that cannot continue the expression, so prose after an
    expression is not part of it.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = True  # an identifier or an opening parenthesis may come
    for token in tokens:
        if token in BINDS:
            if operand:
                break
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        elif token == "(":
            if not operand:
                break
            waiting.append(token)
        elif token == ")":
            if operand or "(" not in waiting:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            if not operand:
                break
            out.append(token)
            operand = False
    if operand and waiting and waiting[-1] in BINDS:
        waiting.pop()  # an operator with nothing after it
    out += [x for x in reversed(waiting) if x != "("]
    return out


def evaluate(tokens: Iterable[str]) -> tuple[set[str], float | None]:
    """Labels named in an expression and the freedom it grants: the best of `or`, the worst of
    `and`; an exception after `with` leaves the licence as it is."""
    stack: list[tuple[set[str], float]] = []
    for token in to_postfix(tokens):
        if token not in BINDS:
            label = identifier_label(token)
            stack.append(({label}, FREEDOM.get(label, 0.5)))
            continue
        if len(stack) < 2:
            break
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(left)
        else:
            pick = max if token == "or" else min
            stack.append((left[0] | right[0], pick(left[1], right[1])))
    if not stack:
        return set(), None
    return stack[0]


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in [*BASE_PHRASES.items(), *MORE_PHRASES.items(), (TAG, None)]:
        found.add_word(f" {phrase} ", (label, len(phrase) + 2, phrase in BASE_PHRASES))
    found.make_automaton()
    return found


# Every byte as itself in lower case if it may stand in a word, else as a space.
WORD_BYTES = bytes(np.where(ALNUM[LOWER], LOWER, 32).astype(np.uint8))


def scan(text: bytes, automaton) -> tuple:
    """The result columns after doc_id for one text."""
    words = text.translate(WORD_BYTES).split()
    joined = " " + " ".join([w.decode("latin-1") for w in words]) + " " if words else ""
    base, places, labels, freedom = [], [], set(), []
    counted, upto = 0, 0
    tagged = False
    for end, (label, length, is_base) in automaton.iter(joined):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        freedom.append(FREEDOM[label])
        if is_base:
            start = end - length + 1
            counted += joined.count(" ", upto, start)
            upto = start
            places.append(counted)
            base.append(label)
    if tagged:
        lowered = text.translate(bytes(LOWER)).decode("latin-1")
        tags = list(TAG_TEXT.finditer(lowered))
        # An expression goes to the end of its line, or to the next tag there.
        for tag, stop in zip(tags, [*(x.start() for x in tags[1:]), len(lowered)]):
            line = lowered.find("\n", tag.end(), stop)
            rest = TOKEN.finditer(lowered, tag.end(), stop if line < 0 else line)
            named, value = evaluate(x[0] for x in rest)
            labels |= named
            if value is not None:
                freedom.append(value)
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(set(base))),
        ",".join(sorted(labels)),
        min(freedom, default=1.0),
    )


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary() if pa.types.is_large_string(
            batch.column(1).type) else pa.binary())
        rows = [scan(x.as_py() or b"", automaton) for x in texts]
        columns = zip(*rows) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=[x.split()[0] for x in RESULT.split(", ")],
        )


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence notices of each text.

    Columns `doc_id`, `n_words`, `n_base` (places of the three base phrases), `first_word` and
    `last_word` (their smallest and largest start, null without any), `base_labels`, `labels`
    (with those of further phrases and of identifier expressions; both distinct, sorted and
    comma-joined) and `score`: how freely the text may be used by what it says, 1 without notice.
    Notices are found, not understood: "not under the mit license" names that license too.

    Words are runs of letters, digits and bytes over 7F, with A-Z lower-cased; a phrase's words
    stand consecutively, whatever separates them. One row per input row, a null text being empty;
    a null doc_id stays null and repeated rows are repeated.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_scanner, RESULT)
