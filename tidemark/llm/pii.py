"""Personal data: patterns for four kinds, and a linear-chain conditional random field over word
shapes for what patterns miss.

One pass over the texts, no shuffle. A token is a class (its shape, its group if it is a known
word, or the sign itself) and the gap before it; its score for a label is a sum of weights of the
tokens around it. The field is trained on the driver from a small labelled table. In a task, most
tokens are proved to be outside any span: if a bound on their scores and on all transitions says
that relabelling them as outside raises every path, the best path has them outside. Viterbi then
decodes the runs between them, many at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pii_labels import LABELLED, WORDS
from tidemark.llm.text_arrays import ALNUM, CHUNK, LOWER, SPACED, chunks, constant, mix, utf8

# The kinds, in the order of results. The first four have patterns.
KINDS = ["email", "ip", "card", "phone", "name", "address", "id", "account", "secret"]
LABELS = len(KINDS) + 1  # 0 is outside
REACH = 3  # tokens to either side that a token's score looks at
GAPS = 3  # glued to the token before, after a space, after a line's end
# Steps of training, and the labelled rows that are used at most.
STEPS, MOST_ROWS = 150, 2000
# Tokens decoded together, padding included.
DECODED = 1 << 17

DIGITS, MIXED = 20, 4
GROUPS = list(WORDS)
# Classes: none, signs, numbers by length, letters and digits by length, shapes, groups of words.
_SIGN, _NUMBER = 1, 1 + 128
_MIXED = _NUMBER + DIGITS + 1
_SHAPE = _MIXED + MIXED
_WORD = _SHAPE + 12
UNITS = (_WORD + len(GROUPS)) * GAPS

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string"
)

Span = tuple[int, int, int]  # kind, start, end


# --- patterns -----------------------------------------------------------------------------------


def emails(text: str) -> Iterator[Span]:
    """Local part, at, and a dotted domain. Only the signs before an `@` can be a local part, so
    each is read once, however long a run of letters is."""
    done, at = 0, text.find("@")
    while at >= 0:
        run = text[done:at]
        start = done + len(run.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        done = at + 1
        if found:
            done = found.end()
            yield 0, start, done
        at = text.find("@", done)


def addresses(text: str) -> Iterator[Span]:
    """Four numbers up to 255 between dots; a longer chain is taken by fours."""
    for chain in DOTTED.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(parts) - len(parts) % 4, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in four)):
                yield 1, at, end
            at = end + 1


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield 2, found.start(), found.end()


def phones(text: str) -> Iterator[Span]:
    for found in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", found[0])) <= 15:
            yield 3, found.start(), found.end()


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, leftmost and without overlaps in a kind, in order."""
    return [*emails(text), *addresses(text), *cards(text), *phones(text)]


# --- tokens -------------------------------------------------------------------------------------


def _words() -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of known words, and their groups."""
    keys, groups = [], []
    for number, group in enumerate(GROUPS):
        for word in WORDS[group].split():
            data = np.frombuffer(word.encode(), np.uint8)
            keys.append(word_keys(data, np.array([0]), np.array([len(data)]))[0])
            groups.append(number)
    order = np.argsort(keys)
    return np.array(keys, np.uint64)[order], np.array(groups)[order]


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A key of the first and last eight bytes and the length: words up to 16 bytes differ."""
    padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    size = ends - starts
    column = np.arange(8)
    first = padded[starts[:, None] + 8 + column]
    first[column >= size[:, None]] = 0
    last = padded[ends[:, None] + column]
    last[column < 8 - size[:, None]] = 0
    a, b = (np.ascontiguousarray(x).view(np.uint64)[:, 0] for x in (first, last))
    return mix(mix(a + constant(5)) + b * constant(6) + size.astype(np.uint64))


_KEYS, _GROUPS = _words()
_IS_WORD = ALNUM[LOWER]
_IS_DIGIT = np.zeros(256, np.int32)
_IS_DIGIT[48:58] = 1
_IS_UPPER = np.zeros(256, np.int32)
_IS_UPPER[65:91] = 1


def _units(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and units of the tokens of `data`; a token does not cross an edge."""
    inside = _IS_WORD[data]
    solid = SPACED[data]
    joined = np.zeros(len(data), bool)  # goes on the token of the byte before
    joined[1:] = inside[1:] & inside[:-1]
    joined[edges[edges < len(data)]] = False
    starts = np.flatnonzero(solid & ~joined)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint16)
    stop = np.ones(len(data), bool)
    stop[:-1] = ~joined[1:]
    ends = np.flatnonzero(solid & stop) + 1
    size = ends - starts
    head = data[starts]
    kind = np.where(head < 128, _SIGN + head.astype(np.int64), _SIGN)

    def count(table: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(table[data], out=total[1:])
        return total[ends] - total[starts]

    digits, uppers = count(_IS_DIGIT), count(_IS_UPPER)
    word = inside[starts]
    number = word & (digits == size)
    both = word & (digits > 0) & ~number
    letters = word & (digits == 0)
    length = np.digitize(size, [2, 4, 12])  # 1, 2-3, 4-11, 12 and more
    case = np.where(uppers == 0, 0, np.where(uppers == size, 1, 2))
    title = (uppers == 1) & (_IS_UPPER[head] == 1) & (size > 1)
    # Lower and upper case by length; a capital first, shorter or longer; other mixtures.
    shape = np.where(case == 2, np.where(title, 8 + (size > 3), 10 + (size > 11)), 4 * case + length)
    kind = np.where(number, _NUMBER + np.minimum(size, DIGITS + 1) - 1, kind)
    kind = np.where(both, _MIXED + np.digitize(size, [7, 12, 20]), kind)
    kind = np.where(letters, _SHAPE + shape, kind)
    known = np.flatnonzero(letters & (size <= 16))
    keys = word_keys(LOWER[data], starts[known], ends[known])
    at = np.minimum(np.searchsorted(_KEYS, keys), len(_KEYS) - 1)
    hit = _KEYS[at] == keys
    kind[known[hit]] = _WORD + _GROUPS[at[hit]]
    # The gap before a token: none, white space, or a line's end.
    lines = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == 10, out=lines[1:])
    before = np.concatenate([[0], ends[:-1]])
    gap = np.where(starts == before, 0, np.where(lines[starts] > lines[before], 2, 1))
    gap[0] = 2
    first = np.searchsorted(starts, edges[edges <= starts[-1]])
    gap[first] = 2
    return starts, ends, (kind * GAPS + gap).astype(np.uint16)


def tokens(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_units` in pieces that end at white space, so that working memory does not follow a very
    long text. `edges` are the places where texts begin."""
    found, low = [], 0
    while low < len(data):
        high = min(len(data), low + CHUNK)
        if high < len(data):
            back = np.flatnonzero(~SPACED[data[low:high]])
            if len(back):
                high = low + int(back[-1]) + 1
            else:  # one token or many signs without a space: to the next white space
                while high < len(data) and SPACED[data[high]]:
                    ahead = np.flatnonzero(~SPACED[data[high : high + CHUNK]])
                    high = high + int(ahead[0]) if len(ahead) else min(len(data), high + CHUNK)
        here = edges[(edges >= low) & (edges < high)] - low
        starts, ends, units = _units(data[low:high], here)
        if low and len(units) and not (len(here) and here[0] <= starts[0]):
            # What the gap before the piece's first token is, the piece before it knows.
            tail = data[max(0, low - 1) : low + int(starts[0])]
            gap = 0 if not len(tail) or SPACED[tail].all() else 2 if (tail == 10).any() else 1
            units[0] = units[0] // GAPS * GAPS + gap
        found.append((starts + low, ends + low, units))
        low = high
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)
    return tuple(np.concatenate(x) for x in zip(*found))


# --- the field ----------------------------------------------------------------------------------


class Field:
    """Weights of a linear-chain field: units at each distance, and transitions.

    Any run of labelled tokens must pay for itself: against outside it gains at most the tokens'
    largest differences, the largest transition between labels, and what entering and leaving
    gain. A token in no run whose gain can reach zero is outside in the best path.
    """

    def __init__(self, around: np.ndarray, moves: np.ndarray):
        self.around, self.moves = around, moves  # (2 REACH + 1, UNITS + 1, LABELS), square
        self.bound = (around[:, :, 1:] - around[:, :, :1]).max(2)  # no less than any sum's maximum
        still = moves[0, 0]
        self.inner = float(moves[1:, 1:].max() - still)
        self.enter = float(moves[0, 1:].max() - still)
        self.leave = float(moves[1:, 0].max() - still)

    def scores(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        return sum(self.around[k][padded[at + k - REACH]] for k in range(2 * REACH + 1))

    def open(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places whose best label is not proved to be outside, in order."""
        gain = sum(self.bound[k][padded[at + k - REACH]] for k in range(2 * REACH + 1))
        at = self._paid(padded, at, gain)
        gain = np.empty(len(at))
        for low in range(0, len(at), DECODED):
            score = self.scores(padded, at[low : low + DECODED])
            gain[low : low + DECODED] = score[:, 1:].max(1) - score[:, 0]
        return self._paid(padded, at, gain)

    def _paid(self, padded: np.ndarray, at: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Places in some run of places whose gains, transitions included, may reach zero."""
        gains = np.full(len(padded), -1e4)
        # No transition leads to a text's first token or from its last.
        first, last = padded[at - 1] == 0, padded[at + 1] == 0
        gains[at] = (
            gain + self.inner + first * max(0.0, -self.enter) + last * max(0.0, -self.leave)
        )
        upto = np.concatenate([[0.0], np.cumsum(gains)])
        before = np.minimum.accumulate(upto)[at]
        after = np.maximum.accumulate(upto[::-1])[::-1][at + 1]
        return at[after - before + self.enter + self.leave - self.inner >= -1e-6]


def pad(units: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units with REACH empty places around each text, and the tokens' places in them."""
    at = np.arange(len(units)) + REACH * (texts + 1)
    padded = np.zeros(len(units) + REACH * (int(texts[-1]) + 2) if len(units) else 0, np.uint16)
    padded[at] = units + 1
    return padded, at


def decode(field: Field, units: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Best labels of tokens; `texts` is the number of each token's text, ascending."""
    labels = np.zeros(len(units), np.int8)
    if not len(units):
        return labels
    padded, at = pad(units, texts)
    places = field.open(padded, at)
    if not len(places):
        return labels
    index = np.searchsorted(at, places)
    breaks = np.flatnonzero(np.diff(places) > 1) + 1
    first = np.concatenate([[0], breaks])
    size = np.diff(np.concatenate([first, [len(places)]]))
    order = np.argsort(-size, kind="stable")
    low = 0
    while low < len(order):
        longest = int(size[order[low]])
        high = min(len(order), low + max(1, DECODED // longest))
        _viterbi(field, padded, places, index, first[order[low:high]], size[order[low:high]], labels)
        low = high
    return labels


def _viterbi(field, padded, places, index, first, size, labels) -> None:
    """Best labels of runs, the longest first. A run's neighbours are outside, or no token."""
    steps, n = int(size[0]), len(first)
    moves = field.moves
    left = np.where(padded[places[first] - 1] > 0, 1.0, 0.0)[:, None]
    last = first + size - 1
    right = np.where(padded[places[last] + 1] > 0, 1.0, 0.0)[:, None]
    back = np.zeros((steps, n, LABELS), np.int8)
    score = field.scores(padded, places[first]) + left * moves[0]
    for t in range(1, steps):
        live = int(np.searchsorted(-size, -t, "left"))  # runs longer than t
        paths = score[:live, :, None] + moves
        back[t, :live] = paths.argmax(1)
        score[:live] = paths.max(1) + field.scores(padded, places[first[:live] + t])
    now = (score + right * moves[:, 0]).argmax(1)
    for t in range(steps - 1, -1, -1):
        live = int(np.searchsorted(-size, -t, "left"))
        labels[index[first[:live] + t]] = now[:live]
        if t:
            now[:live] = back[t, np.arange(live), now[:live]]


def parse(row: str) -> tuple[str, list[Span]]:
    """Text and spans, in bytes, of a row with bracketed spans."""
    text, spans, at = "", [], 0
    for found in re.finditer(r"\[(%s)\|((?:[^\[\]]|\[\w+\])+)\]" % "|".join(KINDS), row):
        text += row[at : found.start()]
        start = len(text.encode())
        text += found[2]
        spans.append((KINDS.index(found[1]), start, len(text.encode())))
        at = found.end()
    return text + row[at:], spans


def train(rows: list[tuple[str, list[Span]]], steps: int = STEPS) -> Field:
    """Fit a field to labelled texts (spans in bytes): penalised likelihood, by full steps."""
    texts, units, gold = [], [], []
    for number, (text, spans) in enumerate(rows[:MOST_ROWS]):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, found = tokens(data, np.array([0]))
        mine = np.zeros(len(found), np.int64)
        for kind, low, high in spans:
            mine[(starts < high) & (ends > low)] = kind + 1
        texts.append(np.full(len(found), number))
        units.append(found)
        gold.append(mine)
    texts, units, gold = map(np.concatenate, (texts, units, gold))
    padded, at = pad(units, texts)
    number, size = np.unique(texts, return_counts=True)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    longest = int(size.max())
    around = np.zeros((2 * REACH + 1, UNITS + 1, LABELS))
    moves = np.zeros((LABELS, LABELS))
    places = [padded[at + k - REACH] for k in range(2 * REACH + 1)]
    same = np.flatnonzero(texts[1:] == texts[:-1])
    gold_moves = np.zeros_like(moves)
    np.add.at(gold_moves, (gold[same], gold[same + 1]), 1)
    live = [np.flatnonzero(size > t) for t in range(longest)]
    dealt = [np.argsort(u, kind="stable") for u in places]
    heads = [np.unique(u, return_index=True) for u in map(np.sort, places)]
    state = [[np.zeros_like(w), np.zeros_like(w)] for w in (around, moves)]
    for step in range(1, steps + 1):
        score = sum(w[u] for w, u in zip(around, places))
        share, pairs = _expected(score, moves, first, live)
        share[np.arange(len(gold)), gold] -= 1
        slopes = [np.zeros_like(around), pairs - gold_moves]
        for k, (unit, head) in enumerate(heads):
            slopes[0][k][unit] = np.add.reduceat(share[dealt[k]], head)
        for w, g, (mean, square) in zip((around, moves), slopes, state):
            g += 0.05 * w
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(around, moves)


def _expected(score, moves, first, live):
    """Shares of the labels of each token, and expected transitions, by forward and backward."""
    step = np.exp(moves)
    here = np.exp(score - score.max(1, keepdims=True))
    ahead, behind, size = here, np.ones_like(here), np.ones((len(here), 1))
    size[first] = here[first].sum(1, keepdims=True)
    ahead[first] /= size[first]
    here = here.copy()
    for t in range(1, len(live)):
        at = first[live[t]] + t
        ahead[at] = (ahead[at - 1] @ step) * here[at]
        size[at] = ahead[at].sum(1, keepdims=True)
        ahead[at] /= size[at]
    pairs = np.zeros_like(moves)
    for t in range(len(live) - 1, 0, -1):
        at = first[live[t]] + t
        rest = here[at] * behind[at] / size[at]
        behind[at - 1] = rest @ step.T
        pairs += step * (ahead[at - 1].T @ rest)
    return ahead * behind, pairs


def invented(draw: np.random.Generator, low: int, high: int) -> str:
    return draw.integers(97, 123, int(draw.integers(low, high))).astype(np.uint8).tobytes().decode()


def background(n: int, seed: int = 7) -> Iterator[str]:
    """Prose of invented words without personal data: sentences, repeated words, junk signs."""
    draw = np.random.default_rng(seed)
    known = [w for group in ("my", "at", "dot", "city", "host", "mail") for w in WORDS[group].split()]
    for k in range(n):
        style, words = k % 4, []
        for _ in range(int(draw.integers(3, 9))):
            word = invented(draw, 1, 16)
            if draw.random() < 0.08:
                word = known[int(draw.integers(len(known)))]
            if draw.random() < 0.05:
                word = str(draw.integers(1, 10 ** int(draw.integers(1, 5))))
            word = word.upper() if style == 3 else word.title() if draw.random() < 0.35 else word
            copies = int(draw.integers(2, 9)) if draw.random() < 0.1 else 1
            end = draw.choice(["", "", "", "", ",", ".", ".\n"])
            junk = draw.choice(["$$$", "***", "&&&", "###", "%%%"]) if style == 2 else ""
            words += [f"{word}{end if copies == 1 else ''}{junk}"] * copies
        yield ("!! " if style == 3 else " ").join(words)


def renamed(lines: list[str], seed: int = 9) -> Iterator[str]:
    """Rows with names or addresses, the words that begin with a capital replaced."""
    draw = np.random.default_rng(seed)
    street = WORDS["street"].split()

    def other(found: re.Match) -> str:
        same = found[0].lower() in street
        return found[0] if same else invented(draw, 3, 9).title()

    for line in lines:
        if "[name|" in line or "[address|" in line:
            parts = re.split(r"(\[(?:name|address)\|[^\]]+\])", line)
            words = r"(?<![|\w])[A-ZÄÖÜ][a-zà-ÿ]+|(?<=\|)[A-ZÄÖÜ][a-zà-ÿ]+"
            yield "".join(re.sub(words, other, x) if x.startswith("[") else x for x in parts)


def built_in_rows() -> list[tuple[str, list[Span]]]:
    """The labelled table, each row by itself and within a longer text, and rows without spans."""
    lines = LABELLED.splitlines()
    rows = [parse(line) for line in lines] + [parse(x) for x in renamed(lines)]
    prose = [(text, []) for text in background(2 * len(rows))]
    within = [joined(joined(p, r), q) for r, p, q in zip(rows, prose[::2], prose[1::2])]
    return rows + within + [(text, []) for text in background(100, seed=8)]


def joined(a: tuple[str, list[Span]], b: tuple[str, list[Span]]) -> tuple[str, list[Span]]:
    shift = len(a[0].encode()) + 1
    return f"{a[0]} {b[0]}", a[1] + [(k, s + shift, e + shift) for k, s, e in b[1]]


# --- the operator -------------------------------------------------------------------------------


def field_spans(field: Field, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[Span]]:
    """Spans in code points that the field finds, by row."""
    starts, ends, units = tokens(data, offsets[:-1])
    texts = np.searchsorted(offsets, starts, "right") - 1
    labels = decode(field, units, texts)
    marked = np.flatnonzero(labels)
    if not len(marked):
        return {}
    fresh = np.ones(len(marked), bool)
    fresh[1:] = (
        (np.diff(marked) > 1)
        | (labels[marked[1:]] != labels[marked[:-1]])
        | (texts[marked[1:]] != texts[marked[:-1]])
    )
    heads = np.flatnonzero(fresh)
    tails = np.concatenate([heads[1:], [len(marked)]]) - 1
    found: dict[int, list[Span]] = {}
    row, inner = -1, None
    for a, b in zip(marked[heads].tolist(), marked[tails].tolist()):
        if texts[a] != row:
            row = int(texts[a])
            mine = data[offsets[row] : offsets[row + 1]]
            inner = np.concatenate([[0], np.cumsum((mine & 0xC0) != 0x80, dtype=np.int32)])
        low = int(inner[starts[a] - offsets[row]])
        high = int(inner[ends[b] - offsets[row]])
        found.setdefault(row, []).append((int(labels[a]) - 1, low, high))
    return found


def merged(base: list[Span], more: list[Span]) -> list[Span]:
    """Base spans, and those of the field that overlap none of them."""
    taken = sorted((s, e) for _, s, e in base)
    begins = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else []
    free = []
    for span in more:
        k = int(np.searchsorted(begins, span[2])) - 1  # base spans that begin before its end
        if k < 0 or reach[k] <= span[1]:
            free.append(span)
    return sorted(base + free)


def _written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for k, s, e in spans])


_ASKS = np.zeros(256, bool)  # signs that some pattern cannot do without
_ASKS[[*b"@+0123456789"]] = True


def _finder(field: Field) -> Callable:
    around, moves = field.around.astype(np.float32), field.moves.astype(np.float32)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(around, moves)
        nothing = hashlib.sha256().hexdigest()
        for batch in batches:
            column = batch.column(1)
            every, offsets = utf8(column)
            for low, high in chunks(offsets):
                data = every[offsets[low] : offsets[high]]
                at = offsets[low : high + 1] - offsets[low]
                n = high - low
                counts = np.zeros((4, n), np.int64)
                digests, written = [nothing] * n, [""] * n
                more = field_spans(model, data, at)
                asks = np.searchsorted(at, np.flatnonzero(_ASKS[data]), "right") - 1
                for row in sorted({*np.unique(asks).tolist(), *more}):
                    base = base_spans(column[low + row].as_py())
                    for kind, _, _ in base:
                        counts[kind, row] += 1
                    if base:
                        digests[row] = hashlib.sha256(_written(base).encode()).hexdigest()
                    written[row] = _written(merged(base, more.get(row, [])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, n),
                        *(pa.array(c) for c in counts),
                        pa.array(digests, pa.string()),
                        pa.array(written, pa.string()),
                    ],
                    names=[x.split()[0] for x in RESULT.split(", ")],
                )

    return find


def personal_data(docs: DataFrame, labelled: list[str] | None = None) -> DataFrame:
    """Personal data in each text.

    Columns `doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone` (spans of the patterns), `base_sha256`
    (digest of those spans) and `spans`: theirs and the field's, as `kind:start:end` by kind and
    start, in code points, the end exclusive. A span of the field that overlaps one of the patterns
    is left out. Kinds are those of `KINDS`, in that order.

    `labelled` are rows for training as in `LABELLED`, which is used without it; at most `MOST_ROWS`
    of them. One row per input row: a null text is empty, a null doc_id stays null, repeated rows
    are repeated, and extra columns are ignored. Texts are read whole, whatever their length.
    """
    rows = built_in_rows() if labelled is None else [parse(x) for x in labelled]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_finder(train(rows)), RESULT)
