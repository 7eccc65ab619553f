"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled text are told apart by an additive logistic model over binned
text statistics, trained to minimise the non-negative unbiased risk
    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])
with logistic loss. The class prior pi is estimated from positives and unlabelled rows alone: a
first model ranks them, and pi is the ratio of how many unlabelled and how many positive rows
score above a bar, at the bar where its upper confidence bound is smallest.

Scale. About FIT_ROWS ids of either kind, drawn by a hash, are brought to the driver, as one row
of a dozen numbers each. Scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import maybe_broadcast
from tidemark.llm.text_arrays import SPACED, chunks, longs, utf8, word_hashes, word_spans

FIT_ROWS = 20_000
BINS = 24
STEPS = 300
THRESHOLD = 0.3
N_STATS = 13

RESULT = "doc_id long, score double, predicted int"


def _class(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text.encode())] = True
    return out


UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | _class("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
DIGIT = _class("0123456789")
SYMBOL = _class("#*$%&|<>@^~{}[]=+_/\\")
BANG = _class("!?")
STOP = _class(".,;:'\"()-")
HIGH = np.arange(256) >= 128


def statistics(column: pa.Array) -> np.ndarray:
    """One row of numbers per text."""
    data, offsets = utf8(column)
    out = np.zeros((len(column), N_STATS))
    for low, high in chunks(offsets):
        part = data[offsets[low] : offsets[high]]
        at = offsets[low : high + 1] - offsets[low]
        size = np.maximum(np.diff(at), 1)

        def share(kind: np.ndarray) -> np.ndarray:
            total = np.r_[0, np.cumsum(kind[part])]
            return total[at[1:]] - total[at[:-1]]

        starts, ends, first = word_spans(part, at, SPACED)
        words = np.diff(first)
        n = np.maximum(words, 1)
        value = word_hashes(part, starts, ends)
        same = np.zeros(len(value), np.int64)
        same[1:] = value[1:] == value[:-1]
        same[first[:-1][words > 0]] = 0
        again = np.r_[0, np.cumsum(same)]
        length = np.r_[0, np.cumsum(ends - starts)]
        kinds = np.array([len(np.unique(value[a:b])) for a, b in zip(first[:-1], first[1:])])
        alone = _class("\n")
        out[low:high] = np.stack(
            [
                np.log1p(words),
                (length[first[1:]] - length[first[:-1]]) / n,
                share(UPPER) / size,
                share(DIGIT) / size,
                share(SYMBOL) / n,
                share(BANG) / n,
                share(STOP) / n,
                share(HIGH) / size,
                share(LETTER) / size,
                share(alone) / n,
                kinds / n,
                np.log1p(words) * kinds / n,
                (again[first[1:]] - again[first[:-1]]) / n,
            ],
            axis=1,
        )
    return out


class Additive:
    """A logistic model with one weight per bin of each statistic."""

    def __init__(self, rows: np.ndarray):
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, shares)) for c in rows.T]
        self.first = np.r_[0, np.cumsum([len(e) + 1 for e in self.edges])]
        self.weight = np.zeros(self.first[-1])
        self.bias = 0.0

    def place(self, rows: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, c, "left") for e, c in zip(self.edges, rows.T)]
        return np.stack(bins, axis=1) + self.first[:-1]

    def margin(self, place: np.ndarray) -> np.ndarray:
        return self.weight[place].sum(axis=1) + self.bias

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> None:
        """Without a prior: positives against unlabelled rows. Adam on all rows at once."""
        p, u = self.place(positive), self.place(unlabelled)
        rate, decay = 0.1, 1e-4
        moment, square = np.zeros(len(self.weight) + 1), np.zeros(len(self.weight) + 1)

        def gradient(place: np.ndarray, slope: np.ndarray) -> np.ndarray:
            flat = np.bincount(
                place.ravel(), np.repeat(slope, place.shape[1]), len(self.weight)
            )
            return np.r_[flat, slope.sum()]

        for step in range(1, STEPS + 1):
            gp, gu = self.margin(p), self.margin(u)
            up_p, up_u = _sigmoid(gp), _sigmoid(gu)
            as_positive = gradient(p, (up_p - 1) / len(p))
            u_negative = gradient(u, up_u / len(u))
            if prior is None:
                grad = as_positive + u_negative
            else:
                p_negative = gradient(p, up_p / len(p))
                risk = _softplus(gu).mean() - prior * _softplus(gp).mean()
                negative = u_negative - prior * p_negative
                grad = prior * as_positive + negative if risk >= 0 else -negative
            grad = grad + decay * np.r_[self.weight, 0.0]
            moment = 0.9 * moment + 0.1 * grad
            square = 0.999 * square + 0.001 * grad * grad
            move = rate * (moment / (1 - 0.9**step)) / (
                np.sqrt(square / (1 - 0.999**step)) + 1e-8
            )
            self.weight -= move[:-1]
            self.bias -= move[-1]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(self.place(rows)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled rows, on the halves that the ranking has not seen."""
    model = Additive(np.concatenate([positive, unlabelled]))
    model.fit(positive[::2], unlabelled[::2], None)
    p, u = np.sort(model.score(positive[1::2])), np.sort(model.score(unlabelled[1::2]))
    if not len(p) or not len(u):
        return 0.5
    best, found = np.inf, 0.5
    for share in np.linspace(0.2, 0.98, 40):
        bar = p[int((1 - share) * (len(p) - 1))]
        of_p = (p >= bar).mean()
        of_u = (u >= bar).mean()
        margin = np.sqrt(of_u / len(u)) + np.sqrt(of_p / len(p))
        if (of_u + margin) / of_p < best:
            best, found = (of_u + margin) / of_p, of_u / of_p
    return float(np.clip(found, 0.01, 0.99))


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = statistics(batch.column(2))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), N_STATS).cast(
                    pa.list_(pa.float64())
                ),
            ],
            names=["doc_id", "positive", "stats"],
        )


def learn(texts: DataFrame, marks: DataFrame, n_docs: int) -> Additive | None:
    """The model from texts (doc_id, text) and the marks (doc_id, good) that may be used."""
    marks = marks.groupBy("doc_id").agg(F.max("good").alias("good"))
    kinds = marks.agg(F.count("*").alias("n"), F.sum("good").alias("good")).first()
    total = {True: kinds.good or 0, False: max(1, n_docs - (kinds.n or 0))}
    joined = texts.join(maybe_broadcast(marks, 40 * (kinds.n or 0)), "doc_id", "left")
    joined = joined.where("good is null or good = 1").select(
        "doc_id", F.col("good").isNotNull().alias("positive"), "text"
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    bar = F.when(F.col("positive"), FIT_ROWS / max(1, total[True])).otherwise(
        FIT_ROWS / total[False]
    )
    drawn = joined.where(draw < bar).mapInArrow(
        _collect, "doc_id long, positive boolean, stats array<double>"
    )
    # One row an id, so that an id with any share of the rows stays one of about FIT_ROWS.
    drawn = drawn.groupBy("doc_id", "positive").agg(F.min("stats").alias("stats"))
    rows = drawn.toPandas().sort_values(["doc_id"], kind="stable")
    if not rows["positive"].any() or rows["positive"].all():
        return None
    stats = np.array(rows["stats"].tolist())
    positive, unlabelled = stats[rows["positive"]], stats[~rows["positive"]]
    model = Additive(np.concatenate([positive, unlabelled]))
    model.fit(positive, unlabelled, estimate_prior(positive, unlabelled))
    return model


def _score(model: Additive | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            score = np.full(n, 0.5) if model is None else model.score(statistics(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "score", "predicted"],
            )

    return run


def held_out():
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return F.coalesce(fold == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of each text: columns `doc_id`, `held_out`, `score`, `predicted`.

    Positives are documents whose label `quality` is 1 and that are not held out (crc32 of the
    doc_id's text modulo 5 is not 0); unlabelled are those without a usable label; rows labelled
    0 are not used. A document with several labels takes the largest, null ones not counting.
    `predicted` is 1 from a score of 0.3 on.

    One row per input row, scored by its text alone; a null text is empty. A null doc_id stays
    null and is not held out. Without positives or unlabelled rows every score is 0.5.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good")
    ).where("doc_id is not null and good is not null")
    model = learn(texts, marks.where(~held_out()), docs.count())
    found = texts.mapInArrow(_score(model), RESULT)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
