"""N-gram Jaccard join by universe partitioning: exact components of near-equal documents.

Every possible shingle hashes to one of a band's segments, so a document is cut into segment
subsets. Two sets that differ in at most D shingles agree on one of any D + 1 segments, or differ
by one shingle in a segment that is counted twice. A band of sizes has its own number of segments
and its own share of segments that are indexed with their one-deletion neighbourhoods; both come
from a cost model. Of the other segments a document indexes the first D + 1 that are worth it: not
empty, and not made of shingles alone that a sample shows to be frequent. Whether a segment is
worth it depends on its content only, so of two similar documents the one that gets by with fewer
segments has one among them that both index. A document with too few such segments indexes all.
Documents that meet under any signature are compared by parity sketches, which show for certain
that two sets are too far apart; what is left are candidates, and candidates are verified exactly.

Scale. A document sends about one signature per nine shingles (at 0.9) and no shingle at all.
Equal sets within an Arrow batch are folded before the shuffle, and so is a signature that many of
its rows carry: one that a third of all rows has is one row per batch. How many unlike documents
meet under some signature grows with the table, so meetings alone would chain ever more of it into
one component. They are compared first: each group's smallest id with the others, then the members
of a group that are still apart. Groups of more than WIDE sets stay as they meet. Verification
moves each candidate's text once, into cells of bounded size; it counts overlaps inside the cell
and emits a spanning forest of the links, not the links. Components of several cells are first cut
by signatures under other hash families.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, components, maybe_broadcast, trimmed
from tidemark.llm.text_arrays import (
    LOWER,
    SPACED,
    chunks,
    constant,
    gram_hashes,
    long_lists,
    longs,
    mix,
    ranges,
    utf8,
    word_hashes,
    word_spans,
)

GROWTH = 1.5  # of band limits, at least; wider where partners may differ more in size
BACKGROUND = 0.001  # share of shingles that unlike documents are expected to have in common
PAIR_COST = 0.2  # of verifying a false candidate, in signature rows
RISK = 1e-3  # of a document having too few segments worth indexing
SAMPLE_DOCS = 10_000  # documents that frequent shingles are looked for in, about
FREQUENT = 3  # of them that a frequent shingle is in
MAX_FREQUENT = 200_000  # frequent shingles that are kept; any set of them gives the same result
CELL_SHINGLES = 400_000  # of a verification cell
MANY = 64  # unlike rows of a batch from which on a signature they share is folded
WIDE = 2_000  # sets from which on a group is not compared
COMPARED = 1 << 18  # words of parity sketches that are compared at once
PARITIES = 1 << 16  # bits of a parity sketch, at most; a short one lets more pairs pass
FAMILIES = 4  # hash families that components of several cells are cut by, at most, with the first

# The lowest bit of a signature tells whether its row speaks for others of its batch (`near`).
SKETCH = (
    "doc_id long, n_shingles long, h1 long, h2 long, sigs array<long>, near array<long>, "
    "parity array<long>"
)


class Band(NamedTuple):
    """Sizes low..high; segments 0..deletable-1 allow one difference, the others none."""

    low: int
    high: int
    segments: int
    deletable: int


def units(size, num: int, den: int):
    """D + 1, for D the most shingles by which a set of this size and a partner of at least its
    size can differ: |R xor S| <= |R| (1 - t) / t."""
    return size * (den - num) // num + 1


def _slack(exact: int, used: list[tuple[int, int]], deletable: int) -> int:
    """Extra exact segments, in place of the empty ones.

    `used` has, for some sizes of the band, how many exact segments they need; how many of those
    and the extra ones are empty is close to a Poisson count.
    """
    if exact == 0 or exact + deletable == 1:
        return 0
    extra = 0
    while extra < exact:
        segments = exact + extra + deletable
        mean = max((n + extra) * math.exp(-size / segments) for size, n in used) + 1e-12
        if mean > 50:
            tail = 0.5 * math.erfc((extra + 0.5 - mean) / math.sqrt(2 * mean))
        else:
            tail = 1 - sum(math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
                           for k in range(extra + 1))
        if tail < RISK:
            return extra
        extra += max(1, extra // 16)
    return exact


def allocate(low: int, high: int, n_docs: int, num: int, den: int) -> Band:
    """The cheapest split of a band's units into exact and one-deletion segments."""
    need = units(high, num, den)
    best = None
    for deletable in sorted({*range(min(12, need // 2) + 1), (need + 1) // 2}):
        exact = max(0, need - 2 * deletable)
        sizes = (low, (low + high) // 2, high)
        used = [(x, max(0, units(x, num, den) - 2 * deletable)) for x in sizes]
        slack = _slack(exact, used, deletable)
        segments = exact + slack + deletable
        if not segments:
            continue
        share = low / segments
        apart = 2 * share * (1 - BACKGROUND)
        same = math.exp(-apart) - math.exp(-2 * share) if exact else 0.0
        near = (1 + apart) * math.exp(-apart)
        rows = exact + deletable * (1 + (low + high) / 2 / segments)
        false = n_docs * (exact * same + deletable * near)
        cost = rows + PAIR_COST * false
        if best is None or cost < best[0]:
            best = (cost, Band(low, high, segments, deletable))
    return best[1]


def plan_bands(n_docs: int, num: int, den: int) -> list[Band]:
    """Bands for every size up to 2^31. Sizes that allow no difference share the first."""
    first = num // (den - num) if den > num else 1 << 31
    while first > 1 and units(first, num, den) > 1:
        first -= 1
    out = [Band(1, max(first, 1), 1, 0)]
    growth = max(GROWTH, (den / num) ** 3)
    while out[-1].high < 1 << 31:
        low = out[-1].high + 1
        high = max(low, int(low * growth))
        out.append(allocate(low, high, max(1, n_docs // 4), num, den))
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """Distinct shingle hashes of each row, sorted within the row, and their counts."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, SPACED)
    words = word_hashes(data, starts, ends)
    grams = gram_hashes(words, width)
    sets = []
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
        elif b > a:  # fewer words than a shingle has: the whole sequence
            sets.append(gram_hashes(words[a:b], b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    counts = np.array([len(x) for x in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), counts


class Signer:
    """Signatures of sets under a list of bands and a sorted array of frequent shingles."""

    def __init__(self, bands: list[Band], frequent: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        self.frequent = frequent
        self.low = np.array([b.low for b in bands], np.int64)
        self.segments = np.array([b.segments for b in bands], np.int64)
        self.deletable = np.array([b.deletable for b in bands], np.int64)

    def sign(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures and the rows they belong to. A set is indexed in its own band, and looks
        for larger partners in the bands above that a partner can fall into."""
        own = np.searchsorted(self.low, counts, "right") - 1
        top = np.searchsorted(self.low, counts * self.den // self.num, "right") - 1
        rare = np.ones(len(flat), bool)
        if len(self.frequent):
            at = np.searchsorted(self.frequent, flat)
            rare = self.frequent[np.minimum(at, len(self.frequent) - 1)] != flat
        found, rows = [], []
        step = 0
        while True:
            docs = np.flatnonzero((counts > 0) & (own + step <= top))
            if not len(docs):
                break
            sigs, of = self._sign(flat, rare, counts, docs, own[docs] + step)
            found.append(sigs)
            rows.append(of)
            step += 1
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(rows)

    def _sign(self, flat, rare, counts, docs, band):
        size = counts[docs]
        begin = (np.cumsum(counts) - counts)[docs]
        take = ranges(begin, size)
        value = flat[take]
        doc = np.repeat(np.arange(len(docs)), size)
        m, deletable = self.segments[band], self.deletable[band]
        need = units(size, self.num, self.den)
        dels = np.minimum(deletable, (need + 1) // 2)
        rest = np.maximum(0, need - 2 * dels)
        # A segment is a range of hash values, so it is a run of the sorted set.
        seg = ((value >> np.uint64(32)) * m[doc].astype(np.uint64)) >> np.uint64(32)
        seg = seg.astype(np.int64)
        new = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (doc[1:] != doc[:-1])])
        part = mix(value ^ constant(4))
        sums = np.add.reduceat(part, new)
        gdoc, gseg = doc[new], seg[new]
        is_del = gseg < dels[gdoc]
        exact = gseg >= deletable[gdoc]
        # The first segments that are worth it, as many as needed; all where there are too few.
        worth = exact & (np.add.reduceat(rare[take].astype(np.int64), new) > 0)
        so_far = np.cumsum(worth)
        first = np.searchsorted(gdoc, np.arange(len(docs)))
        rank = so_far - (so_far[first] - worth[first])[gdoc]
        poor = np.bincount(gdoc[worth], minlength=len(docs)) < rest
        is_exact = (worth & (rank <= rest[gdoc])) | (exact & poor[gdoc])

        def key(total, segment, which):
            place = segment.astype(np.uint64) * constant(5) + band[which].astype(np.uint64)
            return mix(total + mix(place + constant(6)))

        used = is_exact | is_del
        sigs = [key(sums[used], gseg[used], gdoc[used])]
        rows = [docs[gdoc[used]]]
        if is_del.any():
            length = np.diff(np.r_[new, len(value)])[is_del]
            at = ranges(new[is_del], length)
            group = np.repeat(np.flatnonzero(is_del), length)
            sigs.append(key(sums[group] - part[at], gseg[group], gdoc[group]))
            rows.append(docs[gdoc[group]])
        # Empty subsets: of deletable segments, and of all segments of a poor set.
        lacking = poor | (np.bincount(gdoc[is_del], minlength=len(docs)) < dels)
        for i in np.flatnonzero(lacking):
            wanted = np.arange(dels[i])
            if poor[i]:
                wanted = np.r_[wanted, np.arange(deletable[i], m[i])]
            empty = np.setdiff1d(wanted, gseg[gdoc == i])
            which = np.full(len(empty), i)
            sigs.append(key(np.zeros(len(empty), np.uint64), empty, which))
            rows.append(docs[which])
        return np.concatenate(sigs), np.concatenate(rows)


def _shingles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in chunks(offsets):
                at = offsets[a : b + 1] - offsets[a]
                flat, _ = shingle_sets(data[offsets[a] : offsets[b]], at, width)
                yield pa.RecordBatch.from_arrays([longs(flat)], names=["gram"])

    return run


def frequent_shingles(docs: DataFrame, n_docs: int, width: int) -> np.ndarray:
    """Shingles of several documents of a sample, at most MAX_FREQUENT, the most frequent first."""
    share = min(1.0, SAMPLE_DOCS / max(1, n_docs))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 40)) < int(share * (1 << 40))
    grams = docs.where(drawn).select("text").mapInArrow(trimmed(_shingles(width)), "gram long")
    often = grams.groupBy("gram").count().where(F.col("count") >= FREQUENT)
    rows = often.orderBy(F.desc("count"), "gram").limit(MAX_FREQUENT).select("gram").toArrow()
    return np.sort(np.asarray(rows.column(0).combine_chunks()).view(np.uint64))


def recode(flat: np.ndarray, counts: np.ndarray, family: int) -> np.ndarray:
    """The sets under another hash family, sorted within each row; family 0 leaves them."""
    if not family:
        return flat
    value = mix(flat ^ constant(40 + family))
    return value[np.lexsort((value, np.repeat(np.arange(len(counts)), counts)))]


def parities(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches of sets, and the words of each: bit k is the parity of how many shingles
    hash to k. The bits are two to four times the shingles, a power of two."""
    bits = 1 << np.ceil(np.log2(np.maximum(2 * counts, 64))).astype(np.int64)
    bits = np.where(counts > 0, np.minimum(bits, PARITIES), 0)
    at = np.repeat(np.cumsum(bits) - bits, counts)
    place = mix(flat ^ constant(9)) & np.repeat(np.maximum(bits, 1) - 1, counts).astype(np.uint64)
    odd = np.bincount(at + place.astype(np.int64), minlength=int(bits.sum())) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64), bits // 64


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of parity sketches as they would be with fewer words."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def may_link(a, b, sizes_a, sizes_b, num: int, den: int) -> np.ndarray:
    """Whether sets can link by their parity sketches, row by row: two sets differ by as many
    shingles at least as their sketches by bits, and den * I >= num * U is
    (den - num) * (|A| + |B|) >= (den + num) * |A xor B|."""
    words = min(a.shape[1], b.shape[1])
    apart = np.bitwise_count(folded(a, words) ^ folded(b, words)).sum(axis=1, dtype=np.int64)
    apart = np.maximum(apart, np.abs(sizes_a - sizes_b))
    return (den - num) * (sizes_a + sizes_b) >= (den + num) * apart


def _sketcher(
    bands: list[Band], frequent: np.ndarray, width: int, num: int, den: int, family: int = 0
):
    """Rows (doc_id, text) into SKETCH. Under a family over 0 a third column names a row's
    component, and only rows of one component share signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(
            bands, recode(frequent, np.array([len(frequent)]), family), num, den
        )
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            doc = np.asarray(ids.fill_null(0))
            cc = np.asarray(batch.column(2)).astype(np.uint64) if family else None
            data, offsets = utf8(batch.column(1))
            sizes, h1, h2 = (np.zeros(len(ids), t) for t in (np.int64, np.uint64, np.uint64))
            sigs, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            odd, words = [np.zeros(0, np.uint64)], np.zeros(len(ids), np.int64)
            for low, high in chunks(offsets):
                at = offsets[low : high + 1] - offsets[low]
                flat, counts = shingle_sets(data[offsets[low] : offsets[high]], at, width)
                sizes[low:high] = counts
                ends = np.cumsum(counts)
                for out, salt in ((h1, 7), (h2, 8)):
                    total = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(flat ^ constant(salt)))]
                    out[low:high] = mix(total[ends] - total[ends - counts])
                parity, words[low:high] = parities(flat, counts)
                odd.append(parity)
                counts = np.where(known[low:high], counts, 0)
                if not known[low:high].all():
                    flat, _ = shingle_sets(*_blanked(data, offsets, known, low, high), width)
                found, of = signer.sign(recode(flat, counts, family), counts)
                if family:
                    found = mix(found ^ mix(cc[of + low]))
                sigs.append(found)
                rows.append(of + low)
            sig, row = np.concatenate(sigs) & ~np.uint64(1), np.concatenate(rows)
            # Of rows with equal sets the smallest id speaks, and of many that share a signature.
            order = np.lexsort((doc[row], h1[row], sig))
            sig, row = sig[order], row[order]
            own = np.ones(len(sig), bool)
            own[1:] = (sig[1:] != sig[:-1]) | (h1[row[1:]] != h1[row[:-1]])
            sig, row = sig[own], row[own]
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            group = np.cumsum(new) - 1
            many = (np.bincount(group) >= MANY)[group] if len(sig) else new
            head = row[new][group]
            new |= ~many
            sig |= many.astype(np.uint64)
            pairs = np.stack([row[~new], doc[head[~new]]])
            pairs = pairs[:, doc[pairs[0]] != pairs[1]]
            pairs = np.unique(pairs, axis=1) if pairs.size else pairs
            keep = np.argsort(row[new], kind="stable")
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    longs(sizes),
                    longs(h1),
                    longs(h2),
                    long_lists(sig[new][keep], row[new][keep], len(ids)),
                    long_lists(pairs[1], pairs[0], len(ids)),
                    long_lists(np.concatenate(odd), np.repeat(np.arange(len(ids)), words), len(ids)),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "sigs", "near", "parity"],
            )

    return run


def _blanked(data, offsets, known, low, high):
    """The texts of a chunk with those of unknown rows emptied."""
    lengths = np.where(known[low:high], np.diff(offsets[low : high + 1]), 0)
    return data[ranges(offsets[low:high], lengths)], np.r_[0, np.cumsum(lengths)]


def linked(flat: np.ndarray, counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """Component labels of sets under `den * intersection >= num * union`, counted exactly.

    Each set outside one main component is compared with all sets through an inverted index, so
    only pairs inside the main component go uncompared, and those are connected already.
    """
    n = len(counts)
    label = np.arange(n)
    begin = np.cumsum(counts) - counts
    _, code = np.unique(flat, return_inverse=True)
    holder = np.repeat(np.arange(n), counts)[np.argsort(code, kind="stable")]
    width = np.bincount(code)
    first = np.cumsum(width) - width

    def compare(i: int) -> None:
        mine = code[begin[i] : begin[i] + counts[i]]
        shared = np.bincount(holder[ranges(first[mine], width[mine])], minlength=n)
        # 100 I >= 90 (a + b - I), as I (den + num) >= num (a + b)
        hits = np.flatnonzero((shared * (den + num) >= num * (counts + counts[i])) & (shared > 0))
        joined = np.unique(label[np.r_[hits, i]])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]

    done = np.zeros(n, bool)
    for i in range(min(n, 4)):
        compare(i)
        done[i] = True
    main = np.bincount(label).argmax()
    keeper = int(np.flatnonzero(label == main)[0])
    for i in range(n):
        if not done[i] and label[i] != label[keeper]:
            compare(i)
    return label


def _verifier(width: int, num: int, den: int):
    def links(doc: np.ndarray, texts: pa.Array):
        data, offsets = utf8(texts)
        parts = [
            shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
            for a, b in chunks(offsets)
        ]
        label = linked(
            np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), num, den
        )
        root = np.full(len(doc), np.iinfo(np.int64).max)
        np.minimum.at(root, label, doc)
        return root[label], doc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for cell in cells(batches):
            a, b = links(np.asarray(cell.column(2)), cell.column(3).combine_chunks())
            apart = a != b
            held.append(
                pa.RecordBatch.from_arrays([longs(a[apart]), longs(b[apart])], names=["a", "b"])
            )
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from table.to_batches()

    return run


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each run of equal values in the first two columns, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        low = 0
        for high in [*cuts.tolist(), batch.num_rows]:
            key = (a[low], b[low])
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
            low = high
    if held:
        yield pa.Table.from_batches(held)


def _verify(ws, placed: DataFrame, docs: DataFrame, params, name: str) -> DataFrame:
    """Links within cells. `placed` has (cc, cell, doc_id); texts come from `docs`."""
    width, num, den = params
    placed = ws.save(placed, f"{name}-cells")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = texts.join(maybe_broadcast(placed, 64 * placed.count()), "doc_id")
    rows = joined.select("cc", "cell", "doc_id", "text")
    rows = rows.repartition("cc", "cell").sortWithinPartitions("cc", "cell", "doc_id")
    found = rows.mapInArrow(trimmed(_verifier(width, num, den)), "a long, b long")
    return ws.save(found, f"{name}-links")


def _rows(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists, and where those of each row begin."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = np.asarray(lists.values)[offsets[0] : offsets[-1]].view(np.uint64)
    return flat, offsets - offsets[0]


def _stacked(flat: np.ndarray, begin: np.ndarray, words: int) -> np.ndarray:
    return flat[begin[:, None] + np.arange(words)]


def _pair_filter(num: int, den: int):
    """Of pairs with their sizes and parity sketches those that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes_a, sizes_b = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            (a, at_a), (b, at_b) = _rows(batch.column(4)), _rows(batch.column(5))
            words = np.stack([np.diff(at_a), np.diff(at_b)], axis=1)
            keep = np.zeros(batch.num_rows, bool)
            for x, y in np.unique(words, axis=0):
                i = np.flatnonzero((words == (x, y)).all(axis=1))
                keep[i] = may_link(
                    _stacked(a, at_a[i], x), _stacked(b, at_b[i], y), sizes_a[i], sizes_b[i], num, den
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(batch.column(k))[keep]) for k in range(2)], names=["a", "b"]
            )

    return run


def joinable(root, size, flat, begin, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of a group's rows that may link and join rows of unlike `root`, a forest of them."""
    label = np.unique(root, return_inverse=True)[1]
    words = np.diff(begin)
    kinds = [
        (w, rows, _stacked(flat, begin[rows], w))
        for w in np.unique(words).tolist() for rows in [np.flatnonzero(words == w)]
    ]
    out = []
    for k, (w, rows, sketches) in enumerate(kinds):
        for other, later, theirs in kinds[k:]:
            theirs = folded(theirs, w)
            step = max(1, COMPARED // (len(later) * w))
            for low in range(0, len(rows), step):
                i, j = np.nonzero(label[rows[low : low + step], None] != label[later])
                if other == w:
                    i, j = i[j > i + low], j[j > i + low]
                if not len(i):
                    continue
                mine, yours = rows[low + i], later[j]
                hits = may_link(
                    sketches[low + i], theirs[j], size[mine], size[yours], num, den
                )
                for x, y in zip(mine[hits].tolist(), yours[hits].tolist()):
                    if label[x] != label[y]:
                        out.append((x, y))
                        label[label == label[y]] = label[x]
    return out


def _group_filter(num: int, den: int):
    """From rows sorted by group: pairs that may link and are not of one root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((0, 2), np.int64)]
        for cell in cells(batches):
            doc, root, size = (np.asarray(cell.column(k)) for k in range(2, 5))
            flat, begin = _rows(cell.column(5).combine_chunks())
            found = joinable(root, size, flat, begin, num, den)
            if found:
                held.append(doc[np.array(found)])
        found = np.concatenate(held)
        yield pa.RecordBatch.from_arrays([longs(found[:, 0]), longs(found[:, 1])], names=["a", "b"])

    return run


def _groups(ws: Workspace, sketch: DataFrame, name: str) -> DataFrame:
    """Distinct lists `docs` of documents that meet under a signature, one for each set. A `wide`
    group is lists of two: its smallest id and another."""
    by_sig = sketch.select("doc_id", "h1", F.explode("sigs").alias("sig")).select(
        "doc_id", "h1", F.expr("sig & ~1L").alias("key"), F.expr("sig & 1L").alias("many")
    )
    group = Window.partitionBy("key")
    by_sig = by_sig.withColumns({"low": F.min("h1").over(group), "high": F.max("h1").over(group)})
    sets = by_sig.where("low <> high").groupBy("key", "h1").agg(
        F.min("doc_id").alias("doc"), F.max("many").alias("many")
    )
    wide = (F.max("many").over(group) > 0) | (F.count("*").over(group) > WIDE)
    sets = sets.withColumns({"wide": wide, "a": F.min("doc").over(group)})
    sets = sets.withColumn("part", F.when(F.col("wide"), F.col("h1")).otherwise(F.lit(0)))
    lists = sets.groupBy("key", "wide", "part").agg(
        F.min("a").alias("a"), F.sort_array(F.collect_list("doc")).alias("docs")
    )
    docs = F.when(F.col("wide"), F.array("a", F.col("docs")[0])).otherwise(F.col("docs"))
    return ws.save(lists.select("wide", docs.alias("docs")).distinct(), f"{name}-groups")


def _candidates(ws: Workspace, sketch: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """Components `root` of documents `v` that meet under any signature and may link.

    The smallest id of a group is compared with the others. Groups in which that leaves several
    roots are compared pair by pair, so of two documents that meet and link none is lost.
    """
    groups = _groups(ws, sketch, name)
    parity = sketch.select(F.col("doc_id").alias("doc"), "n_shingles", "parity")
    ids = sketch.where("doc_id is not null").groupBy("doc_id").count()
    if not ids.where("count > 1").isEmpty():
        parity = parity.distinct()
    narrow = groups.where("not wide")
    stars = narrow.select(
        F.col("docs")[0].alias("a"), F.explode(F.expr("slice(docs, 2, size(docs))")).alias("b")
    )
    stars = ws.save(stars.where("a <> b").distinct(), f"{name}-stars")
    both = stars
    for side in ("a", "b"):
        both = both.join(parity.select(
            F.col("doc").alias(side), F.col("n_shingles").alias(f"n_{side}"),
            F.col("parity").alias(f"parity_{side}"),
        ), side)
    both = both.select("a", "b", "n_a", "n_b", "parity_a", "parity_b")
    alike = ws.save(both.mapInArrow(trimmed(_pair_filter(num, den)), "a long, b long"), f"{name}-alike")
    # Documents of one root are joined already; others may be as well.
    roots = alike.groupBy(F.col("b").alias("doc")).agg(F.min("a").alias("root"))

    of = Window.partitionBy("g")
    members = narrow.where("size(docs) > 2").select(
        F.xxhash64("docs").alias("g"), F.explode("docs").alias("doc")
    )
    members = members.join(roots, "doc", "left")
    members = members.withColumn("root", F.coalesce("root", "doc"))
    members = members.withColumns({"low": F.min("root").over(of), "high": F.max("root").over(of)})
    members = ws.save(members.where("low <> high").select("g", "doc", "root"), f"{name}-apart")
    rows = members.join(parity, "doc").select(
        "g", F.lit(0).cast("long").alias("cell"), "doc", "root", "n_shingles", "parity"
    )
    rows = rows.repartition("g").sortWithinPartitions("g", "doc")
    more = rows.mapInArrow(trimmed(_group_filter(num, den)), "a long, b long")
    more = more.unionByName(
        groups.where("wide").select(F.col("docs")[0].alias("a"), F.col("docs")[1].alias("b"))
    ).unionByName(sketch.select(F.explode("near").alias("a"), F.col("doc_id").alias("b")))
    met = ws.save(alike.unionByName(more.where("a <> b")), f"{name}-edges")
    for old in ("groups", "stars", "alike", "apart"):
        ws.drop(f"{name}-{old}")
    return components(ws, met, name)


def _refine(ws: Workspace, classes: DataFrame, docs: DataFrame, params) -> DataFrame:
    """`classes` (cc, rep, n_shingles) with components of several cells cut where no signature of
    another hash family meets.

    Similar documents meet under every family, so no link is lost. The frequent shingles are those
    of the component's own documents, which tells passages apart that are rare in the whole table
    but chain the documents here. Rounds end when they no longer cut the load by a quarter.
    """
    width, num, den = params
    before = None
    for family in range(1, FAMILIES):
        load = classes.groupBy("cc").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("load"))
        large = load.where((F.col("n") > 1) & (F.col("load") > CELL_SHINGLES))
        large = ws.save(large.select("cc", "n", "load"), f"large-{family}")
        size = large.agg(F.count("*").alias("ccs"), F.sum("n").alias("n"), F.sum("load").alias("load"))
        size = size.first()
        if not size.ccs or (before is not None and 4 * size.load > 3 * before):
            break
        before = size.load
        few = maybe_broadcast(large.select("cc"), 32 * size.ccs)
        members = classes.join(few, "cc").select(F.col("rep").alias("doc_id"), "cc").distinct()
        members = ws.save(members, f"members-{family}")
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        texts = texts.join(maybe_broadcast(members, 48 * size.n), "doc_id")
        texts = texts.select("doc_id", "text", "cc")
        frequent = frequent_shingles(texts, size.n, width)
        sign = _sketcher(plan_bands(size.n, num, den), frequent, *params, family)
        sketch = ws.save(texts.mapInArrow(trimmed(sign), SKETCH), f"sketch-{family}")
        found = members.join(
            _candidates(ws, sketch, num, den, f"met-{family}"), F.col("doc_id") == F.col("v"), "left"
        ).select(F.col("doc_id").alias("rep"), F.coalesce("root", "doc_id").alias("finer"))
        classes = classes.join(found, "rep", "left").select(
            F.coalesce("finer", "cc").alias("cc"), "rep", "n_shingles"
        )
        classes = ws.save(classes, f"classes-{family}")
    return classes


def jaccard_components(
    docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, ws: Workspace | None = None
) -> DataFrame:
    """Near-equal documents: columns `doc_id`, `n_shingles`, `component_id`.

    Words are runs of anything but space and the controls 09-0D, with A-Z lower-cased. A set
    holds the distinct shingles of `width` words; of fewer words, the whole sequence. Two
    documents link when `den * |intersection| >= num * |union|`; a component is what links reach,
    named by its smallest doc_id.

    One row per input row. A null or wordless text has no shingles and is linked with nothing; a
    row with a null doc_id gets its count and a null component. Rows that repeat a doc_id are one
    node, linked by the text of any of them. Other columns are not read.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "jaccard")
    params = (width, num, den)
    n_docs = docs.count()
    bands = plan_bands(n_docs, num, den)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = frequent_shingles(texts, n_docs, width)
    sketch = ws.save(texts.mapInArrow(trimmed(_sketcher(bands, frequent, *params)), SKETCH), "sketch")

    # Equal sets are one class; its smallest id stands for it.
    key = ["h1", "h2", "n_shingles"]
    sets = sketch.where("doc_id is not null and n_shingles > 0").select("doc_id", *key)
    classes = ws.save(sets.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    copies = sets.join(classes, key).where("rep <> doc_id")
    copies = ws.save(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "equal")
    met = _candidates(ws, sketch, num, den, "met").select(F.col("v").alias("rep"), F.col("root").alias("cc"))
    classes = ws.save(classes.join(met, "rep"), "met-classes")

    classes = _refine(ws, classes.select("cc", "rep", "n_shingles"), docs, params)
    load = classes.groupBy("cc").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("load"))
    load = load.where("n > 1").select(
        "cc", F.ceil(F.col("load") / CELL_SHINGLES).cast("int").alias("blocks")
    )
    reps = classes.join(load, "cc").select(
        "cc", "blocks", F.col("rep").alias("doc_id"), "n_shingles"
    )
    reps = reps.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    reps = ws.save(reps, "reps")
    # A component of several blocks: block 0 meets every other block.
    first = reps.select(
        "cc",
        "doc_id",
        F.explode(
            F.when(F.col("blocks") == 1, F.array(F.lit(0)))
            .when(F.col("block") == 0, F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("blocks") - 1)))
            .otherwise(F.array("block"))
        ).alias("cell"),
    )
    links = _verify(ws, first, docs, params, "first").unionByName(copies)
    found = components(ws, links, "found")

    if not reps.where("blocks > 1").isEmpty():
        # Whatever is outside a component's largest part meets all blocks.
        big = reps.where("blocks > 1").join(
            found, F.col("doc_id") == F.col("v"), "left"
        )
        big = ws.save(
            big.select("cc", "blocks", "block", "doc_id", "n_shingles",
                       F.coalesce("root", "doc_id").alias("root")), "big")
        parts = big.groupBy("cc", "root").agg(F.count("*").alias("n"))
        main = parts.groupBy("cc").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
        big = big.join(main, "cc").withColumn("outside", F.col("root") != F.col("main"))
        probes = big.where("outside").groupBy("cc").agg(
            F.ceil(F.sum("n_shingles") / CELL_SHINGLES).cast("int").alias("probes")
        )
        big = big.join(probes, "cc").withColumn(
            "probe", F.pmod(F.xxhash64("doc_id", F.lit(1)), "probes").cast("int")
        )
        member = big.select(
            "cc", "doc_id", "blocks", F.col("block").alias("b"),
            F.explode(F.sequence(F.lit(0), F.col("probes") - 1)).alias("p"),
        ).select("cc", "doc_id", (F.col("p") * F.col("blocks") + F.col("b")).alias("cell"))
        prober = big.where("outside").select(
            "cc", "doc_id", "blocks", "probe",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
        ).select("cc", "doc_id", (F.col("probe") * F.col("blocks") + F.col("b")).alias("cell"))
        again = member.unionByName(prober).distinct()
        more = _verify(ws, again, docs, params, "second")
        found = components(ws, links.unionByName(more), "all")

    return (
        sketch.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("v", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    )
