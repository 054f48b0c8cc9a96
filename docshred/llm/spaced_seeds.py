"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive words: positions marked 0 are ignored,
so a hash of the others survives substitutions there.  The seed hashes of the
benchmark (the stated query set, in blocks of a bounded number of words) are
joined with the seed hashes at every word of every document; each hit names a
diagonal (document position minus item position), and the diagonal is verified
word by word: every stretch that begins and ends with an equal word and holds at
least ``min_words`` words with at least ``min_match`` of them equal is an overlap;
of overlapping ones the longest is reported, then the longest beside it, and so on.

Words are runs of letters and digits in lower case (A-Z); punctuation does not
count.  Null and empty texts have no words and no overlap; an item shorter than
``min_words`` cannot be found.  Repeated document rows each report their
overlaps; repeated items are reported under every id.  An empty benchmark leaves
all documents as they are.  A text of one word repeated overlaps an item of that word
on every diagonal: its rows grow with its words, never with words times places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import slices
from docshred.llm.words import _MULTIPLIER, WordBatch, mix, split_words

# The masks.
MASKS = ("110110111", "111011011", "1101101011")
# End of fixed values.
SCHEMA = "doc_id bigint, item_id bigint, doc_start bigint, item_start bigint, n_words bigint, n_equal bigint"
FILTER_BITS = 22
DENSE = 64  # places of one seed in a document, above which pairs with an item's places are not listed
ROWS = 10_000  # overlaps handed on at a time
PAIRS = 1 << 20  # pairs of places listed, or of words compared, at a time


@dataclass(frozen=True)
class Rule:
    min_words: int = 12
    min_match: float = 0.8

    @property
    def share(self) -> Fraction:
        return Fraction(self.min_match).limit_denominator(10_000)


def seed_hashes(batch: WordBatch, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the mask's words from every word on, and that word's index;
    masks do not reach over the end of a text."""
    n = len(batch.hash) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.full(n, int(mask, 2), dtype=np.uint64)
    for k, mark in enumerate(mask):
        if mark == "1":
            h = h * _MULTIPLIER + batch.hash[k:n + k]
    owner = np.repeat(np.arange(len(batch)), np.diff(batch.first))
    at = np.flatnonzero(owner[:n] == owner[len(mask) - 1:])
    return mix(h[at]), at


def stretches(equal: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Disjoint accepted stretches (start, end), the longest first taken, in order.

    With the surplus of equal words over ``min_match`` summed up to every word, a
    stretch is accepted when the sum at its end is not below that at its start;
    the greatest sum still to come gives each start's farthest end by bisection."""
    share = rule.share
    out, todo = [], [(0, len(equal))]
    while todo:
        lo, hi = todo.pop()
        at = lo + np.flatnonzero(equal[lo:hi])
        if not len(at) or at[-1] + 1 - at[0] < rule.min_words:
            continue
        before = share.denominator * np.arange(len(at)) - share.numerator * at
        after = before + share.denominator - share.numerator
        most = np.maximum.accumulate(after[::-1])
        last = len(at) - 1 - np.searchsorted(most, before)
        length = np.where(last >= np.arange(len(at)), at[np.maximum(last, 0)] + 1 - at, 0)
        k = int(np.argmax(length))
        if length[k] >= rule.min_words:
            start, end = int(at[k]), int(at[k] + length[k])
            out.append((start, end))
            todo += [(lo, start), (end, hi)]
    return sorted(out)


class SeedIndex:
    """Sorted seed hashes of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rule: Rule):
        self.rule, self.item_ids = rule, [i for i, _ in items]
        self.words = split_words([t for _, t in items], punctuation=False)
        self.tables = []
        for mask in MASKS:
            h, at = seed_hashes(self.words, mask)
            order = np.argsort(h, kind="stable")
            near = np.zeros(1 << FILTER_BITS, dtype=bool)
            near[h >> np.uint64(64 - FILTER_BITS)] = True
            self.tables.append((mask, h[order], at[order], near))

    def hits(self, batch: WordBatch) -> np.ndarray:
        """Distinct (document, item, diagonal) rows that share a seed, in order.

        Pairs of places are listed, ``PAIRS`` at a time, only where a document
        holds a seed at most ``DENSE`` times; more places meet an item's by their
        set of differences (``differences``), whose size is linear."""
        found = [np.empty((0, 3), np.int64)]
        dense: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for mask, keys, places, near in self.tables:
            h, at = seed_hashes(batch, mask)
            some = near[h >> np.uint64(64 - FILTER_BITS)]
            h, at = h[some], at[some]
            lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            some = hi > lo
            at, lo, hi = at[some], lo[some], hi[some]
            doc = np.searchsorted(batch.first, at, "right") - 1
            order = np.lexsort((at, doc, lo))
            at, lo, hi, doc = at[order], lo[order], hi[order], doc[order]
            start = np.flatnonzero(np.concatenate(([True], (lo[1:] != lo[:-1]) | (doc[1:] != doc[:-1])))) if len(at) else at
            size = np.diff(np.append(start, len(at)))
            few = np.repeat(size <= DENSE, size)
            found += self._listed(batch, at[few], doc[few], lo[few], hi[few], places)
            for k, n in zip(start[size > DENSE].tolist(), size[size > DENSE].tolist(), strict=True):
                d = int(doc[k])
                place = np.sort(places[lo[k]:hi[k]])
                item = np.searchsorted(self.words.first, place, "right") - 1
                cut = np.flatnonzero(np.diff(item)) + 1
                for i, b in zip(item[np.append(0, cut)].tolist(), np.split(place, cut), strict=True):
                    dense.setdefault((d, i), []).append((at[k:k + n] - batch.first[d], b - self.words.first[i]))
        for (d, i), pairs in dense.items():
            diagonal = differences(pairs, int(batch.first[d + 1] - batch.first[d]),
                                   int(self.words.first[i + 1] - self.words.first[i]))
            found.append(np.column_stack([np.full(len(diagonal), d), np.full(len(diagonal), i), diagonal]))
        return distinct(np.concatenate(found))

    def _listed(self, batch: WordBatch, at, doc, lo, hi, places) -> Iterator[np.ndarray]:
        """Distinct (document, item, diagonal) rows of all pairs, a part at a time."""
        count = hi - lo
        part = np.cumsum(count) // PAIRS
        for rows in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
            n = count[rows]
            place = places[np.arange(n.sum()) + np.repeat(lo[rows] - (np.cumsum(n) - n), n)]
            d, a = np.repeat(doc[rows], n), np.repeat(at[rows], n)
            item = np.searchsorted(self.words.first, place, "right") - 1
            yield distinct(np.column_stack([d, item, (a - batch.first[d]) - (place - self.words.first[item])]))

    def verify(self, batch: WordBatch, doc: int, item: int, diagonals: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document start, item start, words, equal words) of every accepted stretch, by diagonal and start.

        Many diagonals are compared at once, along the shorter of the two; only
        those that are neither refused for too few equal words nor accepted from
        the first equal word to the last are searched for stretches."""
        a = batch.hash[batch.first[doc]:batch.first[doc + 1]]
        b = self.words.hash[self.words.first[item]:self.words.first[item + 1]]
        short, long, sign = (a, b, -1) if len(a) < len(b) else (b, a, 1)
        share, least = self.rule.share, self.rule.min_words
        out, along = [], np.arange(len(short))
        step = max(1, PAIRS // max(len(short), 1))
        for k in range(0, len(diagonals), step):
            shift = diagonals[k:k + step]
            place = along + sign * shift[:, None]
            equal = (place >= 0) & (place < len(long)) & (long[np.clip(place, 0, len(long) - 1)] == short)
            n = equal.sum(axis=1)
            first, last = equal.argmax(axis=1), len(short) - equal[:, ::-1].argmax(axis=1)
            whole = (last - first >= least) & (share.denominator * n >= share.numerator * (last - first))
            for j in np.flatnonzero(share.denominator * n >= share.numerator * least).tolist():
                spans = [(int(first[j]), int(last[j]))] if whole[j] else stretches(equal[j], self.rule)
                d = int(shift[j])
                for s, e in spans:
                    in_doc, in_item = (s + d, s) if sign > 0 else (s, s - d)
                    out.append((in_doc, in_item, e - s, int(n[j]) if whole[j] else int(equal[j, s:e].sum())))
        return out

    def overlaps(self, texts: list[str | None]) -> Iterator[tuple[int, int | None, tuple[int, int, int, int]]]:
        """(text, item id, overlap), by text and item."""
        batch = split_words(texts, punctuation=False)
        hits = self.hits(batch)
        cut = np.flatnonzero((hits[1:, :2] != hits[:-1, :2]).any(axis=1)) + 1
        for part in np.split(hits, cut) if len(hits) else ():
            doc, item = int(part[0, 0]), int(part[0, 1])
            for found in self.verify(batch, doc, item, part[:, 2]):
                yield doc, self.item_ids[item], found


def distinct(rows: np.ndarray) -> np.ndarray:
    """Distinct (document, item, diagonal) rows in order, by one sort of whole numbers."""
    if not len(rows):
        return rows
    item = rows[:, 1]
    pair, which = np.unique(rows[:, 0] * (int(item.max()) + 1) + item, return_inverse=True)
    low = int(rows[:, 2].min())
    span = int(rows[:, 2].max()) - low + 1
    code = np.unique(which * span + (rows[:, 2] - low))
    pair = pair[code // span]
    return np.column_stack([pair // (int(item.max()) + 1), pair % (int(item.max()) + 1), code % span + low])


def differences(pairs: list[tuple[np.ndarray, np.ndarray]], n: int, m: int) -> np.ndarray:
    """Distinct a - b over all (places a of n, places b of m), without listing
    pairs: marks shifted by every b, or one convolution where b are many."""
    mark = np.zeros(n + m, dtype=bool)
    for a, b in pairs:
        if len(a) * len(b) <= DENSE * (n + m):
            for shift in (m - 1 - b).tolist():
                mark[a + shift] = True
            continue
        size = 1 << (n + m).bit_length()
        left = np.fft.rfft(np.bincount(a, minlength=size))
        right = np.fft.rfft(np.bincount(m - 1 - b, minlength=size))
        mark |= np.fft.irfft(left * right, size)[:n + m] > 0.5
    return np.flatnonzero(mark) - (m - 1)


def blocks(benchmark: DataFrame, rule: Rule, block_chars: int, id_col: str, text_col: str) -> Iterator[SeedIndex]:
    """The benchmark's seed indexes; a block holds about ``block_chars`` characters."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    count = -(-total // block_chars)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(count, 1)))
    for k in range(count):
        rows = [(r["item_id"], r["text"]) for r in items.where(part == k).collect()]
        yield SeedIndex(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), rule)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), block_chars: int = 16 << 20,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document row, item, diagonal and verified overlap
    (positions in words).  Narrow over the documents, once per benchmark block."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for index in blocks(benchmark, rule, block_chars, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                ids, every = batch.column(0), shared.value.overlaps(batch.column(1).to_pylist())
                while found := list(islice(every, ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([f[0] for f in found], pa.int64())), pa.array([f[1] for f in found], pa.int64()),
                         *(pa.array([f[2][k] for f in found], pa.int64()) for k in range(4))],
                        ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"])

        part = rows.mapInArrow(work, SCHEMA)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), block_chars: int = 16 << 20,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that overlap an item; all columns are kept."""
    spark, schema = docs.sparkSession, docs.schema
    at = docs.columns.index(text_col)
    for index in blocks(benchmark, rule, block_chars, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text=at):
                clean = np.ones(batch.num_rows, dtype=bool)
                for found in shared.value.overlaps(batch.column(at).to_pylist()):
                    clean[found[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(work, schema)
    return docs
