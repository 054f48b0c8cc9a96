"""Substring deduplication by sliding spans of sentences.

A text is cut into sentences: after a word that ends in ``.``, ``!`` or ``?``,
and at a line feed.  So that a passage pasted into the middle of a sentence, or
one very long sentence, is still cut alike in all its copies, a sentence is cut
further after ``,``, ``;`` or ``:`` and after a word of ``long_word`` bytes or
more; the cut depends on the words alone.  From every sentence on, the shortest
run of at least ``run`` sentences with at least ``min_words`` words is hashed
(words in lower case, A-Z).  All runs meet in one global aggregate; the first
occurrence (smallest doc_id, then text checksum, then position; a null id comes
first) keeps its sentences and every sentence that a later occurrence covers is
removed, with the white space after it.

With ``both_ends`` the shortest run that ends at every sentence is hashed too.
The two together remove what hashing every run of that size would: a repeated
stretch's first sentences start a run inside it, its last ones end one.  With
``cut_share`` a sentence is also cut after one in so many words, chosen by the
hash of the word and the one before, so a passage without punctuation holds
whole pieces.  ``WHOLE`` has both and is the registered query's rule.

Rows equal in id and text are one document and give equal results.  Null text
stays null; a text without a run of that size is returned as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import HIGH_BITS, bit_filter, bit_set, discard, passing, slices, stored
from docshred.llm.words import _MULTIPLIER, WordBatch, mix, split_words

# Characters that end a sentence or a part of one.
ENDS = b".!?,;:"
# End of fixed values.
_IS_END = np.isin(np.arange(256), np.frombuffer(ENDS, dtype=np.uint8))

SPAN_SCHEMA = "h bigint, doc_id bigint, place bigint"
RESULT_SCHEMA = ("doc_id bigint, text string, n_sentences bigint, n_removed bigint, removed_words bigint, "
                 "removed array<struct<start:bigint,end:bigint>>")


@dataclass(frozen=True)
class Spans:
    run: int = 3
    min_words: int = 20
    long_word: int = 14
    both_ends: bool = False
    cut_share: int = 0


WHOLE = Spans(both_ends=True, cut_share=6)


@lru_cache(maxsize=4)
def _weights(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (int(_MULTIPLIER), pow(int(_MULTIPLIER), -1, 1 << 64)):
        steps = np.full(1 << bits, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def sentences(batch: WordBatch, rule: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of every sentence (one more for the end), and of
    the first sentence of every text (one more for the end)."""
    n = len(batch.start)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(batch) + 1, np.int64)
    lines = np.concatenate(([0], np.cumsum(batch.data == 10)))
    last = _IS_END[batch.data[batch.end - 1]] | (batch.end - batch.start >= rule.long_word)
    last[:-1] |= lines[batch.start[1:]] > lines[batch.end[:-1]]  # texts are joined by line feeds too
    if rule.cut_share:
        pair = mix(batch.hash[:-1] * _MULTIPLIER + batch.hash[1:]) % np.uint64(rule.cut_share) == 0
        text = np.repeat(np.arange(len(batch)), np.diff(batch.first))
        last[1:] |= pair & (text[1:] == text[:-1])
    last[-1] = True
    first = np.concatenate(([0], np.flatnonzero(last) + 1))
    return first, np.searchsorted(first, batch.first)


def runs(batch: WordBatch, rule: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every run, by first and last sentence: its hash, text, first and last sentence (of the batch); and
    ``sentences``' first words."""
    first, of_text = sentences(batch, rule)
    n = len(first) - 1
    begin = np.arange(n)
    last = np.maximum(begin + rule.run - 1, np.searchsorted(first, first[:-1] + rule.min_words) - 1)
    text = np.searchsorted(of_text, begin, "right") - 1
    fits = last < of_text[text + 1]
    if rule.both_ends:
        end = begin
        start = np.minimum(end - rule.run + 1, np.searchsorted(first, first[1:] - rule.min_words, "right") - 1)
        other = (start >= of_text[text]) & (last[np.maximum(start, 0)] != end)
        begin, last, text = (np.concatenate((x[fits], y[other])) for x, y in ((begin, start), (last, end), (text, text)))
        order = np.lexsort((last, begin))
        begin, last, text = begin[order], last[order], text[order]
    else:
        begin, last, text = begin[fits], last[fits], text[fits]
    if not len(begin):
        return np.empty(0, np.uint64), text, begin, last, first
    weight, inverse = _weights(max(10, int(len(batch.hash)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(batch.hash * weight[:len(batch.hash)], dtype=np.uint64)))
    a, b = first[begin], first[last + 1]
    return mix((sums[b] - sums[a]) * inverse[a] ^ (b - a).astype(np.uint64)), text, begin, last, first


def _spans(rule: Spans, repeated=None):
    """Rows of all runs, by the high bits of their hashes, or of those whose bit is set in
    the broadcast ``repeated``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = split_words(batch.column(1).to_pylist())
            h, text, _, _, _ = runs(words, rule)
            check = batch.column(2).to_numpy(zero_copy_only=False)
            place = (check[text] << 32) + (np.arange(len(text)) - np.searchsorted(text, text))
            if repeated is None:
                h = h & HIGH_BITS
            else:
                some = bit_set(repeated.value, h)
                h, text, place = h[some], text[some], place[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), batch.column(0).take(pa.array(text)), pa.array(place, pa.int64())],
                ["h", "doc_id", "place"])
    return work


def _cut(rule: Spans, unmarked=None):
    """Results of (doc_id, text, marks); with ``unmarked``, of the rows whose fourth
    column has no bit set there."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches if unmarked is None else passing(unmarked, 3, keep=False)(batches)):
            texts = batch.column(1).to_pylist()
            words = split_words(texts, hashes=True)
            h, text, begin, last, first = runs(words, rule)
            _, of_text = sentences(words, rule)
            first_run = np.searchsorted(text, np.arange(len(texts)))
            out, total, gone, gone_words, removed = [], [], [], [], []
            for k, (t, marks) in enumerate(zip(texts, batch.column(2).to_pylist(), strict=True)):
                a, b = int(of_text[k]), int(of_text[k + 1])
                drop = np.zeros(b - a, dtype=bool)
                for m in marks or ():
                    r = int(first_run[k]) + (m & 0xFFFFFFFF)
                    # another text of equal id and checksum has other runs: not its mark
                    if r < len(text) and text[r] == k and int(h[r]) & 0xFFFFFFFF == m >> 32 & 0xFFFFFFFF:
                        drop[begin[r] - a:last[r] - a + 1] = True
                edges = np.flatnonzero(np.diff(np.concatenate(([0], drop.view(np.int8), [0])))).reshape(-1, 2)
                total.append(b - a)
                gone.append(int(drop.sum()))
                gone_words.append(int((first[edges[:, 1] + a] - first[edges[:, 0] + a]).sum()))
                if t is None or not len(edges):
                    out.append(t)
                    removed.append([])
                    continue
                raw, base, kept, at, spans = t.encode("utf-8", "surrogatepass"), int(words.offsets[k]), [], 0, []
                for s, e in edges.tolist():
                    lo = int(words.start[first[a + s]]) - base
                    hi = int(words.start[first[a + e]]) - base if a + e < b else len(raw)
                    kept.append(raw[at:lo])
                    at = hi
                    c = len(raw[:lo].decode("utf-8", "surrogatepass"))
                    spans.append({"start": c, "end": c + len(raw[lo:hi].decode("utf-8", "surrogatepass"))})
                out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass"))
                removed.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(gone_words, pa.int64()), pa.array(removed, kind)],
                ["doc_id", "text", "n_sentences", "n_removed", "removed_words", "removed"])
    return work


def remove_repeats(docs: DataFrame, rule: Spans = Spans(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the sentences that a non-first repeated run covers removed.

    The runs' hashes are counted with map-side combining, so a run that very
    many documents share is one row per task; the repeated ones set a filter of
    fixed size, and only runs that pass it go to the aggregate that finds the
    first occurrence and to the join, where adaptive execution splits a hot one.
    The texts that have marks are shuffled to them, the others are not: the marks
    set a filter of fixed size, too.
    A document's marks are bounded by its own runs; each carries half of its run's
    hash, so that it holds for no other text of equal id and checksum."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("check", F.coalesce(F.crc32(F.encode("text", "utf-8")), F.lit(0).cast("bigint")).bitwiseAND(
        F.lit(0x7FFFFFFF)))
    counts = rows.mapInArrow(_spans(rule), SPAN_SCHEMA).groupBy("h").agg(F.count("*").alias("n"))
    spans = rows.mapInArrow(_spans(rule, bit_filter(counts.where("n > 1"))), SPAN_SCHEMA)
    where = F.struct("doc_id", "place")
    # written, so that the join below shuffles both sides itself and adaptive
    # execution may split a hot hash (or broadcast a small table)
    # (a hash whose only other place is the same row again keeps nothing in the join)
    repeated = stored(spans.groupBy("h").agg(F.min(where).alias("first"), F.count("*").alias("n")).where(
        "n > 1").select("h", "first"), "repeated")
    later = spans.join(repeated, "h").where(~where.eqNullSafe(F.col("first")))
    check = F.shiftright("place", 32)
    marks = later.groupBy("doc_id", check.alias("check")).agg(
        F.collect_set(F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.shiftleft("h", 32))).alias("marks"))
    marks = stored(marks.select(F.col("doc_id").alias("_id"), F.col("check").alias("_check"), "marks"), "marks")
    discard(repeated)
    marked = bit_filter(marks.select(F.xxhash64("_id", "_check").alias("h")))
    keyed = rows.withColumn("h", F.xxhash64("doc_id", "check"))
    none = F.lit(None).cast("array<bigint>").alias("marks")
    untouched = keyed.select("doc_id", "text", none, "h").mapInArrow(_cut(rule, marked), RESULT_SCHEMA)
    some = keyed.select("doc_id", "text", "check", "h").mapInArrow(
        passing(marked, 3), "doc_id bigint, text string, check bigint, h bigint")
    joined = some.join(marks, some["doc_id"].eqNullSafe(F.col("_id")) & (some["check"] == F.col("_check")), "left")
    return untouched.unionAll(joined.select("doc_id", "text", "marks").mapInArrow(_cut(rule), RESULT_SCHEMA))
