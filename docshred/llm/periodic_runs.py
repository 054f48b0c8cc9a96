"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``min_length`` words and ``min_repeats`` * q words long, that
no neighbouring word extends keeping period q.

The texts of a slice (about 4 MB) share one grammar.

1. Re-Pair.  Pairs of neighbouring symbols that occur twice or more become
   nonterminals, by frequency.  A round counts all pairs and replaces each pair
   where no overlapping pair ranks higher, so many pairs go in one round; it ends
   when no pair occurs twice.  Pairs never reach over the end of a text.  What is
   left of a text is combined pairwise into a balanced tree (its start rule).
2. A run that lies in a nonterminal but in neither of its two parts crosses the
   boundary between them.  So each nonterminal is looked at once, at its boundary:
   for every period q, a run with four periods holds two of them on one side, hence
   the two words at the boundary come again q words further (or stood q words
   before).  What passes is extended both ways by prefix hashes.
3. The runs of a nonterminal are translated to all its derivation positions, and
   of the intervals of a text and period the maximal ones stay.

Every run of a text is complete in the lowest nonterminal that holds it, so the
result is exact.  Words are compared by 64-bit hashes.

A null or empty text, or one without words, has no run and an empty collapsed
text; rows equal in id and text give equal results; extra columns are ignored.
Memory is that of one slice; a longer text is a slice of its own and takes some
hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import slices
from docshred.llm.words import _MULTIPLIER, WordBatch, mix, split_words

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT_SCHEMA = ("doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                 "best struct<start:bigint,length:bigint,period:bigint>, collapsed string")


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, 1..count within the owner) of ``counts[owner]`` items each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + 1


def replace_pairs(words: np.ndarray, text: np.ndarray, least: int):
    """Re-Pair of a sequence of word ids cut into texts.

    Returns the nonterminals of ``least`` words or more, as (start, boundary, end)
    of one place where each is derived; all their derivations, as (nonterminal,
    start); and the start of every symbol left at the end."""
    sym, start, length = words.astype(np.int64), np.arange(len(words)), np.ones(len(words), np.int64)
    link = np.concatenate((text[1:] == text[:-1], [False])) if len(words) else np.empty(0, bool)
    symbols = int(sym.max(initial=-1)) + 1
    nodes, rule_of, places, done, n_nodes = [], [], [], [], 0
    while True:
        # a symbol without a pair that may come again takes no further part
        active = link.copy()
        active[1:] |= link[:-1]
        done.append(start[~active])
        sym, start, length, link = sym[active], start[active], length[active], link[active]
        at = np.flatnonzero(link)
        if not len(at):
            break
        _, pair, = np.unique(sym[at] * symbols + sym[at + 1], return_inverse=True)
        # equal neighbouring pairs (aaa) overlap: every second one counts
        same = np.concatenate(([False], (at[1:] == at[:-1] + 1) & (pair[1:] == pair[:-1])))
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        even = (np.arange(len(at)) - head) % 2 == 0
        count = np.bincount(pair[even], minlength=int(pair.max()) + 1)
        again = count[pair] >= 2
        link[at[~again]] = False
        at, pair, even = at[again], pair[again], even[again]
        if not len(at):
            continue
        # rank: more frequent first, then by a mixed order of the pairs
        order = np.lexsort((mix(np.arange(len(count), dtype=np.uint64) + np.uint64(1)), count))
        rank = np.empty(len(count), np.int64)
        rank[order] = np.arange(len(count))
        value = np.full(len(sym) + 2, -1)
        value[at + 1] = rank[pair]
        mine = value[at + 1]
        # a block of equal neighbouring pairs gives way to a higher one at either end
        head = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (pair[1:] != pair[:-1]))))
        tail = np.concatenate((head[1:], [len(at)])) - 1
        block = np.repeat(np.arange(len(head)), tail - head + 1)
        top = (value[at[head]] < mine[head]) & (value[at[tail] + 2] < mine[head])
        chosen = top[block] & even
        often = np.bincount(pair[chosen], minlength=len(count)) >= 2
        chosen &= often[pair]
        i, pair = at[chosen], pair[chosen]
        kinds, first, kind = np.unique(pair, return_index=True, return_inverse=True)
        whole = length[i] + length[i + 1]
        long = whole[first] >= least
        number = np.cumsum(long) - 1 + n_nodes
        nodes.append(np.stack((start[i[first]], start[i[first] + 1], start[i[first]] + whole[first]))[:, long])
        listed = long[kind]
        rule_of.append(number[kind[listed]])
        places.append(start[i[listed]])
        n_nodes += int(long.sum())
        sym[i], length[i], link[i] = symbols + kind, whole, link[i + 1]
        symbols += len(kinds)
        keep = np.ones(len(sym), bool)
        keep[i + 1] = False
        sym, start, length, link = sym[keep], start[keep], length[keep], link[keep]
    none = [np.empty(0, np.int64)]
    left = np.sort(np.concatenate([*none, *done]))
    return (np.concatenate([np.empty((3, 0), np.int64), *nodes], axis=1),
            np.concatenate(none + rule_of), np.concatenate(none + places), left)


def start_rules(left: np.ndarray, first: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """(start, boundary, end) of the nodes of a balanced tree over each text's
    remaining symbols, level by level; ``first`` holds the texts' first words."""
    begin = np.searchsorted(left, first)
    many = np.diff(begin)
    ends = np.concatenate((left, [first[-1]]))
    step = 1
    while step < many.max(initial=0):
        text, k = ragged(np.maximum((many + step - 1) // step, 0) // 2)
        lo = begin[text] + (k - 1) * 2 * step
        hi = np.minimum(lo + 2 * step, begin[text + 1])
        node = np.stack((ends[lo], ends[lo + step], ends[hi]))
        yield node[:, node[2] - node[0] >= least]
        step *= 2


class Extender:
    """Compares stretches of the word sequence by prefix hashes."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.power = np.full(n + 1, _MULTIPLIER, dtype=np.uint64)
        self.power[0] = 1
        np.cumprod(self.power, out=self.power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.power[:n], out=self.sums[1:])

    def equal(self, i, n, q):
        """Whether n words from i equal those from i + q."""
        return (self.sums[i + n] - self.sums[i]) * self.power[q] == self.sums[i + q + n] - self.sums[i + q]

    def stretch(self, i, q, lo, hi):
        """(start, end) of the period-q stretch in [lo, hi) around i and i + q."""
        right, left = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for found, room, place in ((right, hi - q - i, lambda n: i), (left, i - lo, lambda n: i - n)):
            low, high = found, np.maximum(room, 0)
            while (low < high).any():
                middle = (low + high + 1) // 2
                good = self.equal(place(middle), middle, q)
                low[good] = middle[good]
                high = np.where(good, high, middle - 1)
        return i - left, i + right + q


def boundary_runs(nodes: np.ndarray, two: np.ndarray, extender: Extender, min_length: int, min_repeats: int):
    """(node, start, end, period) of the runs that cross each node's boundary
    inside it.  ``two`` is a hash of each word and the next."""
    lo, mid, hi = nodes
    found = []
    for right in (True, False):
        room = (hi - mid if right else mid - lo) // 2
        node, q = ragged(np.minimum(np.maximum(room, 0), (hi - lo) // min_repeats))
        a = mid[node] if right else mid[node] - 2
        b = a + q if right else a - q
        inside = (b + 1 < hi[node]) if right else (b >= lo[node])
        node, q, a, b = node[inside], q[inside], a[inside], b[inside]
        hit = two[a] == two[b]
        node, q, i = node[hit], q[hit], np.minimum(a[hit], b[hit])
        s, e = extender.stretch(i, q, lo[node], hi[node])
        fits = (e - s >= np.maximum(min_length, min_repeats * q)) & (s < mid[node]) & (e > mid[node])
        found.append(np.stack((node, s, e, q))[:, fits])
    found = np.concatenate(found, axis=1)
    found = found[:, np.lexsort((found[3], found[0]))]
    # the smallest period of a node's stretch stands before its multiples, which lie in the same stretch
    kept = []
    while found.shape[1]:
        head = np.flatnonzero(np.concatenate(([True], found[0, 1:] != found[0, :-1])))
        best = found[:, head]
        kept.append(best)
        of = np.repeat(np.arange(len(head)), np.diff(np.concatenate((head, [found.shape[1]]))))
        found = found[:, (found[1] < best[1, of]) | (found[2] > best[2, of])]
    return np.concatenate([np.empty((4, 0), np.int64), *kept], axis=1)


def find(batch: WordBatch, min_length: int, min_repeats: int) -> np.ndarray:
    """(text, start, end, period) of all runs, words counted over the batch, by
    text, start and period."""
    n = len(batch.start)
    if n < min_length:
        return np.empty((4, 0), np.int64)
    text = np.repeat(np.arange(len(batch)), np.diff(batch.first))
    _, words = np.unique(batch.hash, return_inverse=True)
    nodes, rule, place, left = replace_pairs(words, text, min_length)
    two = mix(batch.hash * _MULTIPLIER + np.concatenate((batch.hash[1:], np.zeros(1, np.uint64))))
    extender = Extender(batch.hash)
    # runs inside a nonterminal, translated to all its derivations
    own = boundary_runs(nodes, two, extender, min_length, min_repeats)
    order = np.argsort(rule, kind="stable")
    begin = np.searchsorted(rule[order], np.arange(nodes.shape[1] + 1))
    many = begin[own[0] + 1] - begin[own[0]]
    which, k = ragged(many)
    shift = place[order[begin[own[0][which]] + k - 1]] - nodes[0, own[0][which]]
    parts = [np.stack((own[1][which] + shift, own[2][which] + shift, own[3][which]))]
    for level in start_rules(left, batch.first, min_length):
        parts.append(boundary_runs(level, two, extender, min_length, min_repeats)[1:])
    s, e, q = np.concatenate(parts, axis=1)
    of = text[s]
    order = np.lexsort((-e, s, q, of))
    s, e, q, of = s[order], e[order], q[order], of[order]
    if len(s):
        # maximal intervals of a text and period: those that end beyond all earlier ones
        group = np.cumsum(np.concatenate(([0], (of[1:] != of[:-1]) | (q[1:] != q[:-1]))))
        reach = np.maximum.accumulate(group * (n + 1) + e)
        new = np.concatenate(([True], (reach[1:] > reach[:-1])))
        s, e, q, of = s[new], e[new], q[new], of[new]
    order = np.lexsort((q, s, of))
    return np.stack((of, s, e, q))[:, order]


def collapse(batch: WordBatch, runs: np.ndarray) -> pa.Array:
    """The texts' words joined by one space, without those that a run holds after
    its first period."""
    n = len(batch.start)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, runs[1] + runs[3], 1)
    np.add.at(cover, runs[2], -1)
    kept = np.flatnonzero(np.cumsum(cover[:n]) == 0)
    many = np.searchsorted(kept, batch.first)
    stop = batch.end[kept] + 1  # a separator byte follows every word
    last = many[1:][np.diff(many) > 0] - 1
    stop[last] -= 1
    data = batch.data.copy()
    data[batch.end[kept]] = 0x20
    edge = np.zeros(len(data) + 1, np.int8)
    edge[batch.start[kept]] += 1
    edge[stop] -= 1
    out = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    ends = np.concatenate(([0], np.cumsum(stop - batch.start[kept])))[many]
    return pa.LargeStringArray.from_buffers(
        len(batch), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _runs(min_length: int, min_repeats: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = split_words(batch.column(1).to_pylist(), lower=False)
            found = find(words, min_length, min_repeats)
            base = words.first[found[0]]
            values = pa.StructArray.from_arrays(
                [pa.array(x) for x in (found[1] - base, found[2] - found[1], found[3])], fields=list(RUN))
            ends = np.searchsorted(found[0], np.arange(len(words) + 1)).astype(np.int32)
            best: list[dict | None] = [None] * len(words)
            for t, s, n, q in zip(found[0].tolist(), (found[1] - base).tolist(), (found[2] - found[1]).tolist(),
                                  found[3].tolist()):  # by start, then period: an equal ratio stays behind
                if best[t] is None or n * best[t]["period"] > best[t]["length"] * q:
                    best[t] = {"start": s, "length": n, "period": q}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(ends), values),
                 pa.array(best, RUN), collapse(words, found)], ["doc_id", "n_words", "runs", "best", "collapsed"])
    return work


def find_runs(docs: DataFrame, min_length: int = 6, min_repeats: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) of every row of ``docs`` (doc_id,
    text).  Runs go by start, then period; ``best`` has the greatest exact length
    over period (ties: smallest start, then period; null without a run).
    ``min_repeats`` is 4 or more."""
    if min_repeats < 4:
        raise ValueError("min_repeats must be 4 or more: a run must hold two periods on one side of a boundary")
    return docs.select("doc_id", "text").mapInArrow(_runs(min_length, max(min_repeats, 4)), RESULT_SCHEMA)


def plant(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32 of the decimal doc_id ends in 0, the words
    from a on repeat the p words from a (rows without an id or word stay)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, words))
    sized = marked.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    sized = sized.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    sized = sized.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")),
                                     F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a"))), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_runs``' result."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
