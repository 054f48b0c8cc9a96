"""Substring deduplication by prefix-free parsing.

Every byte that a string of ``width`` bytes covers is removed when that string
also starts in a document with a smaller doc_id.  Strings are those of the input;
they never cross documents.

1. Parsing.  A rolling hash of ``trigger`` bytes runs over every text.  The least
   hash inside a string of ``width`` bytes (the leftmost of equal ones) is its
   trigger; it depends on the string alone, so equal strings have their trigger at
   the same place.  The strings that follow one another with the same trigger make
   a phrase; every string lies in exactly one phrase.  Phrases up to one whose
   trigger hash meets a fixed condition (one in ``join``) make a long phrase.
2. Dictionary of long phrases: each by its hash, with the smallest document that
   holds it.  All other occurrences are removed whole and take no further part, so
   copies cost little from here on.
3. A string can only be repeated when its trigger is.  Triggers that two documents
   hold are found by one sorted shuffle (one row a trigger and part), and only
   their phrases go on, once a part.
4. Corpus order.  The phrases are dealt by trigger.  Within a trigger the phrases
   are sorted as suffixes from the trigger on, and once more by what precedes it,
   backwards (suffix arrays of the dictionary and, for what stands before, of the
   parse).  A string with d bytes before its trigger is then a pair of intervals:
   of the orders' common prefixes of d and ``width`` - d bytes.  Equal pairs are
   equal strings, whatever phrases they lie in, and the smallest document of a pair
   decides.  A trigger with more than ``GROUP`` phrases is not held in a task: its
   strings go on one by one, by their hash, and are counted with Spark's aggregate.
5. Every part removes what its own documents repeat, and what the answers (one bit a
   string of a phrase) say.

The texts are written once as a table bucketed by part (about ``PART_BYTES`` of text
each), so that the three rounds of answers come to the parts and no text is
shuffled.  Long phrases are compared by 128 bits of hash, phrases of a part by 64,
strings in corpus order by their bytes.

Null and empty texts have no bytes.  A null doc_id is neither smaller nor larger
than another: its row keeps all bytes and removes none.  Rows that share a doc_id
are one document as far as matches go, and each gives a row of its own.  Extra
columns are ignored, an empty table gives no rows.  A part is held in memory, and a
long text with it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import stored
from docshred.llm.words import _BYTE_CODE, _MULTIPLIER, mix
from docshred.session import scratch_path

PART_BYTES = 16 << 20
BLOCK = 1 << 16             # strings hashed together
MAX_WIDTH = 128
MAX_BUCKETS = 50_000        # of the table of parts; more parts share buckets
PLACE_BITS = 17             # of a place inside a block, below a hash's high bits
GROUP = 1 << 16             # phrases of a trigger that a task holds at most

PIECES = "c1 bigint, c2 bigint, doc bigint, part bigint"
TRIGGERS = "h bigint, part bigint, many boolean"
PHRASES = "h bigint, bytes binary, before int, doc bigint, part bigint, phrase bigint"
ORDERED = "part bigint, phrase bigint, bits bigint, w1 bigint, w2 bigint, doc bigint"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept string, removed array<struct<start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Parsing:
    width: int = 50
    trigger: int = 20       # at most width - trigger + 1 strings make a phrase: their answers fit 64 bits
    join: int = 16

    def __post_init__(self):
        if not 1 <= self.trigger <= self.width <= MAX_WIDTH or self.width - self.trigger >= 63:
            raise ValueError(f"trigger must lie between width - 62 and width, width up to {MAX_WIDTH}")


_SECOND = 0xD6E8FEB86659FD93
_BYTE_CODE2 = mix(_BYTE_CODE ^ np.uint64(_SECOND))


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def rolling(data: np.ndarray, width: int, code: np.ndarray = _BYTE_CODE, base: int = int(_MULTIPLIER)) -> np.ndarray:
    """Hash of the ``width`` bytes from every place on (combined by doubling)."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, out, done, size = code[data], None, 0, 1
    while True:
        if width & size:
            part = h[done:done + n] * _power(base, done)
            out = part if out is None else out + part
            done += size
        if done == width:
            return mix(out)
        h = h[:-size] + h[size:] * _power(base, size)
        size *= 2


def least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n, size = len(x) - width + 1, 1
    if n <= 0:
        return x[:0]
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size:width - size + n]) if size < width else x


def _ranges(n: int, base: int) -> np.ndarray:
    power = np.full(n + 1, base, dtype=np.uint64)
    power[0] = 1
    return np.cumprod(power, dtype=np.uint64)


_SIDES = [(code, _ranges(BLOCK + MAX_WIDTH, base), _ranges(BLOCK + MAX_WIDTH, pow(base, -1, 1 << 64)))
          for code, base in ((_BYTE_CODE, int(_MULTIPLIER)), (_BYTE_CODE2, _SECOND))]


@dataclass
class Parse:
    """Phrases of a part's texts, in order.

    ``text``: index of the text; ``start``, ``n``: first string and number of strings (bytes of
    the joined texts); ``before``: bytes before the trigger in the first string; ``hash``: of the
    trigger; ``name``: of the phrase's bytes; ``piece``: index of its long phrase, whose names are
    ``c1`` and ``c2``."""
    text: np.ndarray
    start: np.ndarray
    n: np.ndarray
    before: np.ndarray
    hash: np.ndarray
    name: np.ndarray
    piece: np.ndarray
    c1: np.ndarray
    c2: np.ndarray


def parse(data: np.ndarray, offsets: np.ndarray, rule: Parsing) -> Parse:
    """Phrases of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    width, tail = rule.width, rule.width - 1
    high = np.uint64(((1 << 64) - 1) ^ ((1 << PLACE_BITS) - 1))
    size = np.diff(offsets)
    found: list[list[np.ndarray]] = []
    pieces = 0
    for base in range(0, max(len(data) - tail, 0), BLOCK):
        block = data[base:base + BLOCK + tail]
        n = len(block) - tail
        lo, hi = np.searchsorted(offsets, (base, base + n), "right") - 1
        hi = min(hi, len(size) - 1)
        # a string lies in one text
        last = np.clip(offsets[lo:hi + 1] + size[lo:hi + 1] - tail - base, 0, n)
        first = np.clip(offsets[lo:hi + 1] - base, 0, n)
        many = np.maximum(last - first, 0)
        if not many.any():
            continue
        h = rolling(block, rule.trigger)
        key = (h & high) | np.arange(len(h), dtype=np.uint64)
        place = (least(key, width - rule.trigger + 1) & ~high).astype(np.int64)
        text = np.repeat(np.arange(lo, hi + 1), many)
        i = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        p = place[i]
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (text[1:] != text[:-1])))
        at = np.flatnonzero(new)
        a, b = i[at], i[np.concatenate((at[1:], [len(i)])) - 1] + width
        trigger = h[p[at]]
        cut = np.concatenate(([True], (text[at][1:] != text[at][:-1])
                              | (mix(trigger[:-1]) % np.uint64(rule.join) == 0)))
        piece = np.cumsum(cut) - 1
        head = np.flatnonzero(cut)
        c, d = a[head], b[np.concatenate((head[1:], [len(at)])) - 1]
        names = []
        for code, power, inverse in _SIDES:
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(code[block] * power[:len(block)], out=sums[1:])
            names += [mix((sums[e] - sums[s]) * inverse[s] ^ (e - s).astype(np.uint64)) for s, e in ((a, b), (c, d))]
        found.append([text[at], a + base, b - a - tail, p[at] - a, trigger, names[0], piece + pieces, names[1], names[3]])
        pieces += len(head)
    empty = [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)] * 2 + [np.empty(0, np.int64)] + [np.empty(0, np.uint64)] * 2
    return Parse(*[np.concatenate(x) for x in zip(empty, *found)])


@dataclass
class Part:
    """A part's rows, parsed: rows with an id and text first."""
    number: int
    ids: list
    raw: list[bytes]
    doc: np.ndarray          # of the rows that take part
    data: np.ndarray
    offsets: np.ndarray
    rows: np.ndarray         # their places among all rows
    parse: Parse

    @classmethod
    def read(cls, group: pa.Table, rule: Parsing) -> "Part":
        ids = group.column("doc_id").to_pylist()
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in group.column("text").to_pylist()]
        rows = np.array([k for k, i in enumerate(ids) if i is not None], dtype=np.int64)
        own = [raw[k] for k in rows]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in own]))).astype(np.int64)
        data = np.frombuffer(b"".join(own), dtype=np.uint8)
        return cls(group.column("part")[0].as_py() if group.num_rows else 0, ids, raw,
                   np.array([ids[k] for k in rows], dtype=np.int64), data, offsets, rows, parse(data, offsets, rule))

    def first_piece(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct long phrases (c1, c2), the smallest document of each, and each occurrence's number."""
        p = self.parse
        names = np.stack((p.c1, p.c2), axis=1).view(np.dtype([("a", np.uint64), ("b", np.uint64)])).ravel()
        kinds, number = np.unique(names, return_inverse=True)
        doc = np.full(len(kinds), np.iinfo(np.int64).max)
        np.minimum.at(doc, number, self._piece_doc())
        return kinds["a"], kinds["b"], doc, number

    def _piece_doc(self) -> np.ndarray:
        p = self.parse
        _, head = np.unique(p.piece, return_index=True)
        return self.doc[p.text[head]]

    def open_phrases(self, known: np.ndarray) -> np.ndarray:
        """Phrases in long phrases that no smaller document holds; ``known``: c1 of the
        part's long phrases that another part's smaller document holds."""
        c1, _, doc, number = self.first_piece()
        repeated = np.isin(c1[number], known) | (self._piece_doc() > doc[number])
        return np.flatnonzero(~repeated[self.parse.piece])

    def first_phrase(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen phrases: the place of each kind's smallest document, and each one's kind."""
        p = self.parse
        kinds, kind = np.unique(p.name[chosen], return_inverse=True)
        order = np.lexsort((self.doc[p.text[chosen]], kind))
        return kinds, chosen[order[np.searchsorted(kind[order], np.arange(len(kinds)))]], kind


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().view(np.uint64)


def _pieces(rule: Parsing):
    def work(group: pa.Table) -> pa.Table:
        part = Part.read(group, rule)
        c1, c2, doc, _ = part.first_piece()
        return pa.table({"c1": _signed(c1), "c2": _signed(c2), "doc": doc, "part": np.full(len(doc), part.number)})
    return work


def _triggers(rule: Parsing):
    def work(group: pa.Table, known: pa.Table) -> pa.Table:
        part = Part.read(group, rule)
        chosen = part.open_phrases(_column(known, "c1"))
        h, doc = part.parse.hash[chosen], part.doc[part.parse.text[chosen]]
        kinds, first, number = np.unique(h, return_index=True, return_inverse=True)
        many = np.zeros(len(kinds), bool)
        many[number[doc != doc[first[number]]]] = True
        return pa.table({"h": _signed(kinds), "part": np.full(len(kinds), part.number), "many": many})
    return work


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by h: (h, part) of triggers that two documents hold.  Streams;
    the last row waits for the next batch."""
    held: tuple[int, int, bool] | None = None   # the last row, and whether it is settled
    for batch in batches:
        if not batch.num_rows:
            continue
        h, part, many = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        if held is not None:
            h, part, many = (np.concatenate(([v], x)) for v, x in zip(held, (h, part, many)))
        same = h[1:] == h[:-1]
        give = many | np.concatenate(([False], same)) | np.concatenate((same, [False]))
        held = (h[-1], part[-1], bool(give[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(h[:-1][give[:-1]]), pa.array(part[:-1][give[:-1]])], ["h", "part"])
    if held is not None and held[2]:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], ["h", "part"])


def _phrases(rule: Parsing):
    def work(group: pa.Table, answers: pa.Table) -> pa.Table:
        part = Part.read(group, rule)
        kind, value = answers.column("kind").to_numpy(), _column(answers, "value")
        chosen = part.open_phrases(value[kind == 0])
        p = part.parse
        chosen = chosen[np.isin(p.hash[chosen], value[kind == 1])]
        names, at, _ = part.first_phrase(chosen)
        raw = part.data.tobytes()
        return pa.table({
            "h": _signed(p.hash[at]),
            "bytes": pa.array([raw[s:s + n + rule.width - 1] for s, n in zip(p.start[at].tolist(), p.n[at].tolist())], pa.binary()),
            "before": pa.array(p.before[at], pa.int32()), "doc": part.doc[p.text[at]],
            "part": np.full(len(at), part.number), "phrase": _signed(names)})
    return work


def _order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by the columns, and for each place the columns that it has in
    common with the one before (-1 where the first differs)."""
    order = np.lexsort(columns[::-1])
    common = np.full(len(order), -1)
    alike = np.ones(max(len(order) - 1, 0), bool)
    for c in columns:
        c = c[order]
        alike &= c[1:] == c[:-1]
        common[1:] += alike
    return order, common


def corpus_order(h: np.ndarray, phrases: list[bytes], before: np.ndarray, doc: np.ndarray, rule: Parsing) -> np.ndarray:
    """For each phrase a bit for every string of it that a smaller document holds."""
    width, most = rule.width, rule.width - rule.trigger
    n = np.array([len(b) for b in phrases]) - width + 1
    flat = np.frombuffer(b"".join(phrases), dtype=np.uint8)
    start = np.concatenate(([0], np.cumsum(n + width - 1)))[:-1]
    end = start + n + width - 1
    trigger = start + before
    # the bytes from the trigger on, and those before it backwards; 0 beyond the phrase's ends
    def column(at, inside):
        return np.where(inside, flat[np.where(inside, at, 0)], 0)
    after, pre = [h], [h]
    for k in range(width):
        after.append(column(trigger + k, trigger + k < end))
    for k in range(1, most + 1):
        pre.append(column(trigger - k, trigger - k >= start))
    bits = np.zeros(len(h), np.int64)
    ranks = []
    for columns in (after, pre):
        order, common = _order(columns)
        ranks.append((order, common))
    for d in range(most + 1):
        j = before - d                         # the string with d bytes before its trigger
        chosen = np.flatnonzero((j >= 0) & (j < n))
        if len(chosen) < 2:
            continue
        classes = []
        for (order, common), length in zip(ranks, (width - d, d)):
            c = np.empty(len(h), np.int64)
            c[order] = np.cumsum(common < length)
            classes.append(c[chosen])
        key = classes[0] * (len(h) + 1) + classes[1]
        order = np.lexsort((doc[chosen], key))
        key, own = key[order], doc[chosen][order]
        head = np.concatenate(([True], key[1:] != key[:-1]))
        smallest = own[np.flatnonzero(head)][np.cumsum(head) - 1]
        again = chosen[order[own > smallest]]
        bits[again] |= np.int64(1) << j[again]
    return bits


def _string_hashes(phrases: list[bytes], rule: Parsing) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the phrase, place of the string in it, two hashes) of all strings."""
    n = np.array([len(b) for b in phrases]) - rule.width + 1
    flat = np.frombuffer(b"".join(phrases), dtype=np.uint8)
    owner = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = np.concatenate(([0], np.cumsum(n + rule.width - 1)))[owner] + j
    return owner, j, rolling(flat, rule.width)[at], rolling(flat, rule.width, _BYTE_CODE2, _SECOND)[at]


def _ordered(rule: Parsing, group: int):
    """From phrases sorted by trigger: (part, phrase, bits) where a smaller document holds
    strings of a phrase; strings by hash (w1, w2, bits: the string's own) for triggers
    with more than ``group`` phrases.  Holds about ``group`` phrases at a time."""
    names = ["part", "phrase", "bits", "w1", "w2", "doc"]

    def settle(rows: pa.Table) -> pa.RecordBatch:
        bits = corpus_order(rows.column("h").to_numpy(), rows.column("bytes").to_pylist(),
                            rows.column("before").to_numpy().astype(np.int64), rows.column("doc").to_numpy(), rule)
        hit = np.flatnonzero(bits)
        none = pa.nulls(len(hit), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(rows.column("part").to_numpy()[hit]), pa.array(rows.column("phrase").to_numpy()[hit]),
                                           pa.array(bits[hit]), none, none, none], names)

    def one_by_one(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, 8192):
            some = rows.slice(at, 8192)
            owner, j, w1, w2 = _string_hashes(some.column("bytes").to_pylist(), rule)
            part, phrase, doc = (some.column(c).to_numpy()[owner] for c in ("part", "phrase", "doc"))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(phrase), pa.array(np.int64(1) << j),
                                              _signed(w1), _signed(w2), pa.array(doc)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        hot = None                              # the trigger whose phrases go one by one
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows < min(group, 1 << 14):
                continue
            h = held.column("h").to_numpy()
            if hot is not None:
                end = int(np.searchsorted(h != hot, True)) if (h != hot).any() else len(h)
                yield from one_by_one(held.slice(0, end))
                held, h = held.slice(end), h[end:]
                if not len(h):
                    continue
                hot = None
            begin = int(np.flatnonzero(h == h[-1])[0])  # the last trigger may go on
            if begin:
                for ready in _cut(held.slice(0, begin), group):
                    yield from settle_or_not(ready)
                held = held.slice(begin)
            if held.num_rows > group:
                hot = held.column("h")[0].as_py()
                yield from one_by_one(held)
                held = held.slice(0, 0)
        if held is not None and held.num_rows:
            if hot is not None:
                h = held.column("h").to_numpy()
                end = int((h == hot).sum())
                yield from one_by_one(held.slice(0, end))
                held = held.slice(end)
            for ready in _cut(held, group):
                yield from settle_or_not(ready)

    def settle_or_not(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows > group:
            yield from one_by_one(rows)
        else:
            yield settle(rows)
    return work


def _cut(rows: pa.Table, group: int) -> Iterator[pa.Table]:
    """Runs of whole triggers of at most ``group`` rows; a larger trigger stands alone."""
    h = rows.column("h").to_numpy()
    heads = np.concatenate((np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))), [len(h)])) if len(h) else np.zeros(1, int)
    at = 0
    for k in range(1, len(heads)):
        if heads[k] - at > group and heads[k - 1] > at:
            yield rows.slice(at, heads[k - 1] - at)
            at = heads[k - 1]
        if heads[k] - at > group:
            yield rows.slice(at, heads[k] - at)
            at = heads[k]
    if at < len(h):
        yield rows.slice(at)


def _removed(rule: Parsing):
    def work(group: pa.Table, answers: pa.Table) -> pa.Table:
        part = Part.read(group, rule)
        p = part.parse
        kind, value, bits = answers.column("kind").to_numpy(), _column(answers, "value"), answers.column("bits").to_numpy()
        again = np.ones(len(p.text), bool)      # phrases that are repeated whole
        chosen = part.open_phrases(value[kind == 0])
        again[chosen] = False
        candidates = chosen[np.isin(p.hash[chosen], value[kind == 1])]
        names, at, of = part.first_phrase(candidates)
        own = part.doc[p.text]
        again[candidates] = own[candidates] > own[at][of]
        cover = np.zeros(len(part.data) + 1, np.int64)
        np.add.at(cover, p.start[again], 1)
        np.add.at(cover, p.start[again] + p.n[again] + rule.width - 1, -1)
        # single strings: the answers' bits
        order = np.argsort(value[kind == 2])
        known, mask = value[kind == 2][order], bits[kind == 2][order]
        place = np.searchsorted(known, names)
        place[place == len(known)] = 0
        of_kind = np.where(known[place] == names, mask[place], 0) if len(known) else np.zeros(len(names), np.int64)
        rest = candidates[~again[candidates]]
        its = of_kind[of[~again[candidates]]]
        for j in range(rule.width - rule.trigger + 1):
            at = p.start[rest[(its >> j) & 1 == 1]] + j
            np.add.at(cover, at, 1)
            np.add.at(cover, at + rule.width, -1)
        gone = np.cumsum(cover[:-1]) > 0
        out = {"doc_id": part.ids, "n_bytes": [len(r) for r in part.raw], "n_removed": [0] * len(part.ids),
               "n_spans": [0] * len(part.ids), "kept": [hashlib.sha256(r).hexdigest() if i is None else None
                                                       for i, r in zip(part.ids, part.raw)], "removed": [[] for _ in part.ids]}
        for k, row in enumerate(part.rows.tolist()):
            lo, hi = int(part.offsets[k]), int(part.offsets[k + 1])
            mine = gone[lo:hi]
            if not mine.any():
                out["kept"][row] = hashlib.sha256(part.raw[row]).hexdigest()
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
            out["removed"][row] = [{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())]
            out["n_removed"][row], out["n_spans"][row] = int(mine.sum()), len(edge) // 2
            out["kept"][row] = hashlib.sha256(part.data[lo:hi][~mine].tobytes()).hexdigest()
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()),
                         **{c: pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")},
                         "kept": pa.array(out["kept"], pa.string()), "removed": pa.array(out["removed"], spans)})
    return work


def parted(docs: DataFrame) -> tuple[str, DataFrame]:
    """The texts as a table bucketed by part: the rows of an input partition, split by
    their hash into parts of about PART_BYTES.  Nothing is shuffled."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    partitions = docs.rdd.getNumPartitions()
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    split = max(1, -(-int(total) // max(1, partitions) // PART_BYTES))
    part = F.spark_partition_id() * F.lit(split).cast("bigint") + F.pmod(F.xxhash64("doc_id", "text"), F.lit(split))
    name = f"prefix_free_parts_{uuid.uuid4().hex}"
    (docs.withColumn("part", part).write.format("parquet").option("compression", "zstd")
     .option("path", scratch_path(spark, "prefix-free-parts"))
     .bucketBy(min(max(1, partitions * split), MAX_BUCKETS), "part").sortBy("part").saveAsTable(name))
    return name, spark.table(name)


def remove_substrings(docs: DataFrame, rule: Parsing = Parsing(), group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, removed) of every row of ``docs``
    (doc_id, text): ``kept`` is the SHA-256 of the bytes that stay, ``removed`` the
    maximal removed runs, ends exclusive."""
    spark = docs.sparkSession
    name, parts = parted(docs)
    by_part = parts.groupBy("part")

    def round_of(work, answers: DataFrame, schema: str) -> DataFrame:
        return by_part.cogroup(answers.groupBy("part")).applyInArrow(work, schema)

    pieces = by_part.applyInArrow(_pieces(rule), PIECES)
    smallest = stored(pieces, "prefix-free-pieces")
    first = smallest.groupBy("c1", "c2").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    held = stored(smallest.join(first, ["c1", "c2"]).where("first < doc").select("part", "c1"), "prefix-free-held")
    triggers = round_of(_triggers(rule), held, TRIGGERS)
    repeated = stored(triggers.repartition("h").sortWithinPartitions("h").mapInArrow(_repeated, "h bigint, part bigint"),
                      "prefix-free-triggers")
    answers = held.select("part", F.lit(0).alias("kind"), F.col("c1").alias("value"), F.lit(0).cast("bigint").alias("bits")).unionAll(
        repeated.select("part", F.lit(1).alias("kind"), F.col("h").alias("value"), F.lit(0).cast("bigint").alias("bits")))
    phrases = round_of(_phrases(rule), answers, PHRASES)
    ordered = stored(phrases.repartition("h").sortWithinPartitions("h").mapInArrow(_ordered(rule, group), ORDERED),
                     "prefix-free-order")
    strings = ordered.where("w1 IS NOT NULL")
    least_doc = strings.groupBy("w1", "w2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    bits = ordered.where("w1 IS NULL").select("part", "phrase", "bits").unionAll(
        strings.join(least_doc, ["w1", "w2"]).where("first < doc").select("part", "phrase", "bits"))
    bits = bits.groupBy("part", "phrase").agg(F.bit_or("bits").alias("bits"))
    answers = answers.unionAll(bits.select("part", F.lit(2).alias("kind"), F.col("phrase").alias("value"), "bits"))
    out = stored(round_of(_removed(rule), answers, RESULT), "prefix-free-result")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out

