"""Cost-balanced sequence packing.

A document's attention cost is estimated as ``linear * n + quadratic * n**2``.
Within a bounded group of documents, full windows of ``capacity`` tokens become
sequences of their own; the remainders, in descending cost, each go to the
lowest-cost sequence with room, and are cut only where no sequence has room.
The group's last tokens (fewer than one window) become sequences whose lengths
are powers of two, so a group carries no padding.

Groups are runs of rows inside one input partition, closed at ``group_tokens``:
no shuffle, memory bounded by the group plus one document, and a task that is
run again packs the same rows in the same way.  ``sequence_id`` is the partition
number times 2**32 plus a counter.

Tokens: ids of a public tokenizer file without special tokens, then one
``end_id``; taken from the same vocabulary's ranks where they are given.  Null or empty text is that one id.  Repeated rows are packed as
often as they occur; a null id stays null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import slices

# A space before one of these characters always starts a new pre-token, so a
# text may be cut there and its pieces encoded apart.
_CUT = re.compile("(?= [!-~À-ſ])")
_NO_CUT = re.compile(" (?![!-~À-ſ])")   # a space that is no place to cut
CACHE_BYTES = 48 << 20  # of pieces and their ids that a worker keeps, about
ENTRY_BYTES = 200       # of an entry besides its text and ids

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


class TokenBytes:
    """Ids of texts as little-endian uint32 bytes, with a cache by cut, bounded by bytes.

    Where every space of a text is a place to cut, its pieces are what ``str.split``
    gives, each but the first with a space before it; other texts are cut by the
    pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.whole: dict[str, bytes] = {}       # pieces as they stand
        self.spaced: dict[str, bytes] = {}      # pieces behind a space
        self.held = 0

    def _learn(self, known: dict[str, bytes], pieces: set[str], before: str) -> None:
        new = sorted(pieces.difference(known))
        for piece, e in zip(new, self.tokenizer.encode_batch_fast([before + p for p in new], add_special_tokens=False),
                            strict=True):
            known[piece] = np.asarray(e.ids, dtype="<u4").tobytes()
            self.held += ENTRY_BYTES + len(piece) + len(known[piece])

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > CACHE_BYTES:
            self.whole.clear()
            self.spaced.clear()
            self.held = 0
        whole, spaced, cut = set(), set(), []
        for t in texts:
            if _NO_CUT.search(t):
                pieces = _CUT.split(t)
                whole.update(pieces)
                cut.append((pieces, None))
            else:
                pieces = t.split(" ")
                whole.add(pieces[0])
                spaced.update(pieces[1:])
                cut.append((pieces[:1], pieces[1:]))
        self._learn(self.whole, whole, "")
        self._learn(self.spaced, spaced, " ")
        first, rest = self.whole.__getitem__, self.spaced.__getitem__
        return [b"".join(map(first, a)) + (b"".join(map(rest, b)) if b else b"") for a, b in cut]


class RankBytes:
    """The same ids from the vocabulary's ranks (a tiktoken file and its split pattern):
    a text at a time, nothing kept."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as f:
            known = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=known, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encoding.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() for t in texts]


@lru_cache(maxsize=1)
def token_bytes(path: str, ranks: str | None = None, pattern: str | None = None) -> TokenBytes | RankBytes:
    return RankBytes(ranks, pattern) if ranks and pattern else TokenBytes(path)


@dataclass
class Packer:
    """Packs one group; pieces are (document index, start, length, sequence, offset)."""

    capacity: int
    linear: float
    quadratic: float
    pieces: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def cost(self, n):
        return self.linear * n + self.quadratic * n * n

    def pack(self, lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
        rest: list[tuple[int, int, int]] = []
        for doc, n in enumerate(lengths):
            full = n - n % self.capacity
            for start in range(0, full, self.capacity):
                self._own(doc, start, self.capacity)
            if n > full:
                rest.append((n - full, doc, full))
        rest.sort(key=lambda r: (-r[0], r[1]))
        open_count = sum(r[0] for r in rest) // self.capacity
        tail = self._balance(rest, open_count)
        self._powers_of_two(tail)
        return self.pieces

    def _own(self, doc: int, start: int, length: int) -> None:
        self.pieces.append((doc, start, length, self.sequences, 0))
        self.sequences += 1

    def _balance(self, rest, count: int) -> list[tuple[int, int, int]]:
        first, used = self.sequences, np.zeros(count, dtype=np.int64)
        costs = np.zeros(count)
        self.sequences += count
        tail = []

        def put(k: int, n: int, doc: int, start: int) -> None:
            self.pieces.append((doc, start, n, first + k, int(used[k])))
            used[k] += n
            costs[k] += self.cost(n)

        for n, doc, start in rest:
            while n:
                room = self.capacity - used
                fits = np.flatnonzero(room >= n)
                if len(fits):
                    put(int(fits[np.argmin(costs[fits])]), n, doc, start)
                    break
                k = int(np.argmax(room)) if count else 0
                if not count or not room[k]:
                    tail.append((n, doc, start))
                    break
                size = int(room[k])
                put(k, size, doc, start)
                n, start = n - size, start + size
        return tail

    def _powers_of_two(self, tail) -> None:
        """The last tokens, in sequences of the binary digits of their number."""
        left = sum(t[0] for t in tail)
        used = size = 0
        for n, doc, start in tail:
            while n:
                if used == size:
                    size, used = 1 << (left.bit_length() - 1), 0
                    left -= size
                    self.sequences += 1
                take = min(n, size - used)
                self.pieces.append((doc, start, take, self.sequences - 1, used))
                used, n, start = used + take, n - take, start + take


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, linear: float = 1.0,
                   quadratic: float = 1.0 / 1024, end_id: int = 0, group_tokens: int = 1 << 20,
                   id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
                   pattern: str | None = None) -> DataFrame:
    """One row per piece: its document, token range, ids and place in a sequence.

    ``tokenizer`` is a tokenizers file; ``ranks`` and ``pattern`` are the same
    vocabulary as a tiktoken file and its split pattern, where there is one: the ids
    are equal and cost a fraction."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(tokenizer, ranks, pattern)
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        ids, docs_ids, held, done = [], [], 0, 0
        for batch in slices(batches):
            encoded = tokens.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc, e in zip(batch.column(0).to_pylist(), encoded, strict=True):
                docs_ids.append(doc)
                ids.append(e + end)
                held += len(ids[-1]) // 4
                if held >= group_tokens:
                    out, n = emit(docs_ids, ids, base + done)
                    yield out
                    ids, docs_ids, held, done = [], [], 0, done + n
        if ids:
            yield emit(docs_ids, ids, base + done)[0]

    def emit(doc_ids: list, ids: list[bytes], base: int) -> tuple[pa.RecordBatch, int]:
        packer = Packer(capacity, linear, quadratic)
        pieces = packer.pack([len(e) // 4 for e in ids])
        doc, start, length, seq, offset = (list(c) for c in zip(*pieces, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([doc_ids[d] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             pa.array([ids[d][4 * s:4 * (s + n)] for d, s, n in zip(doc, start, length, strict=True)], pa.binary()),
             pa.array([len(ids[d]) // 4 for d in doc], pa.int64()),
             pa.array([base + s for s in seq], pa.int64()), pa.array(offset, pa.int64())],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]), packer.sequences

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, SCHEMA)


def piece_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` (unsigned, over the little-endian ids) for the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
