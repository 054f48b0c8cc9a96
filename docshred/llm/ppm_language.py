"""Language identification by prediction by partial matching.

For every language a variable-order byte model (contexts of 0 to ``order``
bytes) gives each next byte a probability: its count under the longest context
that has seen it, after the escapes of longer contexts (method C: a context with
``d`` distinct followers among ``t`` occurrences escapes with ``d / (t + d)``),
down to a uniform byte.  The statistics are frozen after training; a text's code
length under a language is the exact sum over all its bytes, and the shortest
code wins.

The context trees of all languages are kept as one table per order: gram ->
code lengths per language, each computed by that language's own recursion, so
scoring a byte is one lookup (a miss adds the escapes and tries the next shorter
gram).  Training takes a bounded sample (``train_bytes`` over all languages, an
equal part each) of pieces of texts, so a language of a few very long texts has
its part too and no text exceeds it.

Null text and text without a letter give ``und`` with score 0; so does
everything if no row has a language.  Ties go to the smaller language name.
The score is the posterior of the best language under equal priors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import BROADCAST_KEYS, fold, slices, stored
from docshred.llm.words import mix

UNKNOWN = "und"
PIECE = 4096  # code points of a training piece
SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, code_bits double"


class GramTable:
    """Open-addressing table from 64-bit gram keys to row numbers (-1: absent)."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.rows = np.full(1 << bits, -1, dtype=np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.rows[slot[todo]] < 0
            _, one = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][one]
            self.keys[slot[put]], self.rows[slot[put]] = keys[put], put
            todo = todo[self.rows[slot[todo]] != todo]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        rows = self.rows[slot]
        miss = np.flatnonzero((rows >= 0) & (self.keys[slot] != keys))
        while len(miss):
            slot[miss] = (slot[miss] + 1) & self.mask
            rows[miss] = self.rows[slot[miss]]
            miss = miss[(rows[miss] >= 0) & (self.keys[slot[miss]] != keys[miss])]
        return rows


def grams(data: np.ndarray, width: int) -> np.ndarray:
    """Key of the ``width`` bytes that end at each position from ``width - 1`` on."""
    n = len(data) - width + 1
    key = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width):
        key = (key << np.uint64(8)) | data[k:k + len(key)]
    return key


def pad(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts joined with ``order`` line feeds before each, and where each starts."""
    sep = b"\n" * order
    starts = np.cumsum([order] + [len(t) + order for t in texts])
    return np.frombuffer(sep + sep.join([*texts, b""]), dtype=np.uint8), starts


class ContextTrees:
    """Frozen statistics of all languages up to ``order`` bytes of context."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = 4):
        self.order, self.languages = order, sorted(samples)
        count = len(self.languages)
        text = {k: pad(samples[k], order) for k in self.languages}
        self.levels = []  # per order: (gram table, bits per language, context table, escape bits)
        below: tuple[GramTable, np.ndarray] | None = None
        for k in range(order + 1):
            seen = {}
            for name in self.languages:
                data, starts = text[name]
                inside = np.ones(len(data), dtype=bool)
                for s in starts:
                    inside[s - order:s] = False  # padding is context only
                key = grams(data, k + 1)[inside[k:]]
                seen[name] = np.unique(key, return_counts=True)
            keys = np.unique(np.concatenate([u for u, _ in seen.values()]))
            contexts = np.unique(keys >> np.uint64(8))
            bits = np.zeros((len(keys), count), dtype=np.float32)
            escape = np.zeros((len(contexts), count), dtype=np.float32)
            if below is None:
                lower = np.full((len(keys), count), 8.0, dtype=np.float32)
            else:
                lower = below[1][below[0].find(keys & np.uint64((1 << (8 * k)) - 1))]
            for j, name in enumerate(self.languages):
                u, c = seen[name]
                where = np.searchsorted(contexts, u >> np.uint64(8))
                total = np.bincount(where, weights=c, minlength=len(contexts))
                distinct = np.bincount(where, minlength=len(contexts))
                has = distinct > 0
                escape[has, j] = -np.log2(distinct[has] / (total + distinct)[has])
                bits[:, j] = lower[:, j] + escape[np.searchsorted(contexts, keys >> np.uint64(8)), j]
                bits[np.searchsorted(keys, u), j] = -np.log2(c / (total + distinct)[where])
            table = GramTable(keys)
            self.levels.append((table, bits, GramTable(contexts), escape))
            below = (table, bits)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language (texts x languages)."""
        data, starts = pad(texts, self.order)
        n = len(data) - self.order
        if n <= 0:
            return np.zeros((len(texts), len(self.languages)))
        full = grams(data, self.order + 1)
        cost = np.zeros((n, len(self.languages)), dtype=np.float32)
        todo = np.arange(n)
        for k in range(self.order, -1, -1):
            table, bits, contexts, escape = self.levels[k]
            key = full[todo] if k == self.order else full[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            row = table.find(key)
            hit = row >= 0
            if hit.all() and len(todo) == n:
                cost = bits[row]
                todo = todo[:0]
                break
            cost[todo[hit]] += bits[row[hit]]
            todo, key = todo[~hit], key[~hit]
            if not len(todo):
                break
            context = contexts.find(key >> np.uint64(8))
            known = context >= 0
            cost[todo[known]] += escape[context[known]]
        cost[todo] += 8.0
        total = np.zeros((n + 1, len(self.languages)))
        np.cumsum(cost, axis=0, out=total[1:], dtype=np.float64)
        begin = starts[:-1] - self.order
        size = np.array([len(t) for t in texts])
        return total[begin + size] - total[begin]


def training_sample(docs: DataFrame, train_bytes: int, where: Column, id_col: str, text_col: str,
                    lang_col: str) -> dict[str, list[bytes]]:
    """At most about ``train_bytes`` of labelled text, shared evenly by the
    languages; brought to the driver.  Texts are taken in pieces of ``PIECE`` code
    points, chosen by the hash of id, text and piece number: of a language with
    less than its part every piece, else the same share of all its pieces."""
    rows = docs.where(where & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = stored(rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")), "languages")
    names = sizes.count()
    if not names:
        return {}
    sizes = F.broadcast(sizes) if names <= BROADCAST_KEYS else sizes
    share = F.lit(float(max(1, train_bytes // names))) / F.greatest("bytes", F.lit(1))
    last = F.greatest(F.floor((F.length("text") - 1) / PIECE), F.lit(0))
    pieces = F.filter(F.sequence(F.lit(0).cast("bigint"), last), lambda i: F.pmod(
        F.xxhash64("key", i), F.lit(1 << 30)) < F.lit(float(1 << 30)) * F.col("share"))
    chosen = rows.join(sizes, "lang").withColumn("share", share).select("lang", "text", F.explode(pieces).alias("i"))
    piece = F.substring("text", (F.col("i") * PIECE + 1).cast("int"), F.lit(PIECE))
    out: dict[str, list[bytes]] = {}
    for r in chosen.select("lang", F.encode(piece, "utf-8").alias("raw")).collect():
        out.setdefault(r["lang"], []).append(bytes(r["raw"]))
    return {k: sorted(v) for k, v in out.items()}


def identify(docs: DataFrame, train_bytes: int = 4 << 20, order: int = 4, modulus: int = 5, held: int = 0,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, code_bits) per row; learns from rows
    whose id fold is not ``held``, never reads a language to predict."""
    part = fold(F.col(id_col), modulus)
    samples = training_sample(docs, train_bytes, part != held, id_col, text_col, lang_col)
    spark = docs.sparkSession
    trees = spark.sparkContext.broadcast(ContextTrees(samples, order)) if samples else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=2, max_bytes=1 << 20):
            texts = batch.column(2).to_pylist()
            speech = [t is not None and any(map(str.isalpha, t)) for t in texts]
            best, score, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
            if trees is not None:
                model = trees.value
                chosen = [i for i, s in enumerate(speech) if s]
                lengths = model.code_lengths([texts[i].encode("utf-8", "surrogatepass") for i in chosen])
                for i, row in zip(chosen, lengths, strict=True):
                    j = int(np.argmin(row))
                    best[i], bits[i] = model.languages[j], float(row[j])
                    score[i] = float(1.0 / np.exp2(np.clip(row[j] - row, -1000, 0)).sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score, pa.float64()),
                 pa.array(bits, pa.float64())], ["doc_id", "held_out", "lang_pred", "score", "code_bits"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (part == held).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, SCHEMA)
