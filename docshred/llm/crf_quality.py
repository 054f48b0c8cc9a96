"""Line-level quality with a linear-chain conditional random field.

Every line that holds a word is labelled good or bad.  Its potentials come from
the shape of the line itself and of the lines before and after it, and from the
label of the line before.  Forward-backward gives each line's marginal, and the
marginals weighted by line length give the document's quality, which a logistic
model maps to a score between 0 and 1.

Training: documents of a bounded, class-balanced sample (about ``train_docs`` a class and
``train_bytes`` of text a class, no text above a sixteenth of that; cut into segments of
``segment`` lines for training only), until the gradient is small.  Lines start with
their document's label; as good lines also stand in bad documents, the lines of
bad documents that the first fit finds good are relabelled (each bad document
keeps its worst line as bad) before the second fit.

Null and empty texts, and texts without a word, have no line and the score 0.
Repeated rows are scored alike.  Without labels of both classes every document
with a word scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import bounded_sample, fold, slices, stored
from docshred.llm.toxicity_grammar import fit_logistic, labelled_sample
from docshred.llm.words import split_words

SCHEMA = "doc_id bigint, held_out boolean, score double, quality double, n_lines bigint, worst double"

# Byte classes of the line features.
SYMBOLS = b"#*$%&<>|=~^_{}[]\\@"
STOPS = b".!?"
# End of fixed values.
_CLASS = {"upper": np.arange(256, dtype=np.uint8)[65:91], "lower": np.arange(256, dtype=np.uint8)[97:123],
          "digit": np.arange(256, dtype=np.uint8)[48:58], "symbol": np.frombuffer(SYMBOLS, np.uint8),
          "bang": np.frombuffer(b"!", np.uint8), "pipe": np.frombuffer(b"|", np.uint8)}
_MEMBER = {k: np.isin(np.arange(256), v).astype(np.int32) for k, v in _CLASS.items()}
_IS_STOP = np.isin(np.arange(256), np.frombuffer(STOPS, np.uint8))
OWN_FEATURES = 13


@dataclass
class Lines:
    """Own features (lines x OWN_FEATURES), length in bytes, and first line of each text (one more)."""

    own: np.ndarray
    size: np.ndarray
    first: np.ndarray


def line_features(texts: list[str | None]) -> Lines:
    batch = split_words(texts, lower=False)
    n = len(batch.start)
    if not n:
        return Lines(np.zeros((0, OWN_FEATURES)), np.zeros(0), np.zeros(len(texts) + 1, dtype=np.int64))
    feeds = np.cumsum(batch.data == 10)
    line_no = np.where(batch.start > 0, feeds[batch.start - 1], 0)
    begin = np.concatenate(([0], np.flatnonzero(line_no[1:] != line_no[:-1]) + 1))
    words = np.diff(np.concatenate((begin, [n])))
    lo, hi = batch.start[begin], batch.end[begin + words - 1]
    size = (hi - lo).astype(float)

    def share(name: str) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(_MEMBER[name][batch.data])))
        return (total[hi] - total[lo]) / size

    same = np.concatenate(([False], batch.hash[1:] == batch.hash[:-1]))
    same[begin] = False
    repeats = np.add.reduceat(same, begin, dtype=np.int64) / np.maximum(words - 1, 1)
    long_words = np.add.reduceat(batch.end - batch.start > 12, begin, dtype=np.int64) / words
    total = np.concatenate(([0], np.cumsum(batch.end - batch.start)))
    mean_word = (total[begin + words] - total[begin]) / words
    line_hash = np.add.reduceat(batch.hash, begin)
    again = np.concatenate(([False], line_hash[1:] == line_hash[:-1]))
    upper, lower = share("upper"), share("lower")
    own = np.column_stack([
        np.ones(len(begin)), upper, lower, share("digit"), share("symbol") * 5, share("bang") * 5, share("pipe") * 5,
        repeats * 3, np.log1p(words) / 3, mean_word / 6, _IS_STOP[batch.data[hi - 1]], long_words, again])
    text_first = np.searchsorted(begin, batch.first)
    return Lines(own, size, text_first)


def gather(texts: list[str | None], step: int = 100) -> Lines:
    """``line_features`` of many texts, a few at a time (bounds the byte-wise arrays)."""
    parts = [line_features(texts[k:k + step]) for k in range(0, len(texts), step)] or [line_features([])]
    first, total = [np.zeros(1, np.int64)], 0
    for p in parts:
        first.append(p.first[1:] + total)
        total += len(p.own)
    return Lines(np.concatenate([p.own for p in parts]), np.concatenate([p.size for p in parts]), np.concatenate(first))


def with_neighbours(lines: Lines) -> np.ndarray:
    """Own features, then those of the line before and after in the same text (zeros at the edges)."""
    n = len(lines.own)
    before, after = np.zeros_like(lines.own), np.zeros_like(lines.own)
    if n:
        before[1:], after[:-1] = lines.own[:-1], lines.own[1:]
        starts = lines.first[:-1][np.diff(lines.first) > 0]
        ends = lines.first[1:][np.diff(lines.first) > 0] - 1
        before[starts] = 0
        after[ends] = 0
    return np.column_stack([lines.own, before, after])


class Chain:
    """Two-label chain: score of label good per line, and log potentials of label pairs."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def marginals(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and the expected label pairs summed (2 x 2).

        Scaled forward-backward over all texts at once, longest first, so that
        step t touches the texts that have a line t."""
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        start = first[:-1][order]
        length = length[order]
        score = x @ self.weights
        emit = np.empty((len(x), 2))
        emit[:, 1] = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        emit[:, 0] = 1 - emit[:, 1]
        emit = np.maximum(emit, 1e-12)
        trans = np.exp(self.pairs - self.pairs.max())
        steps = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")  # texts with at least t + 1 lines
        forward, backward = np.empty((len(x), 2)), np.ones((len(x), 2))
        prior = None
        for t in range(steps):
            at = start[:active[t]] + t
            f = emit[at] if prior is None else (prior[:active[t]] @ trans) * emit[at]
            prior = f / f.sum(axis=1, keepdims=True)
            forward[at] = prior
        pair_sum = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            k = active[t + 1]
            at = start[:k] + t
            coming = emit[at + 1] * backward[at + 1]
            both = forward[at][:, :, None] * trans[None] * coming[:, None, :]
            pair_sum += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = coming @ trans.T
            backward[at] = b / b.sum(axis=1, keepdims=True)
        good = forward * backward
        return good[:, 1] / good.sum(axis=1), pair_sum


def train_chain(x: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray, tolerance: float = 1e-3,
                max_steps: int = 2000, rate: float = 0.15, penalty: float = 1e-3) -> Chain:
    """Gradient ascent (Adam, falling rate) on the conditional log likelihood of the
    labels, until no component of its gradient (a mean over lines) exceeds ``tolerance``;
    ``max_steps`` only guards against data on which it never does.

    ``weight`` balances lines of the two labels; pair counts use equal weights."""
    chain = Chain(np.zeros(x.shape[1]), np.zeros((2, 2)))
    inner = np.ones(len(x), dtype=bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    nxt = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[nxt - 1], labels[nxt]), 1.0)
    moments = [np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))]
    scale = max(weight.sum(), 1.0)
    for step in range(1, max_steps + 1):
        p, pair = chain.marginals(x, first)
        grads = (x.T @ ((labels - p) * weight) / scale - penalty * chain.weights,
                 (seen - pair) / max(len(nxt), 1) - penalty * chain.pairs)
        if max(np.abs(g).max() for g in grads) <= tolerance:
            break
        pace = rate / np.sqrt(1 + step / 50)
        for k, (value, g) in enumerate(zip((chain.weights, chain.pairs), grads, strict=True)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            value += pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return chain


@dataclass
class QualityModel:
    chain: Chain | None
    logistic: np.ndarray

    def summary(self, texts: list[str | None]) -> np.ndarray:
        """(length-weighted quality, lines, worst line) of every text."""
        lines = gather(texts)
        count = np.diff(lines.first)
        out = np.zeros((len(texts), 3))
        out[:, 1] = count
        some = np.flatnonzero(count)
        if len(some) and self.chain is not None:
            p, _ = self.chain.marginals(with_neighbours(lines), lines.first)
            at = lines.first[:-1][some]
            out[some, 0] = np.add.reduceat(p * lines.size, at) / np.add.reduceat(lines.size, at)
            out[some, 2] = np.minimum.reduceat(p, at)
        return out

    def score(self, f: np.ndarray) -> np.ndarray:
        if self.chain is None:
            return np.where(f[:, 1] > 0, 0.5, 0.0)
        z = self.logistic[0] + f[:, [0]] @ self.logistic[1:]
        return np.where(f[:, 1] > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)


def fit_model(texts: list[str], y: np.ndarray, segment: int) -> QualityModel:
    lines = gather(texts)
    count = np.diff(lines.first)
    if not len(lines.own) or not 0 < y[count > 0].sum() < (count > 0).sum():
        return QualityModel(None, np.zeros(2))
    x = with_neighbours(lines)
    of_text = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(x)) - lines.first[of_text]
    edges = np.append(np.flatnonzero(place % segment == 0), len(x))
    labels = y[of_text].astype(int)
    text_size = np.bincount(of_text, weights=lines.size, minlength=len(texts))
    base = lines.size / text_size[of_text]  # every document weighs the same
    chain = None
    for _ in range(2):
        total = np.bincount(labels, weights=base, minlength=2)
        chain = train_chain(x, edges, labels, base / np.maximum(total, 1e-9)[labels] * total.sum() / 2)
        p, _ = chain.marginals(x, edges)
        worst = np.full(len(texts), np.inf)
        np.minimum.at(worst, of_text, p)
        labels = np.where((y[of_text] == 1) | ((p > 0.5) & (p > worst[of_text])), 1, 0)
    model = QualityModel(chain, np.zeros(2))
    f = model.summary(texts)
    some = f[:, 1] > 0
    model.logistic = fit_logistic(f[some][:, [0]], y[some].astype(float))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, train_docs: int = 1000, segment: int = 64, modulus: int = 4,
                  held: int = 2, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  train_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, held_out, score, quality, n_lines, worst) of every row of
    ``docs``; labels of ids in fold ``held`` are never read."""
    model = quality_model(docs, labels, train_docs, segment, modulus, held, id_col, text_col, label_col, train_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=2):
            f = shared.value.summary(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared.value.score(f)), pa.array(f[:, 0]),
                 pa.array(f[:, 1].astype(np.int64)), pa.array(f[:, 2])],
                ["doc_id", "held_out", "score", "quality", "n_lines", "worst"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (fold(F.col(id_col), modulus) == held).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, SCHEMA)


def quality_model(docs: DataFrame, labels: DataFrame, train_docs: int = 1000, segment: int = 64, modulus: int = 4,
                  held: int = 2, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  train_bytes: int = 8 << 20) -> QualityModel:
    sample = labelled_sample(docs, labels, label_col, lambda i: fold(i, modulus) != held, train_docs, id_col, text_col)
    size = F.octet_length("text")
    sample = bounded_sample(stored(sample.where(size <= train_bytes // 16), "quality-sample"), size, train_bytes,
                            F.concat(F.lit("bytes"), F.col("doc_id").cast("string")), by=F.col("y"))
    rows = sorted((r["doc_id"], r["text"], r["y"]) for r in sample.collect())
    return fit_model([r[1] for r in rows], np.array([r[2] for r in rows], dtype=int), segment)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``; all columns are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(quality_model(docs, labels, text_col=text_col, **options))
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=at):
            model = shared.value
            score = model.score(model.summary(batch.column(at).to_pylist()))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(work, docs.schema)
