"""Toxicity scoring with a weighted finite-state clause grammar.

Words are mapped to classes by a lexicon: insults and threats with weights,
targets, negations and verbs of reported speech.  Four transducers read the
class sequence of a clause: negation weakens what stands in its scope, reported
speech what follows it, targets strengthen an insult and are required by a
threat; they are composed once into one transducer, and a clause's score is the
total weight of its best path.  A target may stand before the word it goes with or
behind it: the target transducer guesses one to come and must then meet it.
Isolated weak words and threats without a target score nothing; only clauses that
the grammar accepts count.

There is no list of insults: they are learned from the labels of a bounded sample
(``train_docs`` rows, outside the held-out fold): words and word beginnings that occur in at least
``min_share`` of the toxic sample and whose smoothed log odds reach
``min_weight``.  A document's score is a logistic function of its best clause
and of the sum over its clauses, fitted on the same sample.

Null and empty texts have no clause and get the score of a text without
matches.  Repeated rows are scored alike.  Without toxic labels only the fixed
list of threats counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import fold, slices, stored
from docshred.llm.words import hash_ranges, split_words

# Word lists of the classes, weights of the grammar.
THREATS = ("kill destroy hurt beat hunt töten töte vernichten vernichte schlagen schlage "
           "tuer tue frapper frappe détruire détruis matar mato destruir destruyo golpear golpeo")
TARGETS = ("you your yours yourself they them he she du dich dir dein deine ihr euch sie "
           "tu toi te vous votre tes usted ustedes te ti vosotros su")
NEGATIONS = "not never no don't isn't aren't nicht kein keine nie pas jamais ne no nunca jamás"
REPORTS = ("said says called calls wrote reported claims sagte nannte schrieb berichtet dit appelle écrit "
           "dijo llamó escribió")
THREAT_WEIGHT, TARGET_BONUS = 4.0, 0.5
NEGATED, REPORTED = -1.5, -1.0
NEGATION_SCOPE, TARGET_SCOPE = 3, 4
CLAUSE_END = b".!?;:,"
PREFIX_LENGTHS = (3, 4, 5, 6, 7, 8)
# End of fixed values.

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "I", "T", "Y", "N", "R", "o"
SCHEMA = "doc_id bigint, held_out boolean, score double, clauses bigint, best double, total double"


@dataclass
class Transducer:
    """Arcs (state, input) -> [(output, weight, next state)]; state 0 starts,
    every state accepts with the weight in ``final`` (0 if not named)."""

    arcs: dict[tuple[int, str], list[tuple[str, float, int]]] = field(default_factory=dict)
    final: dict[int, float] = field(default_factory=dict)

    def add(self, state: int, symbol: str, output: str, weight: float, to: int) -> None:
        self.arcs.setdefault((state, symbol), []).append((output, weight, to))

    def compose(self, after: "Transducer") -> "Transducer":
        """Feed this transducer's output to ``after``."""
        out, number, todo = Transducer(), {(0, 0): 0}, [(0, 0)]
        symbols = {s for _, s in self.arcs}
        while todo:
            a, b = todo.pop()
            here = number[a, b]
            out.final[here] = self.final.get(a, 0.0) + after.final.get(b, 0.0)
            for symbol in symbols:
                for mid, w, to in self.arcs.get((a, symbol), ()):
                    for output, v, to2 in after.arcs.get((b, mid), ()):
                        if (to, to2) not in number:
                            number[to, to2] = len(number)
                            todo.append((to, to2))
                        out.add(here, symbol, output, w + v, number[to, to2])
        return out

    def best(self, symbols: list[tuple[str, float]]) -> float:
        """Weight of the best path over (class, word weight); a word's weight
        counts on arcs that output a hit."""
        paths = {0: 0.0}
        for symbol, weight in symbols:
            step: dict[int, float] = {}
            for state, total in paths.items():
                for output, w, to in self.arcs.get((state, symbol), ()):
                    value = total + (max(weight + w, 0.0) if output == "hit" else w)
                    if value > step.get(to, -np.inf):
                        step[to] = value
            paths = step
        return max((v + self.final.get(s, 0.0) for s, v in paths.items()), default=0.0)


def machines() -> tuple[Transducer, Transducer, Transducer, Transducer]:
    """Negation, reported speech, target, threat/insult over class symbols.

    A core symbol is written class + modifiers, e.g. ``I-`` (negated)."""
    negation = Transducer()
    for state in range(NEGATION_SCOPE + 1):
        left = max(state - 1, 0)
        for symbol in (INSULT, THREAT):
            negation.add(state, symbol, symbol + ("-" if state else ""), 0.0, left)
        for symbol in (TARGET, REPORT, OTHER):
            negation.add(state, symbol, symbol, 0.0, left)
        negation.add(state, NEGATION, OTHER, 0.0, NEGATION_SCOPE)
    reported = Transducer()
    cores = [c + m for c in (INSULT, THREAT) for m in ("", "-")]
    for state in (0, 1):
        for symbol in cores:
            reported.add(state, symbol, symbol + ("r" if state else ""), 0.0, state)
        for symbol in (TARGET, OTHER):
            reported.add(state, symbol, symbol, 0.0, state)
        reported.add(state, REPORT, OTHER, 0.0, 1)
    target = Transducer()
    cores = [c + m for c in cores for m in ("", "r")]
    for state in range(TARGET_SCOPE + 1):
        left = max(state - 1, 0)
        for symbol in cores:
            target.add(state, symbol, symbol + ("y" if state else ""), 0.0, left)
        target.add(state, TARGET, OTHER, 0.0, TARGET_SCOPE)
        target.add(state, OTHER, OTHER, 0.0, left)
    # states that expect a target within so many words: no end but by meeting it
    for symbol in cores:
        target.add(0, symbol, symbol + "y", 0.0, 2 * TARGET_SCOPE)
    for left in range(1, TARGET_SCOPE + 1):
        state = TARGET_SCOPE + left
        target.final[state] = -np.inf
        target.add(state, TARGET, OTHER, 0.0, TARGET_SCOPE)
        if left > 1:
            target.add(state, OTHER, OTHER, 0.0, state - 1)
            for symbol in cores:
                target.add(state, symbol, symbol + "y", 0.0, state - 1)
    hits = Transducer()
    hits.add(0, OTHER, OTHER, 0.0, 0)
    for symbol in [c + m for c in cores for m in ("", "y")]:
        weight = NEGATED * ("-" in symbol) + REPORTED * ("r" in symbol) + TARGET_BONUS * ("y" in symbol)
        accepted = symbol[0] == INSULT or "y" in symbol  # a threat needs its target
        hits.add(0, symbol, "hit" if accepted else OTHER, weight if accepted else 0.0, 0)
    return negation, reported, target, hits


def grammar() -> Transducer:
    """negation o reported speech o target o threat/insult."""
    negation, reported, target, hits = machines()
    return negation.compose(reported).compose(target).compose(hits)


def _hash_words(words: list[str]) -> np.ndarray:
    batch = split_words([" ".join(words)], punctuation=False)
    return batch.hash


class Lexicon:
    """Classes and weights of words, and of words by their beginnings."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.classes: dict[int, tuple[str, float]] = {}
        for symbol, names, weight in ((TARGET, TARGETS.split(), 0.0), (NEGATION, NEGATIONS.split(), 0.0),
                                      (REPORT, REPORTS.split(), 0.0), (THREAT, THREATS.split(), THREAT_WEIGHT)):
            self.classes.update((int(h), (symbol, weight)) for h in _hash_words([n.replace("'", "") for n in names]))
        for word, weight in words.items():
            self.classes.update((int(h), (INSULT, weight)) for h in _hash_words([word])[:1])
        self.core = np.sort(np.array([h for h, (s, _) in self.classes.items() if s in (INSULT, THREAT)], dtype=np.uint64))
        self.beginnings: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[tuple[int, float]]] = {}
        for text, weight in beginnings.items():
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            h = hash_ranges(raw, np.array([0]), np.array([len(raw)]))[0]
            by_size.setdefault(len(raw), []).append((int(h), weight))
        for size, rows in by_size.items():
            rows.sort()
            self.beginnings[size] = (np.array([h for h, _ in rows], dtype=np.uint64), np.array([w for _, w in rows]))

    def insults_by_beginning(self, batch) -> np.ndarray:
        """Weight of every word by its best listed beginning (0: none)."""
        weight = np.zeros(len(batch.start))
        length = batch.end - batch.start
        for size, (keys, weights) in self.beginnings.items():
            at = np.flatnonzero(length >= size)
            h = hash_ranges(batch.data, batch.start[at], batch.start[at] + size)
            k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            weight[at] = np.maximum(weight[at], np.where(keys[k] == h, weights[k], 0.0))
        return weight


class Scorer:
    """Clause scores of texts: the lexicon and the composed grammar."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.grammar = lexicon, grammar()

    def features(self, texts: list[str | None]) -> np.ndarray:
        """(matched clauses, best clause, sum over clauses, words) of every text."""
        batch = split_words([None if t is None else t.lower().replace("'", "") for t in texts], punctuation=False)
        out = np.zeros((len(texts), 4))
        n = len(batch.start)
        out[:, 3] = np.diff(batch.first)
        if not n:
            return out
        by_beginning = self.lexicon.insults_by_beginning(batch)
        core = by_beginning > 0
        if len(self.lexicon.core):
            k = np.minimum(np.searchsorted(self.lexicon.core, batch.hash), len(self.lexicon.core) - 1)
            core |= self.lexicon.core[k] == batch.hash
        hits = np.flatnonzero(core)
        if not len(hits):
            return out
        ends = np.concatenate(([0], np.cumsum(np.isin(batch.data, np.frombuffer(CLAUSE_END + b"\n", np.uint8)))))
        clause = ends[batch.start]  # words of a clause have seen the same number of ends
        text_of = np.searchsorted(batch.first, np.arange(n), "right") - 1
        classes = self.lexicon.classes
        done = -1
        for i in hits.tolist():
            if clause[i] == done:
                continue
            done = clause[i]
            lo = int(np.searchsorted(clause, done))
            hi = int(np.searchsorted(clause, done, "right"))
            symbols = []
            for j in range(lo, hi):
                symbol, weight = classes.get(int(batch.hash[j]), (OTHER, 0.0))
                if by_beginning[j] > weight:
                    symbol, weight = INSULT, float(by_beginning[j])
                symbols.append((symbol, weight))
            score = self.grammar.best(symbols)
            if score > 0:
                row = out[text_of[i]]
                row += (1, 0, score, 0)
                row[1] = max(row[1], score)
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, where: Column, bound: int, id_col: str,
                    text_col: str) -> DataFrame:
    """(doc_id, text, y) of at most about ``bound`` labelled rows of each class,
    chosen by the hash of the id; the chosen labels are broadcast (bounded)."""
    known = labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("_id").isNotNull() & F.col("y").isNotNull()).withColumn("y", (F.col("y") == 1).cast("int"))
    known = known.where(where(F.col("_id")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, bound / n))).otherwise(share)
    spread = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = F.broadcast(known.where(spread < share).distinct())
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        chosen, F.col("doc_id") == F.col("_id")).where(F.col("text").isNotNull()).select("doc_id", "text", "y")


def learn_lexicon(sample: DataFrame, min_share: float, min_weight: float) -> Lexicon:
    """Insult words and beginnings from document frequencies in the sample."""
    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic:
        return Lexicon({}, {})
    words = F.filter(F.split(F.regexp_replace(F.lower("text"), "'", ""), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"),
                     lambda w: F.length(w) >= PREFIX_LENGTHS[0])
    parts = F.array_distinct(F.flatten(F.transform(words, lambda w: F.concat(F.array(F.concat(F.lit("="), w)), *(
        F.when(F.length(w) >= k, F.array(F.substring(w, 1, k))).otherwise(F.array().cast("array<string>"))
        for k in PREFIX_LENGTHS)))))
    counts = sample.select("y", F.explode(parts).alias("part")).groupBy("part").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).where(
        F.col("pos") >= max(3, int(min_share * toxic)))
    weight = F.log((F.col("pos") + 0.5) / (toxic + 1.0)) - F.log((F.col("neg") + 0.5) / (clean + 1.0))
    rows = counts.select("part", weight.alias("weight")).where(F.col("weight") >= min_weight).collect()
    found = {r["part"]: r["weight"] for r in rows}
    beginnings: dict[str, float] = {}
    for part in sorted((p for p in found if p[0] != "="), key=len):
        # a longer beginning is kept only where it says more than the shorter ones
        if all(found[part] > beginnings.get(part[:k], -np.inf) + 0.5 for k in PREFIX_LENGTHS if k < len(part)):
            beginnings[part] = found[part]
    words_found = {p[1:]: w for p, w in found.items() if p[0] == "="}
    return Lexicon(words_found, beginnings)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (bias first) of a ridge-penalised logistic model, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def squash(f: np.ndarray) -> np.ndarray:
    """Model inputs from clause features: best clause, the log of the sum, and
    how much of it such a long text may hold by chance."""
    held = f[:, 0] > 0
    return np.column_stack([held, f[:, 1], np.log1p(f[:, 2]), held * np.log1p(f[:, 3])])


def score_toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = 4000, min_share: float = 0.02,
                   min_weight: float = 1.5, modulus: int = 3, held: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, clauses, best, total) of every row of ``docs``;
    labels of ids in fold ``held`` are never read."""
    # written once: the lexicon's counts and the fit both read it
    sample = stored(labelled_sample(docs, labels, label_col, lambda i: fold(i, modulus) != held, train_docs, id_col, text_col),
                    "toxicity-sample")
    scorer = Scorer(learn_lexicon(sample, min_share, min_weight))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(scorer)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            f = shared.value.features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(2), *(pa.array(f[:, k]) for k in range(4))],
                                             ["y", "clauses", "best", "total", "words"])

    seen = sample.mapInArrow(measure, "y int, clauses double, best double, total double, words double").collect()
    x, y = np.array([r[1:] for r in seen], dtype=float).reshape(-1, 4), np.array([r[0] for r in seen], dtype=float)
    if 0 < y.sum() < len(y):
        model = fit_logistic(squash(x), y)
    else:
        model = np.array([-THREAT_WEIGHT, 0.0, 2.0, 0.0, 0.0])
    weights = model.tolist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=2):
            f = shared.value.features(batch.column(2).to_pylist())
            z = weights[0] + squash(f) @ np.array(weights[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))),
                 pa.array(f[:, 0].astype(np.int64)), pa.array(f[:, 1]), pa.array(f[:, 2])],
                ["doc_id", "held_out", "score", "clauses", "best", "total"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (fold(F.col(id_col), modulus) == held).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, SCHEMA)
