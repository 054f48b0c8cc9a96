"""Hard negatives by spanning-tree bounds over the anchors.

Anchors are the query rows of a similarity search; a row's score is its integer
inner product with the anchor.  An anchor's positives are its best rows of the
same label; for each positive the best rows of other labels whose score lies in a
window below the positive's score are its hard negatives.

1. Rows: label and vector present, components finite; components become
   floor(scale * x).  They are stored once.
2. Anchors are dealt into blocks of at most ``BLOCK`` by label and the hash of
   their id; a task builds each block's minimum spanning tree by distance.
3. Waves of blocks (at most ``WAVE_BYTES`` of vectors) are sent to all tasks, and
   every task scores its rows slice by slice, down the trees.  At the root the
   scores are computed.  Elsewhere |<c, x> - <p, x>| <= |c - p| |x| for an anchor c
   and its parent p, so the parent's score (or its bounds) plus or minus the edge
   length times the row's norm bound the row's score at c.  Only rows whose bounds
   overlap what is still wanted are scored again: for positives, rows of the
   anchor's label that can reach the best found so far; for negatives, rows of
   other labels whose bounds overlap a window, from its lower end or the last of
   the best found in it.
4. A task gives at most ``positives`` rows an anchor, or ``negatives`` rows a
   window, and the best of all tasks stay.

Bounds only spare work: scores that count are computed exactly, in double
precision while every sum stays below 2^53, else with Python's integers.  Ties go to
the smaller vec_id.  Work is anchors times rows, as the query set is given against
all rows; rows are never joined or shuffled, only results are.

Defined cases: rows with a null or non-finite component, null label or vector take
no part, nor do rows without vec_id; of rows that share a vec_id the one with the
smallest (label, vector) takes part; a shorter vector is filled up with zeros;
empty tables give no rows.  Scores beyond 64 bits are cut to the nearest bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docshred.llm.common import stored

BLOCK = 1024                # anchors of a tree
WAVE_BYTES = 64 << 20       # anchor vectors that all tasks hold at a time
SLICE_ROWS = 4096           # rows scored together
EXACT = float(1 << 53)

TREE = "block bigint, dim int, exact boolean, ids binary, labels binary, parents binary, edges binary, vectors binary"


@dataclass(frozen=True)
class Rule:
    positives: int = 5
    negatives: int = 3
    low: int = 50            # window in percent of the positive's score
    high: int = 95


def usable_rows(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): rows that take part, components as integers."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = ~F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select("vec_id", "label", x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(good)
    whole = F.struct(F.col("label").cast("bigint").alias("label"), F.transform("x", lambda e: F.floor(e * scale)).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(whole).alias("r")).select("vec_id", "r.label", "r.v")


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Vectors as rows of doubles (integers as objects where doubles are not exact)."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    kind = np.float64 if np.abs(flat.astype(np.float64)).max(initial=0) < EXACT else object
    out = np.zeros((len(sizes), dim), dtype=kind)
    out[np.arange(dim) < sizes[:, None]] = flat.astype(kind)
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Upper bounds of the rows' norms."""
    x = x.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", x, x)) * (1 + 1e-9)


def scores(x: np.ndarray, c: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products of the rows with ``c``; ``largest`` bounds the products' sums."""
    if largest < EXACT and x.dtype != object and c.dtype != object:
        return (x @ c).astype(np.int64)
    big = [sum(int(a) * int(b) for a, b in zip(row, c)) for row in x.tolist()]
    return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in big], dtype=np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree by distance (Prim): rows in an order where parents come
    first, each one's parent (place in the order, -1 for the root) and edge length
    (rounded up)."""
    x = x.astype(np.float64)
    n = len(x)
    square = np.einsum("ij,ij->i", x, x)
    order, parent, edge = np.empty(n, np.int64), np.full(n, -1), np.zeros(n)
    near, via = np.full(n, np.inf), np.zeros(n, np.int64)
    at = 0
    for k in range(n):
        order[k] = at
        near[at] = -1
        d = np.maximum(square + square[at] - 2 * (x @ x[at]), 0)
        closer = (d < near)
        near[closer], via[closer] = d[closer], k
        if k + 1 < n:
            at = int(np.argmin(np.where(near < 0, np.inf, near)))
            parent[k + 1] = via[at]
            edge[k + 1] = np.linalg.norm(x[at] - x[order[via[at]]]) * (1 + 1e-9) + 1e-6
    return order, parent, edge


def _trees(dim: int):
    def work(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("vec_id", "ascending")])
        x = _matrix(group.column("v").combine_chunks(), dim)
        order, parent, edge = spanning_tree(x)
        exact = x.dtype != object  # whole doubles; else integers as text
        raw = x[order].tobytes() if exact else ",".join(map(str, x[order].ravel().tolist())).encode()
        ids, labels = (group.column(c).to_numpy()[order].astype(np.int64).tobytes() for c in ("vec_id", "label"))
        return pa.table({"block": [key[0].as_py()], "dim": pa.array([dim], pa.int32()), "exact": [exact], "ids": [ids], "labels": [labels],
                         "parents": [parent.astype(np.int64).tobytes()], "edges": [edge.tobytes()], "vectors": [raw]})
    return work


class Tree:
    """One block of anchors as tasks use it."""

    def __init__(self, row):
        self.ids, self.labels, self.parents = (np.frombuffer(row[k], np.int64) for k in ("ids", "labels", "parents"))
        self.edges = np.frombuffer(row["edges"], np.float64)
        if row["exact"]:
            flat = np.frombuffer(row["vectors"], np.float64)
        else:
            flat = np.array([int(v) for v in row["vectors"].decode().split(",")], dtype=object)
        self.vectors = flat.reshape(len(self.ids), row["dim"])
        self.norms = _norms(self.vectors)


def anchor_trees(anchors: DataFrame, dim: int) -> DataFrame:
    """Spanning trees of the anchors, one row a block.  A label's anchors are dealt
    by the hash of their ids into blocks of BLOCK on average, so that no group grows
    with the table."""
    sizes = anchors.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("_parts"))
    dealt = anchors.join(sizes, "label").withColumn(
        "block", F.xxhash64("label", F.pmod(F.xxhash64("vec_id"), F.col("_parts"))))
    return dealt.select("block", "vec_id", "label", "v").groupBy("block").applyInArrow(_trees(dim), TREE)


def descend(tree: Tree, x: np.ndarray, norms: np.ndarray, wanted):
    """Walks the tree over the rows ``x``.  For every anchor k, ``wanted(k, low, high)``
    gives the places of the rows to be scored from the bounds of all rows' scores,
    and is then called with them and their scores: ``take(places, scores)``."""
    top = float(np.abs(norms).max(initial=0)) * float(tree.norms.max(initial=0))
    last = np.zeros(len(tree.ids), np.int64)  # the last child: then a parent's bounds can go
    has = tree.parents >= 0
    np.maximum.at(last, tree.parents[has], np.flatnonzero(has))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k, p in enumerate(tree.parents.tolist()):
        if p < 0:
            low = high = scores(x, tree.vectors[k], top).astype(np.float64)
            places, take = wanted(k, low, high)
            found = low[places].astype(np.int64) if top < EXACT else scores(x[places], tree.vectors[k], top)
            if top >= EXACT:  # doubles may have been rounded
                low, high = low - np.abs(low) * 1e-15 - 1, high + np.abs(high) * 1e-15 + 1
        else:
            reach = tree.edges[k] * norms
            slack = 0 if top < EXACT else top * 1e-12
            low, high = bounds[p][0] - reach - slack, bounds[p][1] + reach + slack
            places, take = wanted(k, low, high)
            if 2 * len(places) > len(x):
                all_scores = scores(x, tree.vectors[k], top)
                low, high, found = all_scores.astype(np.float64), all_scores.astype(np.float64), all_scores[places]
            else:
                found = scores(x[places], tree.vectors[k], top)
                low[places] = high[places] = found
            if last[p] == k:
                del bounds[p]
        if last[k] > k:
            bounds[k] = (low, high)
        take(places, found)


def best_of(score: np.ndarray, ids: np.ndarray, limit: int) -> np.ndarray:
    """Places of the ``limit`` best: higher score, then smaller id."""
    if len(score) > 4 * limit:
        least = np.partition(score, len(score) - limit)[len(score) - limit]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], -score[near]))[:limit]]
    return np.lexsort((ids, -score))[:limit]


class Best:
    """The best rows found so far of one anchor or window."""

    def __init__(self, limit: int):
        self.limit, self.score, self.ids = limit, np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> float:
        return float(self.score[-1]) if len(self.score) == self.limit else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score):
            score, ids = np.concatenate((self.score, score)), np.concatenate((self.ids, ids))
            top = best_of(score, ids, self.limit)
            self.score, self.ids = score[top], ids[top]


def _sliced(batches: Iterator[pa.RecordBatch], dim: int):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            x = _matrix(part.column(2), dim)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), x, _norms(x)


def _positives(trees, dim: int, rule: Rule):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Tree(r) for r in trees.value]
        best = [[Best(rule.positives) for _ in t.ids] for t in held]
        for ids, labels, x, norms in _sliced(batches, dim):
            for tree, of in zip(held, best):
                def wanted(k, low, high):
                    places = np.flatnonzero((labels == tree.labels[k]) & (ids != tree.ids[k]) & (high >= of[k].least()))
                    return places, lambda at, found: of[k].add(found, ids[at])
                descend(tree, x, norms, wanted)
        for tree, of in zip(held, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(tree.ids, [len(b.ids) for b in of])), pa.array(np.concatenate([b.ids for b in of])),
                 pa.array(np.concatenate([b.score for b in of]))], ["anchor_id", "positive_id", "positive_score"])
    return work


def windows(score: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole score with low * s <= 100 * n <= high * s."""
    s = [int(v) for v in score]
    return (np.array([-(-rule.low * v // 100) for v in s], np.float64),
            np.array([rule.high * v // 100 for v in s], np.float64))


def _negatives(trees, positives, dim: int, rule: Rule):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Tree(r) for r in trees.value]
        known = positives.value  # anchor -> distinct scores of its positives
        spans = [[windows(known.get(a, np.empty(0, np.int64)), rule) for a in t.ids.tolist()] for t in held]
        best = [[[Best(rule.negatives) for _ in lo] for lo, _ in s] for s in spans]
        for ids, labels, x, norms in _sliced(batches, dim):
            for tree, span, of in zip(held, spans, best):
                def wanted(k, low, high):
                    near = np.zeros(len(ids), bool)
                    for lo, hi, b in zip(*span[k], of[k]):
                        if lo <= hi:
                            near |= (high >= max(lo, b.least())) & (low <= hi)
                    places = np.flatnonzero(near & (labels != tree.labels[k]))

                    def take(at, found):
                        for lo, hi, b in zip(*span[k], of[k]):
                            inside = (found >= max(lo, b.least())) & (found <= hi)
                            b.add(found[inside], ids[at[inside]])
                    return places, take
                descend(tree, x, norms, wanted)
        for tree, of in zip(held, best):
            flat = [(anchor, score, b) for anchor, found in zip(tree.ids.tolist(), of)
                    for score, b in zip(known.get(anchor, ()), found)]
            many = [len(b.ids) for _, _, b in flat]
            none = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([f[0] for f in flat], np.int64), many)),
                 pa.array(np.repeat(np.array([f[1] for f in flat], np.int64), many)),
                 pa.array(np.concatenate(none + [b.ids for _, _, b in flat])),
                 pa.array(np.concatenate(none + [b.score for _, _, b in flat]))],
                ["anchor_id", "positive_score", "negative_id", "negative_score"])
    return work


def _first(df: DataFrame, by: tuple[str, ...], score: str, vec_id: str, limit: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), vec_id)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= limit)


def hard_negatives(vectors: DataFrame, is_anchor, rule: Rule = Rule(), scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for ``vectors`` (vec_id, embedding, label); ``is_anchor`` is the Column that
    marks the query rows."""
    spark = vectors.sparkSession
    rows = stored(usable_rows(vectors, scale), "mining-rows")
    anchors = rows.where(is_anchor)
    dim = int(rows.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0)
    trees = stored(anchor_trees(anchors, max(dim, 1)), "mining-trees")
    size = F.length("vectors") + F.length("ids") * 4
    total = int(trees.agg(F.sum(size).alias("b")).first()["b"] or 0)
    n_waves = -(-total // WAVE_BYTES) or 1
    best = "anchor_id bigint, positive_id bigint, positive_score bigint"
    mined = "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    out = None
    for wave in range(n_waves):
        sent = spark.sparkContext.broadcast(trees.where(F.pmod(F.xxhash64("block"), F.lit(n_waves)) == wave).collect())
        near = rows.mapInArrow(_positives(sent, max(dim, 1), rule), best)
        positives = stored(_first(near, ("anchor_id",), "positive_score", "positive_id", rule.positives, "place"),
                           "mining-positives")
        scores_of: dict[int, list[int]] = {}  # at most ``positives`` rows an anchor of the wave
        for r in positives.select("anchor_id", "positive_score").distinct().collect():
            scores_of.setdefault(r[0], []).append(r[1])
        known = spark.sparkContext.broadcast({a: np.array(sorted(s), np.int64) for a, s in scores_of.items()})
        found = stored(rows.mapInArrow(_negatives(sent, known, max(dim, 1), rule), mined), "mining-found")
        sent.unpersist()
        known.unpersist()
        top = _first(found, ("anchor_id", "positive_score"), "negative_score", "negative_id", rule.negatives, "rank")
        part = positives.join(top, ["anchor_id", "positive_score"])
        out = part if out is None else out.unionAll(part)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                      "positive_score", "negative_score")
