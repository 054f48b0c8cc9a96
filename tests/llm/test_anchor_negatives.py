import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docshred.llm import anchor_negatives as mining
from docshred.llm.anchor_negatives import Rule, Tree, anchor_trees, descend, hard_negatives, spanning_tree, usable_rows

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed: int, n: int, dim: int, scale: float = 1.0) -> list[tuple]:
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append([i, [scale * float(np.float32(x + rng.gauss(0, 0.3))) for x in c], rng.randrange(3)])
    for i in range(0, n, 9):  # repeated vectors: ties
        rows[i][1] = list(rows[i // 2][1])
    return [tuple(r) for r in rows]


def brute(rows, rule=Rule(), every=5):
    kept: dict = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        kept[i] = min(kept.get(i, whole), whole)
    out = []
    for a, (label, c) in kept.items():
        if a % every:
            continue
        dot = sorted(((-sum(x * y for x, y in zip(c, v)), i, lab) for i, (lab, v) in kept.items() if i != a))
        for s, p, lab in [d for d in dot if d[2] == label][:rule.positives]:
            inside = [d for d in dot if d[2] != label
                      and rule.low * -s <= 100 * -d[0] <= rule.high * -s][:rule.negatives]
            out += [(a, p, k, n, -s, -t) for k, (t, n, _) in enumerate(inside, 1)]
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("x")).withColumn("block", F.lit(1))
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 5 == 0, **more).collect()))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mining, "SLICE_ROWS", 37)
    rows = vectors(1, 240, 8)
    want = brute(rows)
    assert len(want) > 100
    assert got(spark, rows) == want


def test_several_blocks_and_waves(spark, monkeypatch):
    monkeypatch.setattr(mining, "BLOCK", 4)
    monkeypatch.setattr(mining, "WAVE_BYTES", 500)
    rows = vectors(2, 120, 4)
    assert got(spark, rows, rule=Rule(2, 4, 20, 99)) == brute(rows, Rule(2, 4, 20, 99))


def test_awkward_rows(spark):
    rows = vectors(3, 60, 4) + [
        (100, None, 1), (105, [1.0, None, 0.0, 0.0], 1), (110, [float("nan")] * 4, 1), (115, [float("inf")] * 4, 0),
        (120, [1.0] * 4, None), (None, [1.0] * 4, 1), (125, [], 1), (130, [0.5], 2), (135, [0.0] * 4, 0),
        (10, [9.0] * 4, 2), (20, [0.25] * 4, 1), (20, [0.25] * 4, 1)]
    assert got(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = vectors(4, 40, 4, scale=1e6)
    assert max(abs(r[5]) for r in brute(rows)) > 2**53
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(5, [1.0, 2.0], 1)], [(1, [1.0], 1), (2, [1.0], 1)]])
def test_few_or_no_rows(spark, rows):
    assert got(spark, rows) == []


def test_tree_spans_all_anchors_with_least_edges():
    x = np.array([[0, 0], [10, 0], [1, 0], [9, 0], [5, 0]], dtype=float)
    order, parent, edge = spanning_tree(x)
    assert sorted(order.tolist()) == [0, 1, 2, 3, 4] and parent[0] == -1 and (parent[1:] < np.arange(1, 5)).all()
    assert round(edge.sum()) == 10


def test_bounds_hold_and_spare_work(spark):
    rows = usable_rows(spark.createDataFrame(vectors(5, 200, 6), SCHEMA))
    tree = Tree(anchor_trees(rows.where("vec_id % 5 = 0 and label = 1"), 6).first())
    x = np.array([r["v"] for r in rows.collect()], dtype=float)
    scored = []

    def wanted(k, low, high):
        true = x @ tree.vectors[k]
        assert (low <= true).all() and (true <= high).all()
        return np.flatnonzero(high >= np.partition(true, -3)[-3]), lambda at, found: scored.append(len(at))
    descend(tree, x, np.linalg.norm(x, axis=1) * (1 + 1e-9), wanted)
    assert sum(scored) < 0.8 * len(x) * len(tree.ids)
