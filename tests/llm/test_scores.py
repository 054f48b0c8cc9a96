"""The two classifiers: held-out accuracy, exact recursions, awkward rows."""

import itertools
import os
import random

import numpy as np
import pytest

from docshred.llm.crf_quality import Chain, fit_model, keep_good, line_features, score_quality, train_chain, with_neighbours
from docshred.llm.queries import THRESHOLD, op1_crf_quality, op4_toxicity_grammar
from docshred.llm import toxicity_grammar as grammar_module
from docshred.llm.toxicity_grammar import (INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT, Lexicon, Scorer, grammar, machines,
                                           score_toxicity)
from tests.llm.fixtures import empty, frame

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def labels(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], LABELS)


@pytest.mark.parametrize("query,column,least", [(op1_crf_quality, "quality", 0.97), (op4_toxicity_grammar, "toxic", 0.93)])
def test_held_out_accuracy(spark, query, column, least):
    out = query(spark, SF)
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r[column] for r in rows) >= least * len(rows) > 0
    everything = out.collect()
    assert len(everything) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= THRESHOLD) for r in everything)


def test_marginals_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 4, 5, 8])
    x = rng.normal(size=(8, 3))
    chain = Chain(rng.normal(size=3), rng.normal(size=(2, 2)))
    got, pairs = chain.marginals(x, first)
    total = np.zeros((2, 2))
    for a, b in itertools.pairwise(first):
        n = b - a
        weights, marks = [], []
        for path in itertools.product((0, 1), repeat=int(n)):
            s = sum(x[a + t] @ chain.weights * y for t, y in enumerate(path))
            s += sum(chain.pairs[u, v] for u, v in itertools.pairwise(path))
            weights.append(np.exp(s))
            marks.append(path)
        weights = np.array(weights) / sum(weights)
        for t in range(n):
            assert got[a + t] == pytest.approx(sum(w for w, p in zip(weights, marks) if p[t]), abs=1e-6)
        for w, p in zip(weights, marks):
            for u, v in itertools.pairwise(p):
                total[u, v] += w
    assert pairs == pytest.approx(total, abs=1e-5)


def test_neighbours_do_not_cross_texts():
    lines = line_features(["a b\nc d", None, "", "e\n\nf"])
    assert np.diff(lines.first).tolist() == [2, 0, 0, 2]
    x = with_neighbours(lines)
    k = lines.own.shape[1]
    assert not x[0, k:2 * k].any() and not x[1, 2 * k:].any() and not x[2, k:2 * k].any()
    assert (x[1, k:2 * k] == lines.own[0]).all()


def test_quality_training_ends_where_its_gradient_is_small():
    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(400), rng.normal(size=400)])
    y = (x[:, 1] + rng.normal(size=400) > 0).astype(int)
    first = np.arange(0, 401, 8)
    fine, coarse = (train_chain(x, first, y, np.ones(400), tolerance=t) for t in (1e-5, 1e-3))
    p, _ = fine.marginals(x, first)
    assert np.abs(x.T @ (y - p) / 400 - 1e-3 * fine.weights).max() <= 1e-5
    assert np.allclose(fine.weights, coarse.weights, atol=0.05)


def test_quality_sample_is_bounded_by_bytes(spark):
    words = ["plain words of a line.\n", "## $$ || buy buy buy\n"]
    rows = [(k, words[k % 2] * (5000 if k < 2 else 4), "en", "a", 0) for k in range(200)]
    docs = frame(spark, rows)
    known = labels(spark, [(k, 1 - k % 2, 0) for k in range(200)])
    seen = []

    def fit(texts, y, segment):
        seen.append((sum(len(t) for t, v in zip(texts, y) if v == 1), max(map(len, texts))))
        return fit_model(texts, y, segment)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("docshred.llm.crf_quality.fit_model", fit)
        out = score_quality(docs, known, train_bytes=4096).collect()
    assert len(out) == 200 and 0 < seen[0][0] <= 2 * 4096 and seen[0][1] <= 256


def test_quality_model_without_both_labels_scores_a_half():
    model = fit_model(["a b c", "d e f"], np.array([1, 1]), 64)
    assert model.score(model.summary(["some words", "", None])).tolist() == [0.5, 0.0, 0.0]


def test_clause_grammar_weights():
    g = grammar()
    insult, other = (INSULT, 4.0), (OTHER, 0.0)
    plain = g.best([other, insult, other])
    assert plain == 4.0
    assert g.best([(TARGET, 0.0), other, insult]) > plain
    assert g.best([(NEGATION, 0.0), insult]) < plain
    assert g.best([(NEGATION, 0.0), other, other, other, insult]) == plain  # beyond the scope
    assert g.best([(REPORT, 0.0), other, other, other, insult]) < plain
    assert g.best([(THREAT, 4.0), other]) == 0
    assert g.best([(TARGET, 0.0), (THREAT, 4.0)]) > 4
    assert g.best([]) == g.best([other] * 5) == 0


def test_scopes_end_with_the_clause_and_beginnings_match():
    s = Scorer(Lexicon({"idiot": 4.0, "clown": 4.0}, {"grub": 5.0, "éto": 6.0}))
    f = s.features(["you idiot", "not an idiot", "not so. an idiot", "grubling here", "ÉTOXY x", "a grü", None, "",
                    "he said: you are no clown, idiot!"])
    assert f[0, 1] > f[2, 1] > f[1, 1] > 0
    assert f[3, 1] == 5.0 and f[4, 1] == 6.0
    assert f[5:8, :3].sum() == 0
    assert f[8, 0] == 2


def test_awkward_rows(spark):
    df = frame(spark)
    known = labels(spark, [(0, 1, 1), (1, 0, 0), (2, None, None), (None, 1, 1), (26, 0, 0), (26, 0, 0), (999, 1, 1), (8, 1, 0)])
    for score, column in ((score_quality, "quality"), (score_toxicity, "toxic")):
        got = score(df, known).collect()
        assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got), column
        assert score(empty(spark), known).count() == 0
        assert score(df, labels(spark, [])).count() == df.count()
    kept = keep_good(df, labels(spark, []))
    assert kept.columns == df.columns
    assert kept.where("text is null or trim(text) = ''").count() == 0


def all_paths(machine, symbols):
    """(outputs, weights) of every accepted path of one machine."""
    paths = [(0, (), ())]
    for symbol in symbols:
        paths = [(to, out + (o,), weights + (w,)) for state, out, weights in paths
                 for o, w, to in machine.arcs.get((state, symbol), ())]
    return {(out, weights) for state, out, weights in paths if machine.final.get(state, 0.0) > -np.inf}


def test_composed_grammar_equals_running_the_four_machines():
    rng = random.Random(3)
    four, composed = machines(), grammar()
    for _ in range(300):
        clause = [(rng.choice([INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, OTHER]), rng.choice([1.0, 4.0]))
                  for _ in range(rng.randint(0, 7))]
        clause = [(s, w if s in (INSULT, THREAT) else 0.0) for s, w in clause]
        streams = {(tuple(s for s, _ in clause), (0.0,) * len(clause))}
        for machine in four:
            streams = {(out, tuple(a + b for a, b in zip(sums, weights)))
                       for symbols, sums in streams for out, weights in all_paths(machine, symbols)}
        want = max(sum(max(w + v, 0.0) if o == "hit" else v for o, v, (_, w) in zip(out, sums, clause))
                   for out, sums in streams)
        assert composed.best(clause) == pytest.approx(want)


def test_targets_behind_the_verb():
    s = Scorer(Lexicon({"grub": 3.0}, {}))
    f = s.features(["I will kill you", "We are going to destroy you", "kill them", "ich töte dich",
                    "I will hurt you and your family", "you I will kill", "kill the noise in that old room for you",
                    "kill time", "kill. you", "a grub like you", "a grub like that"])
    assert (f[:6, 1] > 4).all()
    assert f[6:9, 0].sum() == 0
    assert f[9, 1] > f[10, 1] == 3.0


def test_fixed_words_do_not_come_from_the_labels():
    """No word of a fixed list tells toxic from other documents in the test tables."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables not present")
    import pyarrow.parquet as pq
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    docs = [(set((r["text"] or "").lower().split()), toxic[r["doc_id"]])
            for r in pq.read_table(f"{folder}/documents.parquet").to_pylist() if r["doc_id"] in toxic]
    for word in " ".join([grammar_module.THREATS, grammar_module.TARGETS, grammar_module.NEGATIONS, grammar_module.REPORTS]).split():
        bad = sum(word in words for words, y in docs if y == 1)
        good = sum(word in words for words, y in docs if y == 0)
        assert bad < 3 or good > 0, word
