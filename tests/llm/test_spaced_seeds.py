import random
import time
import tracemalloc

import numpy as np

from docshred.llm import spaced_seeds
from docshred.llm.spaced_seeds import MASKS, Rule, SeedIndex, decontaminate, find_overlaps, seed_hashes, stretches
from docshred.llm.words import split_words
from tests.llm.fixtures import EXTRA, empty, frame, prose

ITEMS = "item_id bigint, text string, doc_id string"


def bench(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], ITEMS)


def slow(docs, items, rule=Rule(), penalty=2.0):
    """(doc, item) pairs with a seed hit and an accepted stretch, by plain loops."""
    def words(t):
        b = split_words([t], punctuation=False)
        return [bytes(b.data[s:e]) for s, e in zip(b.start, b.end)]

    out = set()
    for d, t in docs:
        a = words(t)
        for i, u in items:
            b = words(u)
            for diagonal in range(-len(b), len(a)):
                pairs = [(a[j + diagonal] == b[j]) if 0 <= j + diagonal < len(a) else None for j in range(len(b))]
                runs = [p for p in pairs if p is not None]
                hit = any(all(runs[s + k] for k, m in enumerate(mask) if m == "1")
                          for mask in MASKS for s in range(len(runs) - len(mask) + 1))
                if not hit:
                    continue
                best, span = 0.0, None
                for s in range(len(runs)):
                    score = 0.0
                    for e in range(s, len(runs)):
                        score += 1.0 if runs[e] else -penalty
                        if score > best:
                            best, span = score, (s, e + 1)
                if span and span[1] - span[0] >= rule.min_words and sum(runs[span[0]:span[1]]) >= rule.min_match * (
                        span[1] - span[0]):
                    out.add((d, i))
    return out


def test_hits_are_those_of_the_plain_search(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, 2) + " " + prose(rng, 2)) for i in range(12)]
    docs = []
    for d in range(30):
        text = prose(rng, 6)
        if d % 3 == 0:
            w = items[d % 12][1].split(" ")
            for _ in range(d // 6):
                w[rng.randrange(len(w))] = "changed"
            text = text + " " + " ".join(w).upper().replace(".", " !") + " " + prose(rng, 3)
        docs.append((d, text))
    got = find_overlaps(frame(spark, [(d, t, "", "", 1) for d, t in docs]), bench(spark, items))
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert found == slow(docs, items)
    assert len(found) >= 7
    blocks = find_overlaps(frame(spark, [(d, t, "", "", 1) for d, t in docs]), bench(spark, items), block_chars=200)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == found


def test_decontamination_keeps_clean_rows_and_all_columns(spark):
    rng = random.Random(6)
    item = prose(rng, 5)
    df = frame(spark, [(1, "x " + item + " y", "", "", 1), (2, prose(rng, 9), "", "", 1), (3, None, "", "", 1),
                       (None, "", "", "", 1)])
    got = decontaminate(df, bench(spark, [(1, item), (2, None), (None, "")]))
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 2, 3]
    assert got.columns == df.columns and set(EXTRA) <= set(got.columns)


def test_awkward_rows(spark):
    df = frame(spark)
    text = df.where("doc_id = 10").first()["text"]
    got = find_overlaps(df, bench(spark, [(7, text), (None, text), (8, "")]))
    assert {(r["doc_id"], r["item_id"]) for r in got.where("n_equal = n_words").collect()} >= {
        (d, i) for d in (10, 11, 12) for i in (7, None)}
    assert find_overlaps(empty(spark), bench(spark, [(1, text)])).count() == 0
    assert find_overlaps(df, bench(spark, [])).count() == 0
    assert decontaminate(df, bench(spark, [])).count() == df.count()


def test_stretches_are_those_of_all_stretches():
    rng = random.Random(8)
    rule = Rule()

    def longest(equal, lo, hi):
        every = [(e - s, -s) for s in range(lo, hi) for e in range(s + rule.min_words, hi + 1)
                 if equal[s] and equal[e - 1] and 10 * sum(equal[s:e]) >= 8 * (e - s)]
        if not every:
            return []
        n, s = max(every)
        return longest(equal, lo, -s) + [(-s, -s + n)] + longest(equal, -s + n, hi)

    some = 0
    for k in range(400):
        equal = [rng.random() < rng.choice((0.5, 0.75, 0.85)) for _ in range(rng.randint(0, 70))]
        if k % 4 == 0:
            equal[20:40] = [False] * len(equal[20:40])
        got = stretches(np.array(equal, dtype=bool), rule)
        assert got == longest(equal, 0, len(equal))
        some += len(got) > 1
    assert some > 5


def test_overlap_beyond_a_substitution_and_a_second_one_are_found(spark):
    item = [f"w{k}" for k in range(60)]
    first = item[:11] + ["other"] + item[12:13]  # 13 words, 12 equal
    both = item[:15] + ["other"] * 25 + item[40:55]
    docs = [(1, " ".join(first), "", "", 1), (2, " ".join(both), "", "", 1), (3, " ".join(item[:11]), "", "", 1)]
    got = find_overlaps(frame(spark, docs), bench(spark, [(7, " ".join(item))])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 7, 0, 0, 13, 12), (2, 7, 0, 0, 15, 15), (2, 7, 40, 40, 15, 15)]
    left = decontaminate(frame(spark, docs), bench(spark, [(7, " ".join(item))])).collect()
    assert [r["doc_id"] for r in left] == [3]


def every_overlap(texts, items, rule=Rule()):
    """All accepted stretches of all diagonals that share a seed, by plain loops."""
    out = set()
    for d, text in enumerate(texts):
        a = split_words([text], punctuation=False)
        for i, item in items:
            b = split_words([item], punctuation=False)
            diagonals = set()
            for mask in MASKS:
                places = {}
                for h, at in zip(*map(list, seed_hashes(b, mask))):
                    places.setdefault(h, []).append(int(at))
                for h, at in zip(*map(list, seed_hashes(a, mask))):
                    diagonals |= {int(at) - p for p in places.get(h, ())}
            for g in diagonals:
                lo, hi = max(0, -g), min(len(b.hash), len(a.hash) - g)
                equal = a.hash[lo + g:hi + g] == b.hash[lo:hi]
                out |= {(d, i, lo + s + g, lo + s, e - s, int(equal[s:e].sum())) for s, e in stretches(equal, rule)}
    return out


def test_repetitive_texts_give_the_rows_of_the_plain_search(monkeypatch):
    rng = random.Random(12)
    texts = ["go " * 90, "a b " * 60, None, "", " ".join(rng.choice("xy") for _ in range(150)),
             " ".join(rng.choice("xy") * 3 for _ in range(30)) + " go" * 30, "a b c " * 7, prose(rng, 6)]
    items = [(1, "go " * 40), (2, "a b " * 12), (3, " ".join(rng.choice("xy") for _ in range(60))), (4, "a b c " * 30),
             (5, texts[7] + " x y" * 20)]
    want = every_overlap(texts, items)
    assert len(want) > 250
    for dense, pairs in ((64, 1 << 20), (0, 100), (2, 100), (10**9, 50)):
        monkeypatch.setattr(spaced_seeds, "DENSE", dense)
        monkeypatch.setattr(spaced_seeds, "PAIRS", pairs)
        got = [(d, i, *f) for d, i, f in SeedIndex(items, Rule()).overlaps(texts)]
        assert len(got) == len(want) and set(got) == want


def test_one_word_repeated_is_linear():
    index = SeedIndex([(1, "go " * 400)], Rule())
    text = "go " * 100_000
    tracemalloc.start()
    began = time.monotonic()
    rows = sum(1 for _ in index.overlaps([text]))
    assert rows == 100_000 + 400 - 1 - 2 * 11
    assert time.monotonic() - began < 30  # about a second; listing all pairs takes minutes
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
