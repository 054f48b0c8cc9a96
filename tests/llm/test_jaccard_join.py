import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docshred.llm.components import components
from docshred.llm.jaccard_join import divide_skip, required, similarity_components
from tests.llm.fixtures import documents, empty, frame, prose
from tests.shuffles import noise, shuffled, texts_frame


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def slow(rows):
    """Smallest reachable id of every (id, text) by all pairs."""
    nodes = sorted({(r[0], r[1]) for r in rows}, key=repr)
    sets = [sets_of(t) for _, t in nodes]
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(nodes)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(nodes):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return {n: (len(sets[k]), least.get(find(k)) if sets[k] else n[0]) for k, n in enumerate(nodes)}


def check(spark, rows):
    want = slow(rows)
    got = similarity_components(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *want[r[0], r[1]]) for r in rows), key=repr)


def test_components_against_all_pairs(spark):
    check(spark, documents())


def test_chains_hot_groups_and_boundaries(spark):
    rng = random.Random(3)
    base = prose(rng, 12).split(" ")
    rows, words = [], list(base)
    for i in range(12):  # a chain: each is near the one before only
        rows.append((100 - i, " ".join(words), "", "", 1))
        words[(i * 7) % len(words)] = f"new{i}"
    shared = prose(rng, 6)
    for i in range(60):  # a passage in many texts that do not link
        rows.append((200 + i, shared + " " + prose(rng, 6), "", "", 1))
    for i in range(80):  # a large group of near copies with copies among them
        w = list(base) + prose(random.Random(9), 20).split(" ")
        w[rng.randrange(len(w))] = f"edit{i % 50}"
        rows.append((400 + i, " ".join(w), "", "", 1))
    nine = [f"w{k}" for k in range(13)]  # 9 shingles
    rows += [(600, " ".join(nine), "", "", 1), (601, " ".join([*nine, "x"]), "", "", 1),
             (602, " ".join([*nine, "x", "y", "z"]), "", "", 1), (603, "a b", "", "", 1), (604, "A B", "", "", 1)]
    check(spark, rows)


def test_empty_table(spark):
    assert similarity_components(empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1, max_size=30), st.lists(st.sets(st.integers(0, 40), min_size=1), max_size=8),
       st.sampled_from([50, 80, 100]))
def test_divide_skip_keeps_exactly_the_candidates_that_reach_t(query, candidates, percent):
    arrays = [np.array(sorted(c), dtype=np.int64) for c in candidates]
    sizes = np.array([len(c) for c in candidates], dtype=np.int64)
    got = divide_skip(np.array(sorted(query), dtype=np.int64), arrays, sizes, len(query), percent)
    assert got == [k for k, c in enumerate(candidates) if 100 * len(c & query) >= percent * len(c | query)]


@pytest.mark.parametrize("n,m", [(10, 10), (9, 10), (100, 80), (1, 1), (37, 41)])
def test_required_overlap(n, m):
    t = required(n, m, 80)
    assert 100 * t >= 80 * (n + m - t) and 100 * (t - 1) < 80 * (n + m - (t - 1))


def test_components_of_links(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "y"), ("y", "x"), ("q", "q"), ("z", "e")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {**dict.fromkeys("abcdez", "a"), "x": "x", "y": "x"}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_texts_without_a_partner_are_not_shuffled(spark):
    texts = noise(40, 3000)
    near = texts[0].rsplit(" ", 20)[0]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, near), (101, near), (None, None)]
    with shuffled(spark) as total:
        got = similarity_components(texts_frame(spark, rows)).collect()
    assert total[0] < 0.8 * sum(map(len, texts))
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == {k: k for k in range(40)} | {100: 0, 101: 0}
