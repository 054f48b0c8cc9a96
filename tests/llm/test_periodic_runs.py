import hashlib
import random
import zlib

import numpy as np
import pytest

from docshred.llm.periodic_runs import find, find_runs, plant, run_digest
from docshred.llm.words import split_words
from tests.llm.fixtures import documents, empty, frame


def slow_runs(words: list[str], min_length: int = 6, min_repeats: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period): every maximal period-q stretch, checked place by place."""
    n, out = len(words), []
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([codes[w] for w in words], dtype=np.int64)
    for q in range(1, n // min_repeats + 1):
        equal = np.concatenate(([0], x[:-q] == x[q:], [0]))
        for s, e in zip(np.flatnonzero(np.diff(equal) == 1).tolist(), (np.flatnonzero(np.diff(equal) == -1) + q).tolist()):
            if e - s >= max(min_length, min_repeats * q):
                if not any((x[s:e - p] == x[s + p:e]).all() for p in range(1, q)):
                    out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_words(text: str | None) -> list[str]:
    return [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace(
        "\x0c", " ").replace("\r", " ").split(" ") if w]


def slow_plant(doc_id, words: list[str]) -> list[str]:
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def slow_row(doc_id, text):
    words = slow_plant(doc_id, slow_words(text))
    runs = slow_runs(words)
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def periodic(rng: random.Random, letters: str) -> str:
    words: list[str] = []
    for _ in range(rng.randint(1, 5)):
        root = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
        words += (root * 12)[:rng.randint(1, 6 * len(root))]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 4))]
    return " ".join(words)


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_runs_equal_the_place_by_place_search(letters):
    rng = random.Random(len(letters))
    texts = [periodic(rng, letters) for _ in range(250)] + ["", None, "a"]
    texts += texts[:20]  # copies share nonterminals
    batch = split_words(texts, lower=False)
    got: list[list[tuple]] = [[] for _ in texts]
    for t, s, e, q in find(batch, 6, 4).T.tolist():
        got[t].append((s - int(batch.first[t]), e - s, q))
    assert got == [slow_runs(slow_words(t)) for t in texts]


def test_long_repetitive_texts():
    texts = ["a " * 30_000, "a b " * 20_000 + "c", ("x " + "a b c " * 5) * 300]
    found = find(split_words(texts, lower=False), 6, 4)
    assert [found[:, found[0] == 0].T.tolist(), found[:, found[0] == 1].T.tolist()] == [
        [[0, 0, 30_000, 1]], [[1, 30_000, 70_000, 2]]]
    third = found[:, found[0] == 2]
    assert (third[3] == 16).sum() == 1 and (third[3] == 3).sum() == 300 and third.shape[1] == 301


def test_query_columns_equal_brute_force(spark):
    rng = random.Random(5)
    rows = documents() + [(100 + i, periodic(rng, "abcd"), "en", "s", 1) for i in range(60)]
    got = run_digest(find_runs(plant(frame(spark, rows)))).collect()
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted((slow_row(r[0], r[1]) for r in rows), key=key)
    assert sum(r["n_runs"] for r in got) > 20


def test_empty_table_and_limits(spark):
    assert find_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        find_runs(empty(spark), min_repeats=3)
