import hashlib
import random

import numpy as np
import pytest

from docshred.llm import prefix_free_dedup as pfp
from docshred.llm.prefix_free_dedup import Parsing, parse, remove_substrings
from tests.llm.fixtures import documents, empty, frame


def brute(rows, width: int = 50):
    """doc_id, n_bytes, n_removed, n_spans, hash of the rest: by a dictionary of all strings."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, t in raw:
        if i is not None:
            for k in range(len(t) - width + 1):
                s = t[k:k + width]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in raw:
        gone = bytearray(len(t) + 1)
        for k in range(len(t) - width + 1):
            if i is not None and first[t[k:k + width]] < i:
                gone[k:k + width] = b"\1" * width
        spans = sum(gone[k] and not gone[k + 1] for k in range(len(t)))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, parts: int = 5, extra: bool = True, **more):
    df = frame(spark, [(i, t, "en", "s", 1) for i, t in rows], extra).repartition(parts)
    out = remove_substrings(df, **more)
    cut = [r for r in out.collect()]
    for r in cut:
        assert r["n_removed"] == sum(e - s for s, e in r["removed"]) and r["n_spans"] == len(r["removed"])
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept"]) for r in cut), key=repr)


def patched(seed: int, letters: str, n: int = 80) -> list[tuple]:
    """Texts made of shared and own stretches of every length around 50."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(30, 200))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rng.randint(0, 6)):
            s = rng.choice(pool)
            a = rng.randrange(len(s))
            t += s[a:a + rng.randint(20, 160)] + "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        rows.append((rng.randrange(n), t))  # ids repeat
    return rows


@pytest.mark.parametrize("letters", ["ab", "abcdefghij \n", "aé日\U0001F600 \x00"])
def test_equals_brute_force(spark, letters):
    rows = patched(len(letters), letters)
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert got(spark, rows) == want


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in documents()] + [(50, "x" * 49), (51, "x" * 50), (52, "x" * 5000), (53, "x" * 51),
                                                 (54, "ab" * 3000), (60, "ab" * 30)]
    rows.append((61, rows[27][1][5:70_000] + "!" + rows[27][1][100:]))
    assert got(spark, rows) == brute(rows)


def test_triggers_with_many_phrases_go_string_by_string(spark):
    rng = random.Random(9)
    core = "the very common words that stand in every text"     # 46 bytes: no string is repeated by it alone
    rows = [(i, f"{rng.randrange(30):03d}{core}{rng.randrange(30):03d}" + "".join(rng.choice("abc") for _ in range(60)))
            for i in range(300)]
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert got(spark, rows, group=3) == want
    assert got(spark, rows) == want


def test_other_widths(spark):
    rows = patched(4, "abcd ", 30)
    assert got(spark, rows, rule=Parsing(width=24, trigger=8, join=2)) == brute(rows, 24)
    with pytest.raises(ValueError):
        Parsing(width=100, trigger=8)


def test_parts_split_a_partition(spark, monkeypatch):
    monkeypatch.setattr(pfp, "PART_BYTES", 3000)
    rows = patched(6, "abcd ", 40)
    assert got(spark, rows, parts=2) == brute(rows)


def test_empty_table(spark):
    assert remove_substrings(empty(spark)).count() == 0


def test_every_string_lies_in_one_phrase(monkeypatch):
    monkeypatch.setattr(pfp, "BLOCK", 256)
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 900))) for _ in range(20)]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    p = parse(np.frombuffer(b"".join(texts), np.uint8), offsets, Parsing())
    at = np.concatenate([np.arange(s, s + n) for s, n in zip(p.start, p.n)])
    want = np.concatenate([np.arange(o, o + max(len(t) - 49, 0)) for o, t in zip(offsets, texts)])
    assert (at == want).all() and (p.before >= p.n - 1).all() and (p.before <= 30).all()
