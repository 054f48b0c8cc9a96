import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docshred.llm.ppm_language import PIECE, ContextTrees, identify, training_sample
from tests.llm.fixtures import empty, frame, prose


def slow_code_length(train: list[bytes], text: bytes, order: int) -> float:
    """PPM (method C, no exclusion) by plain dictionaries."""
    followers = [Counter() for _ in range(order + 1)]
    for t in train:
        padded = b"\n" * order + t
        for i in range(order, len(padded)):
            for k in range(order + 1):
                followers[k][padded[i - k:i], padded[i]] += 1
    tables = []
    for k in range(order + 1):
        contexts: dict[bytes, Counter] = {}
        for (c, s), n in followers[k].items():
            contexts.setdefault(c, Counter())[s] = n
        tables.append(contexts)
    bits, padded = 0.0, b"\n" * order + text
    for i in range(order, len(padded)):
        for k in range(order, -1, -1):
            seen = tables[k].get(padded[i - k:i])
            if not seen:
                continue
            total, distinct = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits -= math.log2(seen[padded[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


SAMPLES = {"xx": [b"banana bandana", b"a band", b""], "yy": [b"the cat sat", b"that hat"]}
TEXTS = [b"", b"banana", b"that band", "é?".encode(), b"zzzz the", b"a"]


@pytest.mark.parametrize("order", [1, 2, 4])
def test_code_lengths_equal_the_plain_recursion(order):
    model = ContextTrees(SAMPLES, order)
    got = model.code_lengths(TEXTS)
    for j, name in enumerate(model.languages):
        for k, t in enumerate(TEXTS):
            assert got[k, j] == pytest.approx(slow_code_length(SAMPLES[name], t, order), abs=1e-3)


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.97 * len(out) > 0


def test_awkward_rows(spark):
    got = identify(frame(spark))
    rows = got.collect()
    assert len(rows) == frame(spark).count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert identify(empty(spark)).count() == 0
    unlabelled = frame(spark, [(1, "some text", None, None, 1), (2, "1234", None, None, 1)])
    assert {r["lang_pred"] for r in identify(unlabelled).collect()} == {"und"}


def test_a_language_of_a_few_long_texts_gets_its_part(spark):
    rng = random.Random(4)
    long = prose(rng, 20_000)
    rows = [(i, long[i * 7:], "xx", "", 1) for i in range(3)]
    rows += [(100 + i, f"kurze zeile {i} " * 20, "yy", "", 1) for i in range(400)] + [(900, "a few words", "zz", "", 1)]
    bound = 150_000
    got = training_sample(frame(spark, rows), bound, F.lit(True), "doc_id", "text", "lang")
    size = {k: sum(map(len, v)) for k, v in got.items()}
    assert set(got) == {"xx", "yy", "zz"} and size["zz"] == len("a few words")
    assert bound / 6 < size["xx"] < bound / 2 and bound / 6 < size["yy"] < bound / 2
    assert max(map(len, got["xx"])) <= PIECE and all(p.decode() in long for p in got["xx"])
    whole = training_sample(frame(spark, rows), 1 << 30, F.lit(True), "doc_id", "text", "lang")
    assert sum(map(len, whole["xx"])) == sum(len(r[1]) for r in rows[:3])
    said = {r["doc_id"]: r["lang_pred"] for r in identify(frame(spark, rows), train_bytes=bound).collect()}
    assert [said[i] for i in range(3)] == ["xx"] * 3
