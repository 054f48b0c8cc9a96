"""Small tables that hold the awkward cases: nulls, empty and long texts, ties,
repeated rows, null ids and extra columns whose names the operators use inside."""

import random

SYLLABLES = ["ba", "ko", "ti", "ren", "mus", "lo", "shi", "ter", "an", "vel", "dor", "quin"]
EXTRA = {"key": "x", "token": "y", "_id": "z", "kind": "k", "cls": "c", "h": "h"}


def sentence(rng: random.Random, words: int) -> str:
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(out).capitalize() + "."


def prose(rng: random.Random, sentences: int) -> str:
    return " ".join(sentence(rng, rng.randint(4, 12)) for _ in range(sentences))


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)"""
    rng = random.Random(seed)
    passage = prose(rng, 8)
    base = prose(rng, 30)
    rows = []
    for i in range(40):
        rows.append([i, prose(rng, rng.randint(1, 20)), "en", "a"])
    rows[3][1] = None
    rows[4][1] = ""
    rows[5][1] = " \t\n\r "
    rows[6][1] = "one two three"
    rows[7][1] = "ONE two three"
    for i in (10, 11, 12):  # copies and near copies
        rows[i][1] = base
    words = base.split(" ")
    for i in (13, 14, 15, 16):
        w = list(words)
        for _ in range(i - 12):
            w[rng.randrange(len(w))] = "zzz"
        rows[i][1] = " ".join(w)
    for i in (20, 21, 22):  # a passage inside other text
        rows[i][1] = prose(rng, 5)[:-1] + " " + passage + " " + prose(rng, 5)
    rows[25][1] = "\n".join(["Same line here."] * 6)
    rows[26][1] = "word " * 400
    rows[27][1] = prose(rng, 3000)  # long
    rows[28][1] = "é ñ ß 日本語 \U0001F600 tail   x"
    rows[29][2] = None
    rows.append([None, prose(rng, 4), "en", "a"])
    rows.append([None, None, None, None])
    rows.append(list(rows[0]))  # repeated row
    rows.append([0, prose(rng, 6), "de", "b"])  # same id, other text
    return [(a, b, c, d, None if b is None else len(b)) for a, b, c, d in rows]


def frame(spark, rows=None, extra: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(documents() if rows is None else rows,
                               "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        for name, value in EXTRA.items():
            df = df.withColumn(name, F.lit(value))
    return df


def empty(spark):
    return frame(spark, [])
