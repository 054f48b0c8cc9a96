"""Bytes that a local session's queries shuffle."""

import os
import random
from contextlib import contextmanager


def _stored(spark) -> dict[str, int]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f"{d}/{f}": os.path.getsize(f"{d}/{f}") for folder in folders for d, _, names in os.walk(folder)
            for f in names if f.startswith("shuffle_") and f.endswith(".data")}


@contextmanager
def shuffled(spark):
    """A list that ends up with the bytes shuffled meanwhile; no join side is broadcast."""
    key, total = "spark.sql.autoBroadcastJoinThreshold", []
    was, before = spark.conf.get(key), _stored(spark)
    spark.conf.set(key, "-1")
    try:
        yield total
        total.append(sum(n for f, n in _stored(spark).items() if f not in before))
    finally:
        spark.conf.set(key, was)


def noise(n_texts: int, n_words: int, seed: int = 3) -> list[str]:
    """Texts without a repeated word, 11 bytes a word."""
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(n_words)) for _ in range(n_texts)]


def texts_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")
