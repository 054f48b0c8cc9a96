"""Connected components of a link table by alternating minimum steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (columns ``a``, ``b``).

    Large-star and small-star steps: each node links its larger neighbours, then
    its smaller ones, to the smallest neighbour, until nothing changes; every
    step is two aggregates whose minima combine map-side, and rows never grow
    beyond the links.  The number of steps is logarithmic in the longest chain."""
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        large = _star(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        small = _star(large.select(high, low), larger=False)
        new = stored(small.select(high, low).distinct(), "links")
        state = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")]
        before = edges.select(high, low).distinct().agg(*state).first()
        discard(edges)
        if new.agg(*state).first() == before:
            break
        edges = new
    return new.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of ``a`` to the smallest of ``a`` and its neighbours:
    those above ``a`` (large star), or all of them and ``a`` (small star)."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    moved = joined.where(F.col("b") > F.col("a")) if larger else joined
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not larger:
        out = out.unionAll(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()
