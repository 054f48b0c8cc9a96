"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docshred.session import scratch_path
from docshred.sources.runs import empty

SLICE_BYTES = 4 << 20
BROADCAST_KEYS = 10_000
# Bits of the filter that hashes set (16 MB on driver and executors).
FILTER_BITS = 27
# Part of a hash that is shuffled where equal parts of other hashes only cost time: the
# low bytes are zeros, which compress away.
HIGH_BITS = np.uint64(0xFFFFFFFFFF000000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], text: int = 1, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text column of each piece holds at most
    ``max_bytes`` (one longer text stands alone): bounds a task's memory
    whatever Spark puts into a batch."""
    for batch in batches:
        size, start = 0, 0
        lengths = pc.binary_length(batch.column(text)).to_pylist()
        for i, n in enumerate(lengths):
            n = n or 0
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id is in no fold (-1)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))


def bounded_sample(df: DataFrame, size: Column, bound: int, key: Column, by: Column | None = None) -> DataFrame:
    """Rows whose summed ``size`` is about ``bound`` at most (per value of
    ``by`` when given: ``bound`` for each).

    The kept share follows from one aggregate over all rows; rows are chosen by
    the hash of ``key``, so the choice is the same on every run and partitioning."""
    seed = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    if by is None:
        total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
        return df if total <= bound else df.where(seed < F.lit(bound / total))
    totals = df.groupBy(by.alias("_by")).agg((F.lit(float(bound)) / F.greatest(F.sum(size), F.lit(1))).alias("_share"))
    if totals.count() <= BROADCAST_KEYS:  # else Spark shuffles by key and splits hot ones
        totals = F.broadcast(totals)
    return df.join(totals, by == F.col("_by")).where(seed < F.col("_share")).drop("_by", "_share")


def bit_filter(hashes: DataFrame):
    """Broadcast bits, one set by the high bits of every hash ``h``; at most 2^21 words come to the driver."""
    at = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    words = hashes.select(F.shiftrightunsigned(at, 6).alias("word"), F.expr(
        f"shiftleft(1L, int(shiftrightunsigned(h, {64 - FILTER_BITS}) & 63))").alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def bit_set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = h >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def passing(bits, column: int, keep: bool = True):
    """Rows whose hash in that column has its bit set in the broadcast ``bits``, or those
    without.  A join by the hashes has no partner for the latter, so a long text among
    them need not be shuffled to find that out."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(bit_set(bits.value, h) == keep))
    return work


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Take the files of ``stored`` frames away.  Only for frames whose every
    reader has been written: a lost executor's tasks read them no more."""
    for df in frames:
        empty(df.sparkSession, df.stored_at)
