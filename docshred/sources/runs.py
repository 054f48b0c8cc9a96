"""Written data published by a pointer, for stores without an atomic rename.

A writer puts its data into a folder of its own below ``<root>/runs`` and then one
small record, in a folder of its own too, below ``<root>/published``.  A record is a
file written by one task, so it is there whole or not at all; data without a record
are never read.  Writers share no folder that they write to: of several records the first counts (by time, then path), so
all readers that come later agree.  ``expire`` empties the runs that do not count.
Only DataFrame reads and writes are used, so any store that Spark reaches will do.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

RECORD = "path string, written double"


def records(spark: SparkSession, root: str) -> list[tuple[float, str]]:
    """(time, path) of all published runs, the one that counts first."""
    try:
        # a record is a line; there is one per writer, not per row
        found = spark.read.schema(RECORD).option("recursiveFileLookup", True).json(f"{root}/published").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r["written"], r["path"]) for r in found if r["path"] is not None)


def current(spark: SparkSession, root: str) -> str | None:
    """Path of the run that counts, None before the first is published."""
    found = records(spark, root)
    return found[0][1] if found else None


def publish(spark: SparkSession, root: str, write: Callable[[str], object]) -> str:
    """Write a run with ``write(path)``, publish it and return the path that counts
    now, which is another writer's when that one was first."""
    run = uuid.uuid4().hex
    path = f"{root}/runs/{run}"
    write(path)
    spark.createDataFrame([(path, time.time())], RECORD).coalesce(1).write.json(f"{root}/published/{run}")
    return current(spark, root) or path


_KNOWN: dict[tuple[str, str], str] = {}


def publish_once(spark: SparkSession, root: str, write: Callable[[str], object]) -> str:
    """The run that counts, written by ``write`` if there is none; looked up once per application."""
    known = (spark.sparkContext.applicationId, root)
    if known not in _KNOWN:
        _KNOWN[known] = current(spark, root) or publish(spark, root, write)
    return _KNOWN[known]


def empty(spark: SparkSession, path: str) -> None:
    """Take all rows from a written folder (an empty frame overwrites it)."""
    nothing: DataFrame = spark.createDataFrame([], "value string")
    nothing.write.mode("overwrite").text(path)


def expire(spark: SparkSession, root: str, older_than: float = 0.0) -> list[str]:
    """Empty the published runs that do not count and are older than so many seconds
    (readers that found an earlier state may still be at work); returns their paths.
    The records stay: a run emptied once is never chosen."""
    now = time.time()
    old = [path for written, path in records(spark, root)[1:] if now - written >= older_than]
    for path in old:
        empty(spark, path)
    return old
