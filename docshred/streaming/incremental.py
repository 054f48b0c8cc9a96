"""Incremental shredding of document files as they land (Structured Streaming).

A file stream of JSON lines feeds ``foreachBatch``.  Every micro-batch is
staged once (Parquet, parse once), shredded into all twelve tables, checked,
deduplicated within the batch, and appended to ``<out>/<table>`` under a
``_batch`` partition.  Each batch writes its own partition with dynamic
partition overwrite, so a batch replayed after a failure replaces its output
instead of duplicating it (the stream checkpoint lives in the shared folder).

Whole-row dedup *across* batches as streaming state would grow without bound (there
is no event time to expire it by).  With ``across_batches`` the rows seen are kept as a
table of keys instead, two 64-bit hashes of (table, row) and 16 bytes a row: a batch
appends only rows whose key no earlier batch has, and then its keys.  Only the batch's
keys move; the table of seen keys is scanned in place, or joined by key when the batch
is large.  ``compact`` removes duplicates over accumulated tables as a batch job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docshred.operators.combine import drop_complete_duplicates
from docshred.operators.quality import quality_report
from docshred.operators.row_stream import ROW, TABLE, tagged_rows, typed_rows
from docshred.operators.shredder import keys_only, shred, with_stored_helpers
from docshred.plans.clinical import clinical_specs
from docshred.plans.pipeline import resolve_dictionaries
from docshred.session import shared_dir
from docshred.sources.documents import CORRUPT, document_schema, malformed, typed_documents, well_formed
from docshred.sources.runs import empty

BATCH = "_batch"


def stream_documents(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of JSON-lines files; malformed lines kept in ``_corrupt_record``."""
    r = (spark.readStream.schema(document_schema(corrupt=True)).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_documents(r.json(input_dir))


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))


SEEN, NEW = "_seen", "_new"
BROADCAST_KEYS = 200_000        # keys of a batch (3 MB) that go to every task
_KEYS = ("_k1", "_k2")


def _keyed(rows: DataFrame) -> DataFrame:
    """The stream's distinct rows with their keys."""
    return rows.distinct().select("*", F.xxhash64(TABLE, ROW).alias(_KEYS[0]),
                                  F.xxhash64(F.lit("again"), ROW, TABLE).alias(_KEYS[1]))


def new_rows(rows: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Distinct rows of a stream whose key is not among ``seen``.

    ``rows`` is read more than once: give stored data."""
    keyed = _keyed(rows)
    if seen is None:
        return keyed
    keys = keyed.select(*_KEYS)
    # seen keys that come again: at most as many as the batch has
    if rows.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    again = seen.select(*_KEYS).join(keys, list(_KEYS), "left_semi")
    return keyed.join(again, list(_KEYS), "left_anti")


def _seen_before(spark: SparkSession, out_root: str, batch_id: int) -> DataFrame | None:
    """Keys that earlier batches added; a batch that is run again never meets its own."""
    try:
        seen = spark.read.schema(f"_k1 long, _k2 long, {BATCH} long").parquet(f"{out_root}/{SEEN}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return seen.where(F.col(BATCH) < batch_id)


def _write_new(docs: DataFrame, ok: DataFrame, specs, dicts, out_root: str, batch_id: int) -> None:
    """Append what no earlier batch had, then the keys.  The new rows are stored first:
    tables and keys come from the same rows, and a lost executor finds them again."""
    spark = docs.sparkSession
    staged = f"{out_root}/{NEW}/{BATCH}={batch_id}"
    rows = f"{staged}/rows"
    tagged_rows(ok, specs, dicts).distinct().write.mode("overwrite").parquet(rows)
    fresh = f"{staged}/fresh"
    new_rows(spark.read.parquet(rows), _seen_before(spark, out_root, batch_id)).write.mode("overwrite").parquet(fresh)
    new = spark.read.parquet(fresh)
    for s in specs:
        _write(typed_rows(new, ok, s, dicts), f"{out_root}/{s.name}", batch_id)
    _write(new.select(*_KEYS), f"{out_root}/{SEEN}", batch_id)
    for path in (rows, fresh):
        empty(spark, path)


def shred_batch(batch: DataFrame, batch_id: int, out_root: str, dicts: Mapping[str, list[str]],
                across_batches: bool = False, keep_staged: bool = True) -> None:
    """Shred one micro-batch.  ``keep_staged=False`` empties the staged documents once
    the tables are written: they hold personal data in full."""
    spark = batch.sparkSession
    stage = f"{out_root}/_staged/{BATCH}={batch_id}"
    specs = clinical_specs()
    with_stored_helpers(batch, specs).write.mode("overwrite").parquet(stage)          # parse once; cuts lineage
    docs = spark.read.parquet(stage)
    ok = well_formed(docs)
    _write(quality_report(docs, None, specs), f"{out_root}/_quality", batch_id)
    _write(malformed(docs), f"{out_root}/_rejected", batch_id)
    if across_batches:
        _write_new(docs, ok, specs, dicts, out_root, batch_id)
    else:
        for s in specs:
            _write(drop_complete_duplicates(shred(ok, s, dicts, widen=False)), f"{out_root}/{s.name}", batch_id)
    if not keep_staged:
        empty(spark, stage)


def start(spark: SparkSession, input_dir: str, out_root: str, dictionaries: Mapping[str, object],
          checkpoint: str | None = None, available_now: bool = False,
          processing_time: str | None = None, max_files_per_trigger: int | None = None,
          across_batches: bool = False, keep_staged: bool = True) -> StreamingQuery:
    """Start the shredding stream; returns the running query.  With ``across_batches``
    a row that any earlier batch wrote is not written again."""
    dicts = resolve_dictionaries(spark, dictionaries)
    # a stable name per output root (Python's str hash changes per process, and
    # a new checkpoint folder after a restart would re-read every input file)
    key = hashlib.sha1(out_root.rstrip("/").encode()).hexdigest()[:16]
    checkpoint = checkpoint or f"{shared_dir(spark)}/docshred-stream/{key}"
    w = (stream_documents(spark, input_dir, max_files_per_trigger).writeStream
         .foreachBatch(lambda df, bid: shred_batch(df, bid, out_root, dicts, across_batches, keep_staged))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def compact(spark: SparkSession, out_root: str, names: list[str] | None = None,
            dictionaries: Mapping[str, object] | None = None) -> dict[str, DataFrame]:
    """Accumulated tables with duplicates removed across all batches.

    A table that no batch had rows for has no data file; it comes back empty
    with its own columns (a wide one with its fixed columns, and the items too
    when ``dictionaries`` are given)."""
    specs = {s.name: s for s in clinical_specs()}
    dicts = resolve_dictionaries(spark, dictionaries or {})
    out = {}
    for n in names or list(specs):
        try:
            rows = spark.read.parquet(f"{out_root}/{n}").drop(BATCH)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            none = typed_documents(spark.createDataFrame([], document_schema()))
            spec = specs[n]
            rows = shred(none, spec, dicts) if spec.wide is None or spec.wide.dictionary in dicts else keys_only(none, spec)
        out[n] = drop_complete_duplicates(rows)
    return out
