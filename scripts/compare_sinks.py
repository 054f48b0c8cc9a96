"""Times writing the twelve tables from one stage: a scan per table, and one tagged
stream read back per table.

    python scripts/compare_sinks.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docshred.operators.row_stream import read_row_stream, write_row_stream  # noqa: E402
from docshred.plans import nest, queries  # noqa: E402
from docshred.plans.pipeline import assemble  # noqa: E402
from docshred.session import local_session, scratch_path  # noqa: E402
from docshred.sources.sinks import write_table, write_tables  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session("8", shuffle_partitions=16)
    docs = spark.read.parquet(nest.staged(spark, sf_dir))
    dicts, items = queries._dicts(spark, sf_dir), queries.staged_items(spark, sf_dir)
    for again in range(2):
        res = assemble(docs, dicts, items=items)
        t = time.time()
        write_tables(res.tables, scratch_path(spark, "sinks-each"))
        print(f"run {again}: a scan per table, typed tables: {time.time() - t:.1f} s", flush=True)
        t = time.time()
        root = write_row_stream(res.rows, scratch_path(spark, "sinks-stream"))
        print(f"run {again}: one stream, partitioned by table: {time.time() - t:.1f} s", flush=True)
        typed = scratch_path(spark, "sinks-typed")
        for s in res.specs:
            write_table(read_row_stream(docs, root, s, dicts, items), f"{typed}/{s.name}")
        print(f"run {again}: and typed tables from it: {time.time() - t:.1f} s in all", flush=True)


if __name__ == "__main__":
    main()
