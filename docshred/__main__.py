"""Command line: shred JSON-lines documents into the twelve tables.

    python -m docshred INPUT --oasis OASIS.csv --mds MDS.csv --out OUT [--mode FAILFAST]
        [--format parquet] [--summary]

Run it with ``spark-submit`` on a cluster (the session comes from the
submitting environment); without one it starts a local session.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from docshred.plans.pipeline import build, summary, write_result


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="docshred")
    ap.add_argument("input", nargs="+", help="JSON-lines file(s) or folder(s)")
    ap.add_argument("--oasis", required=True, help="oasis column dictionary (CSV, header Colnames)")
    ap.add_argument("--mds", required=True, help="mds column dictionary (CSV, header Colnames)")
    ap.add_argument("--out", required=True, help="output root; one folder per table")
    ap.add_argument("--mode", default="PERMISSIVE", choices=["PERMISSIVE", "FAILFAST"])
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--summary", action="store_true", help="print rows before/after dedup per table")
    args = ap.parse_args(argv)

    active = SparkSession.getActiveSession()
    if active is None:
        from docshred.session import local_session
        active = local_session()
    res = build(active, args.input, {"oasis": args.oasis, "mds": args.mds}, mode=args.mode)
    paths = write_result(res, args.out, args.format)
    if args.summary:
        for r in summary(res, paths).collect():          # one row per table
            print(json.dumps(r.asDict()))
    print(json.dumps(paths))


if __name__ == "__main__":
    main()
