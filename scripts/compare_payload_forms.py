"""Time the wide projection of mds payloads stored as JSON text against a stored variant.

    python scripts/compare_payload_forms.py [sf_dir]

Both forms are written once beside each other; then every dictionary item is
projected from each (``from_json`` to a struct, ``variant_get`` per item, as dense
payloads of hundreds of keys and as they come), and the rows are compared.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from docshred.plans import nest  # noqa: E402
from docshred.session import local_session, scratch_path  # noqa: E402
from docshred.sources.dictionary import dictionary_schema  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    names = nest.dictionary_items("mds")
    elements = spark.read.parquet(nest.staged(spark, sf_dir)).select(F.explode("assessments").alias("e"))
    payloads = elements.where("e.type = 'mds'").select(F.coalesce("e.assessmentData", F.lit("{}")).alias("payload"))
    root = scratch_path(spark, "docshred-forms")
    for form, col in {"text": F.col("payload"), "variant": F.parse_json("payload").alias("payload")}.items():
        start = time.time()
        payloads.select(col, (F.length("payload") > 2000).alias("dense")).write.parquet(f"{root}/{form}")
        print(f"write {form}: {time.time() - start:.1f} s")
    struct = dictionary_schema(names)
    for dense in (True, False):
        frames = {}
        for form in ("text", "variant"):
            df = spark.read.parquet(f"{root}/{form}").where("dense" if dense else "true")
            if form == "text":
                df = df.select(F.from_json("payload", struct).alias("x")).selectExpr(*[f"x.`{n}`" for n in names])
            else:
                df = df.selectExpr(*[f"variant_get(payload, '$.{n}', 'string') AS `{n}`" for n in names])
            frames[form] = df
            for run in (1, 2):
                start = time.time()
                df.write.format("noop").mode("overwrite").save()
                print(f"{'dense' if dense else 'all'} payloads, {form}, run {run}: {time.time() - start:.1f} s", flush=True)
        digests = [f.select(F.sum(F.xxhash64(*names).cast("decimal(20)")).alias("h"), F.count("*").alias("n")).first()
                   for f in frames.values()]
        print("same values:", digests[0] == digests[1], digests[0]["n"], "rows")
        if dense:
            keys = payloads.where(F.length("payload") > 2000).select(F.json_object_keys("payload").alias("k"))
            print(keys.agg(F.avg(F.size("k")).alias("keys"), F.size(F.array_distinct(F.flatten(F.collect_set("k")))).alias("all")).first())


if __name__ == "__main__":
    main()
